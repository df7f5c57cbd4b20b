"""Encoding, decoding, counting and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docferry.llm import chunked_bpe, prefix_counts, token_files
from docferry.llm.bpe import codec, pre_tokens
from docferry.session import scratch_dir

from odd_data import ODD_TEXTS, sentence

PARTS = ["a", "b", "the ", " ", "  ", "\n", "\n\n", "\t", " '", "'re", "'r", "'ve", "'ll", "'s", "1", "23", "é", "ß", "　", "\x1c", "\x85", "\xa0", "😀", "<|endoftext|>", "<|endo", "!!", "...", "-", " x", "hello world ", "日本", "，", "。", "。'", "привет", " мир", "3.14", ".", ",'", "Ω", "²", "한국"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=60)


@pytest.fixture(scope="module")
def tokens(byte_bpe):
    return codec(byte_bpe)


def ids_of(tokens, text):
    return tokens.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_codec_and_chunks_agree_with_the_library(tokens, text):
    want = ids_of(tokens, text)
    assert tokens.encode(text).tolist() == want
    assert chunked_bpe.ChunkEncoder(tokens).encode(text).tolist() == want
    assert tokens.decode(np.asarray(want, np.uint32)) == tokens.library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(text=TEXTS)
def test_every_prefix_is_counted(tokens, text):
    got = prefix_counts.PrefixCounter(tokens).prefix_counts([text])[0].tolist()
    assert got == [len(ids_of(tokens, text[:k])) for k in range(len(text) + 1)]


def test_chunks_of_copies_are_reused_and_exact(tokens):
    encoder = chunked_bpe.ChunkEncoder(tokens)
    texts = [sentence(3, 4000), "Preface. " + sentence(3, 4000), sentence(4, 500) + sentence(3, 4000)]
    for text in texts:
        assert encoder.encode(text).tolist() == ids_of(tokens, text)
    assert encoder.n_reused > encoder.n_chunks / 3


def written_in(letters, n, seed):
    """Words of some script, with and without blanks and marks between them."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(n)]
    return "".join(w + m for w, m in zip(words, rng.choice([" ", ", ", "。", "'", "\n", " (", "7"], n), strict=True))


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуф", "日本語中文字学校山川田一二三", "éèàüößñçåø", "0123456789", "abcdefgh", "가나다라마바사"])
def test_copies_in_any_script_are_encoded_once(tokens, letters):
    text, encoder = written_in(letters, 3000, 1), chunked_bpe.ChunkEncoder(tokens)
    assert encoder.encode(text).tolist() == ids_of(tokens, text)
    once = encoder.n_encoded
    assert once <= len(text)
    other = "Перед этим. " + text + written_in(letters, 50, 2)
    assert encoder.encode(text).tolist() == ids_of(tokens, text)
    assert encoder.n_encoded == once
    assert encoder.encode(other).tolist() == ids_of(tokens, other)
    assert encoder.n_encoded < once + 3000


def test_a_text_without_borders_is_one_stretch(tokens):
    text, encoder = "語" * 20_000, chunked_bpe.ChunkEncoder(tokens)
    for _ in range(2):
        assert encoder.encode(text).tolist() == ids_of(tokens, text)
    assert encoder.n_encoded == len(text)


def test_full_caches_start_anew(tokens):
    encoder = chunked_bpe.ChunkEncoder(tokens, keep_bytes=2000)
    counter = prefix_counts.PrefixCounter(tokens, keep=50)
    for k in range(5):
        text = sentence(k, 300)
        assert encoder.encode(text).tolist() == ids_of(tokens, text)
        assert counter.prefix_counts([text])[0][-1] == len(ids_of(tokens, text))


def test_prefix_counter_learns_a_group_once(tokens, byte_bpe, monkeypatch):
    texts = [sentence(1, 60), "жаба 語語 é're don't  \n x" + sentence(2, 20)]
    n_groups = len({g for t in texts for g in pre_tokens().findall(t)})
    counter, learned = prefix_counts.PrefixCounter(tokens, keep=n_groups + 5), []
    learn = counter.learn
    monkeypatch.setattr(counter, "learn", lambda groups: (learned.append(len(groups)), learn(groups)))
    # other texts drive out what the present ones do not need
    for text, new in ((texts, n_groups), (texts, 0), ([texts[0], " and otherwords here asit were wasnot"], None), (texts[:1], 0)):
        for counts, t in zip(counter.prefix_counts(text), text, strict=True):
            assert counts.tolist() == [len(ids_of(tokens, t[:k])) for k in range(len(t) + 1)]
        assert new is None or learned[-1] == new
    assert prefix_counts.counter(byte_bpe) is prefix_counts.counter(byte_bpe)


def test_encode_documents(tokens, byte_bpe, odd_documents, no_documents):
    rows = chunked_bpe.encode_documents(odd_documents, byte_bpe).collect()
    want = sorted(((i, ids_of(tokens, t)) for i, t in ODD_TEXTS), key=str)
    assert sorted(((r.doc_id, r.ids) for r in rows), key=str) == want
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokens.library.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()
    assert chunked_bpe.encode_documents(no_documents, byte_bpe).count() == 0
    back = chunked_bpe.decode_documents(chunked_bpe.encode_documents(odd_documents, byte_bpe), byte_bpe)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t in ODD_TEXTS)


def test_count_tokens(tokens, byte_bpe, odd_documents, no_documents):
    rows = prefix_counts.count_tokens(odd_documents, byte_bpe, limit=20, keep_steps=True).collect()
    assert len(rows) == len(ODD_TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for i, text in ODD_TEXTS:
        if i in (7, 8):
            continue
        r, text = by_id[i], text or ""
        n = len(ids_of(tokens, text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 20)
        counts = prefix_counts.counts_of(r.steps)
        assert counts[-1] == n and counts[r.fit_chars] <= 20 and (counts[r.fit_chars + 1 :] > 20).all()
    assert prefix_counts.count_tokens(no_documents, byte_bpe, limit=20).count() == 0


@settings(max_examples=100, deadline=None)
@given(bits=st.integers(1, 32), n=st.integers(0, 400), seed=st.integers(0, 9))
def test_packing_round_trip(bits, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, n).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-n * bits // 8)
    assert (token_files.unpack(data, bits, n) == ids).all()


def test_token_file_random_access(tmp_path):
    rng = np.random.default_rng(1)
    docs = [(k if k % 5 else None, rng.integers(0, 50257, int(rng.integers(0, 9000))).astype(np.uint32)) for k in range(40)]
    fs, path = pafs.LocalFileSystem(), str(tmp_path / "t.ids")
    writer = token_files.TokenFileWriter(fs.open_output_stream(path), token_files.id_bits(50257))
    for key, ids in docs:
        writer.add(key, ids)
    writer.close()
    with fs.open_input_file(path) as f:
        file = token_files.TokenFile(f)
        assert file.bits == 16 and file.doc_ids == [k for k, _ in docs]
        whole = np.concatenate([i for _, i in docs])
        for a, b in ((0, 0), (0, 1), (8191, 8193), (5000, 90000), (len(whole) - 1, len(whole))):
            assert (file.ids(a, b) == whole[a:b]).all()
        assert (file.document(17) == docs[17][1]).all()
        assert [(k, i.tolist()) for k, _, i in file.documents()] == [(k, i.tolist()) for k, i in docs]
    with pytest.raises(ValueError):
        token_files.TokenFileWriter(fs.open_output_stream(str(tmp_path / "u.ids")), 4).add(1, np.asarray([16], np.uint32))


def test_token_files_of_a_table(spark, tokens, byte_bpe, odd_documents, no_documents):
    rows = token_files.encode_and_check(odd_documents, byte_bpe, end_id=2).collect()
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((i for i, _ in ODD_TEXTS), key=lambda i: -1 if i is None else i)
    start = 0
    texts = {}
    for i, t in ODD_TEXTS:
        ids = [*ids_of(tokens, t), 2]
        texts.setdefault(i, set()).add((len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
    for r in ordered:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in texts[r.doc_id]
        start += r.n_tokens
    assert token_files.encode_and_check(no_documents, byte_bpe, end_id=2).count() == 0


def test_other_tokenizer_files_use_the_library(spark, odd_documents):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert codec(path).fast is None
    folder = scratch_dir(spark, "word-tokens")
    files = token_files.write_token_files(odd_documents.where("doc_id = 9"), path, folder, end_id=None)
    assert token_files.document_checksums(files).first().n_tokens == len(ids_of(codec(path), "one"))
    with pytest.raises(ValueError):
        prefix_counts.PrefixCounter(codec(path))
