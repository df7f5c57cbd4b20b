import bisect
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from docferry.llm import alignment
from docferry.llm.bpe import codec


@pytest.fixture(scope="module")
def piece_bpe():
    return public_tokenizers.path("piece_bpe_32k.model")


def naive_groups(text, a, b):
    """Groups of one text by its tokens' end places, from whole encodings (those of A are tested in test_tokens)."""
    model, of_b = sentencepiece.SentencePieceProcessor(model_file=b), alignment.sides(a, b).sides[1].pieces
    ids = [codec(a).ordinary(" " + text).tolist(), model.encode(text)]
    pieces = [[codec(a).pieces[i] for i in ids[0]], [of_b[i] for i in ids[1]]]
    if not text or any(b"".join(p) != (" " + text).encode() for p in pieces):
        return []
    ends = [np.cumsum([len(p) for p in side]).tolist() for side in pieces]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in cuts]
    for k in range(2):
        for i, e in zip(ids[k], ends[k], strict=True):
            groups[bisect.bisect_left(cuts, e)][k].append(i)
    return groups


def naive_links(groups):
    links = Counter()
    for g in groups:
        for x, n in Counter(g[0]).items():
            for y, m in Counter(g[1]).items():
                links[x, y] += n * m
    return links


def naive_rows(rows, a, b):
    groups = [naive_groups(t or "", a, b) for _, t in rows]
    links = [naive_links(own) for own in groups]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), own, pairs in zip(rows, groups, links, strict=True):
        listed = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in own)
        n_best = sum(n for p, n in pairs.items() if counts[p] == most[p[0]])
        out.append((doc_id, sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), sum(pairs.values()), n_best, sum(n * counts[p] for p, n in pairs.items()), hashlib.sha256(listed.encode()).hexdigest() if listed else ""))
    return sorted(out, key=repr)


ODD = ["", "a", " ", "  ", " a b  c ", "\n\n x", "a\n  b\t\t c   d", "x▁y z", "日本語 テキスト ありがとう。", "don't we'll I'VE 's", "<s> hi </s> <|endoftext|> <unk>", "\x00\x01 a\x1c b", "é" * 50 + " " + "🙂🙂 🙂", "ﬁ Å ½", "trail  ", "word" * 500]


def test_groups_against_whole_encodings(monkeypatch, byte_bpe, piece_bpe):
    """With lanes and stretches so short that most texts have several."""
    monkeypatch.setattr(alignment, "STRETCH", 20)
    monkeypatch.setattr(alignment, "LANE_BYTES", 16)
    found = alignment.align(ODD, byte_bpe, piece_bpe)
    listed = alignment.group_texts(found, 60000)
    want = [";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in naive_groups(t, byte_bpe, piece_bpe)) for t in ODD]
    assert listed == want
    assert want[7] == ""
    links = [Counter() for _ in ODD]
    for doc, of_a, of_b, n in zip(*map(np.ndarray.tolist, found.links()), strict=True):
        links[doc][of_a, of_b] += n
    assert links == [naive_links(naive_groups(t, byte_bpe, piece_bpe)) for t in ODD]


def test_lockstep_finds_common_ends():
    rng = np.random.default_rng(5)
    ends = [np.unique(np.append(rng.integers(1, 1000, 300), 1000)) for _ in range(2)]
    want = np.intersect1d(*ends)
    for lanes in ([0, 1000], [0, 10, 500, 1000], np.arange(0, 1001, 8)):
        a, b = alignment.lockstep(ends, np.asarray(lanes))
        assert np.array_equal(ends[0][a], want)
        assert np.array_equal(ends[1][b], want)


@pytest.mark.parametrize("known", [alignment.KNOWN_PAIRS, 5, 0])
def test_documents(spark, odd_documents, byte_bpe, piece_bpe, known):
    """All columns, whether counts of pairs are sent to the tasks or joined."""
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    found = alignment.alignment_links(odd_documents, byte_bpe, piece_bpe, known_pairs=known)
    assert tuple(found.columns) == alignment.RESULT
    assert sorted(map(tuple, found.collect()), key=repr) == naive_rows(rows, byte_bpe, piece_bpe)


def test_no_documents(no_documents, byte_bpe, piece_bpe):
    assert alignment.alignment_links(no_documents, byte_bpe, piece_bpe).collect() == []


def test_cuts_of_documents(spark, byte_bpe, piece_bpe):
    text = "Tokenizers disagree about internationalisation"
    row = alignment.align_documents(spark.createDataFrame([(1, "x"), (2, text)], "doc_id int, text string"), byte_bpe, piece_bpe).where("doc_id = 2").first()
    groups = naive_groups(text, byte_bpe, piece_bpe)
    assert [row.a_ids[i:j] for i, j in zip([0, *row.a_cuts], row.a_cuts)] == [g[0] for g in groups]  # noqa: B905
    assert [row.b_ids[i:j] for i, j in zip([0, *row.b_cuts], row.b_cuts)] == [g[1] for g in groups]  # noqa: B905
    assert row.byte_cuts[-1] == len(text) + 1
