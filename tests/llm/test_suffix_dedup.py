import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docferry.llm import suffix_dedup as sd


def naive(rows, length, keep):
    """doc_id, size and remaining bytes, by a dictionary of all strings."""
    data = [(t or "").encode() for _, t in rows]
    places = defaultdict(list)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0)):
        for s in range(len(data[i]) - length + 1):
            places[data[i][s : s + length]].append((i, s))
    out = []
    for i, b in enumerate(data):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            found = places[b[s : s + length]]
            if len(found) > 1 and (keep == "none" or found[0] != (i, s)):
                gone[s : s + length] = [True] * length
        out.append((rows[i][0], len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def near_copies(n):
    rng = random.Random(n)
    base = [bytes(rng.choice(b"abc ") for _ in range(60)) for _ in range(3)]
    rows = []
    for i in range(n):
        b = bytearray(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            b[rng.randrange(len(b))] = rng.choice(b"xyz")
        rows.append((i, (bytes(b) + b"a" * rng.choice([0, 0, 30])).decode()))
    return [*rows, (n, None), (n + 1, ""), (n + 2, "é" * 40), (n + 3, "é" * 40), (n + 4, base[0].decode()), (n + 5, base[0].decode() * 2)]


def kept(df, **options):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in sd.remove_repeats(df, **options).collect()), key=repr)


@pytest.mark.parametrize(("length", "most", "keep"), [(12, 512, "none"), (12, 2, "first"), (20, 3, "none"), (1, 4, "first")])
def test_against_all_strings(spark, monkeypatch, length, most, keep):
    """Also where buckets of over ``most`` contexts split, down to single strings."""
    monkeypatch.setattr(sd, "MOST", most)
    rows = near_copies(60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert kept(df, length=length, keep=keep) == naive(rows, length, keep)


@pytest.mark.parametrize("length", [1, 3, 5])
def test_factors_are_those_of_all_pairs(length):
    rng = random.Random(length)
    common = lambda a, b: next((i for i in range(length) if a[i] != b[i]), length)
    for _ in range(100):
        contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 12))) for _ in range(rng.randint(1, 6))]
        starts = [len(c) - length + 1 for c in contexts]
        suffixes = [c[i : i + length] for c, n in zip(contexts, starts, strict=True) for i in range(n)]
        previous, following = sd.suffix_factors(contexts, starts, length)
        assert previous.tolist() == [max((common(s, t) for t in suffixes[:i]), default=0) for i, s in enumerate(suffixes)]
        assert following.tolist() == [max((common(s, t) for t in suffixes[i + 1 :]), default=0) for i, s in enumerate(suffixes)]


def test_every_start_has_one_context_however_a_text_is_cut(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)).decode() for n in (500, 11, 12, 0, 300)]
    found = sd._occurrences(pa.RecordBatch.from_pydict({"text": texts}), 12)
    starts = sorted((t, f + i) for t, f, n in zip(found["text"], found["first"], found["starts"], strict=True) for i in range(n))
    assert starts == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 11)]
    data = [t.encode() for t in texts]
    for t, f, n, ctx in zip(found["text"], found["first"], found["starts"], found["ctx"], strict=True):
        assert hashlib.md5(data[t][f : f + n + 11]).digest() == ctx


def test_spans_are_the_removed_bytes(spark):
    text = "head " + "x" * 30 + " tail"
    df = spark.createDataFrame([(1, text), (2, "other " + "x" * 30)], "doc_id int, text string")
    rows = {r.doc_id: r for r in sd.remove_repeats(df, length=10, keep="none").collect()}
    assert [(s.start, s.stop) for s in rows[1].spans] == [(4, 35)]
    assert bytes(rows[1].kept) == b"head tail"


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert kept(odd_documents, keep="none") == naive(rows, sd.LENGTH, "none")
    assert kept(no_documents) == []
    with pytest.raises(ValueError, match="keep"):
        sd.remove_repeats(odd_documents, keep="last")


def test_buckets_have_suffix_arrays_of_their_own():
    """The factors of each bucket as if it stood alone, sorted together with others in fewer steps."""
    rng = random.Random(7)
    groups = [[bytes(rng.choice(b"ab") for _ in range(rng.randint(16, 40))) for _ in range(rng.randint(1, 5))] for _ in range(20)]
    contexts = [c for g in groups for c in g]
    starts = [len(c) - 15 for c in contexts]
    previous, following = sd.suffix_factors(contexts, starts, 16, [len(g) for g in groups])
    alone = [sd.suffix_factors(g, [len(c) - 15 for c in g], 16) for g in groups]
    assert previous.tolist() == [x for p, _ in alone for x in p]
    assert following.tolist() == [x for _, f in alone for x in f]


@pytest.mark.parametrize("length", [5, 8, 16])
def test_bytes_in_common(length):
    rng = random.Random(length)
    rows = [bytes(rng.choice(b"ab") for _ in range(length)) for _ in range(50)]
    rows += [rows[-1], rows[-1][:-1] + b"z"]
    want = [next((i for i in range(length) if a[i] != b[i]), length) for a, b in zip(rows, rows[1:], strict=False)]
    assert sd._in_common(b"".join(rows), length).tolist() == want


def test_occurrences_end_with_their_text():
    """Also over texts shorter than the length, and where a long text is worked on in pieces."""
    texts = ["", "abcabcabc", None, "xy", "abcabcabc" * 4, "q" * 6]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = sd._occurrences(batch, 6)
    seen = [(t, s) for t, first, n in zip(found["text"].tolist(), found["first"].tolist(), found["starts"].tolist(), strict=True) for s in range(first, first + n)]
    assert seen == [(i, s) for i, t in enumerate(texts) for s in range(len(t or "") - 5)]
