"""The language model against a brute-force version, the toxicity model by held-out accuracy."""

import collections
import math
import pathlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docferry.llm import common, toxicity
from docferry.llm import lattice_lm as lm

from odd_data import ODD_TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def segmentations(word, table):
    """Log probabilities of all segmentations, one by one."""
    if not word:
        return [0.0]
    return [table[word[:k]] + rest for k in range(1, len(word) + 1) if word[:k] in table for rest in segmentations(word[k:], table)]


def test_lattice_sums_all_segmentations(byte_bpe):
    pieces = lm.pieces(byte_bpe, (b"zqzq", b"the"))
    assert not pieces.usable[50256]
    log_p = lm._log(pieces.prior)
    every = lm.codec(byte_bpe).pieces
    table = {p: log_p[i] for i, p in enumerate(every) if pieces.usable[i]} | {b" zqzq": log_p[50257]}
    words = [b"the", b"zqzqs", b"a", "ünï".encode(), b"there."]
    lattices = lm.Lattices(pieces, words)
    want = [np.logaddexp.reduce(segmentations(b" " + w, table)) for w in words]
    assert lattices.probabilities(log_p) == pytest.approx(want)
    use = lattices.expected(log_p)
    # expected tokens: each segmentation by its share
    total = 0.0
    for w, z in zip(words, want, strict=True):

        def parts(rest):
            if not rest:
                return [(0.0, 0)]
            return [(table[rest[:k]] + p, n + 1) for k in range(1, len(rest) + 1) if rest[:k] in table for p, n in parts(rest[k:])]

        total += sum(math.exp(p - z) * n for p, n in parts(b" " + w))
    assert use.sum() == pytest.approx(total)


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_scores(spark, byte_bpe, frequent):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["the", "fox", "Über", "runs.", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(0, 30)))) for k in range(60)]
    rows += [(None, "the end"), (70, None), (71, ""), (72, "z" * 3000), (73, "the " * 2000), (73, "the " * 2000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, row string, base int").repartition(4)
    found = lm.score_documents(df, byte_bpe, rounds=1, frequent=frequent, word_pieces=4).collect()
    counts, ends = collections.Counter(), 0
    for i, t in rows:
        if remainder(i, 10):
            counts.update(words_of(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    base = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    want = collections.Counter()
    for i, t in rows:
        own = words_of(t)
        total = sum(base(counts[w]) for w in own) + base(ends)
        want[i, remainder(i, 10) == 0, len(own) + 1, sum(counts[w] > 0 for w in own) + 1, n, round(total, 6)] += 1
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    # scores add up over words and do not depend on which words go to the tasks
    by_text = {r.doc_id: r.score for r in found}
    assert by_text[70] == by_text[71]
    once = lm.score_documents(df, byte_bpe, rounds=1, frequent=0, word_pieces=4).collect()
    assert {r.doc_id: round(r.score, 6) for r in once if r.doc_id != 73} == {k: round(s, 6) for k, s in by_text.items() if k != 73}


def test_word_probabilities_add_up():
    """What is left of the discounted counts is what spelling gets."""
    counts = np.asarray([5, 3, 1, 1])
    mixture = lm.Mixture(tokens=14, ends=4, types=4, discount=0.5)
    never = np.full(4, -1e9)
    whole = (10 ** mixture.word(counts, never)).sum() + 10 ** mixture.end()
    spelled = 10 ** mixture.word(np.zeros(1), np.zeros(1))[0]
    assert whole + spelled == pytest.approx(1)


def test_scores_of_nothing(spark, byte_bpe):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(df, byte_bpe).count() == 0
    untrained = spark.createDataFrame([(None, "all held out")], "doc_id long, text string")
    row = lm.score_documents(untrained, byte_bpe).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 4, 0, 0) and row.base_score == 0 and math.isfinite(row.score)


STEMS = ["grumblo", "vexatious", "scoundrel", "blighter", "nuisance"]


def labelled(n, seed):
    """Texts of neutral words; toxic ones hold a few misspelled stems."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = [f"{rng.choice('bcdfgm')}{rng.choice('aeiou')}{rng.choice('lnrst')}{rng.choice(['', 'en', 'ed', 'ing'])}" for _ in range(rng.randrange(5, 300))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            stem = list(rng.choice(STEMS))
            stem[rng.randrange(len(stem))] = rng.choice("aeioxyz")
            words.insert(rng.randrange(len(words)), "".join(stem))
        rows.append((k, " ".join(words), toxic))
    return rows


SMALL = toxicity.Settings(buckets=1 << 14, least_steps=150)


def test_held_out_accuracy(spark):
    rows = labelled(2500, 1)
    df = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(df, labels).collect()}
    held = [(found[i], x) for i, _, x in rows if remainder(i, 4) == 2]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in found.values()) == len(held)
    assert np.mean([r.predicted for r, x in held if x]) > 0.75
    assert np.mean([r.predicted for r, x in held if not x]) < 0.1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_held_out_labels_do_not_matter(spark):
    rows = labelled(200, 2)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, 1 - x if flip and remainder(i, 4) == 2 else x) for i, _, x in rows], "doc_id long, toxic int")
        scores.append({r.doc_id: r.score for r in toxicity.toxicity(df, labels).collect()})
    assert scores[0] == scores[1]


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (5, None), (6, 7), (None, 1), (9, 0)], "doc_id long, toxic int")
    found = toxicity.toxicity(odd_documents, labels).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in ODD_TEXTS) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxicity(no_documents, labels).count() == 0
    nothing = toxicity.toxicity(odd_documents, labels.limit(0)).collect()
    assert {r.predicted for r in nothing} == {0}
    everything = toxicity.toxicity(odd_documents, labels.where("toxic = 1")).collect()
    assert {r.predicted for r in everything} == {1}


def test_training_is_bounded(spark):
    rows = labelled(120, 4)
    df = spark.createDataFrame([(i % 100, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 100, x) for i, _, x in rows], "doc_id long, toxic int")
    options = {"doc_id": "doc_id", "text": "text", "label": "toxic", "usable": None}
    texts, marks = toxicity.training_rows(df, labels, **options, max_rows=30, max_bytes=1 << 20)
    assert len(texts) == len(marks) <= 30 and set(marks) == {0, 1}
    texts, _ = toxicity.training_rows(df, labels, **options, max_rows=30, max_bytes=3000)
    assert 0 < sum(map(len, texts.to_pylist())) <= 3000


def test_a_giant_text_does_not_end_the_sample(spark):
    """Whatever its place in hash order, a text that exceeds the bytes is passed over and all others are used."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    for giant in range(6):
        rows = [(i, "x" * 5000 if i == giant else f"text {i}") for i in range(6)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        texts, marks = toxicity.training_rows(df, labels, doc_id="doc_id", text="text", label="toxic", usable=None, max_rows=100, max_bytes=1000)
        assert sorted(texts.to_pylist()) == sorted(t for i, t in rows if i != giant)
        assert sorted(marks.tolist()) == sorted(i % 2 for i in range(6) if i != giant)


def test_grams_share_rows_with_misspellings():
    a, first, rows, keys = toxicity.grams(pa.array(["worthless wortless Worthless!"]), SMALL)
    one, two, three = (set(a[x:y]) for x, y in zip(first, first[1:], strict=False))
    assert one == three and len(one & two) > len(two) / 3 and rows.tolist() == [0, 3] and keys[0] == keys[2] != keys[1]


def test_passages_cover_every_word():
    for n in range(0, 100):
        covered = set()
        for start in toxicity.passages(n, 8):
            covered.update(range(start, min(start + 8, n)))
        assert covered == set(range(n))


def test_score_replaces_a_column(spark):
    df = spark.createDataFrame([("a b", 9.0)], "text string, score double")
    model = toxicity.Model(SMALL, np.zeros(SMALL.buckets, np.float32), 0.0)
    assert toxicity.score(df, model).select(F.col("score")).first().score == 0.5


def test_training_texts_take_little_memory():
    """Their n-grams take some 200 times as much as the texts, so the driver makes them of a few at a time, of long texts in pieces."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 7))) for _ in range(n)) for n in (300, 200_000, *[3000] * 40, 1)]
    texts = [*texts, "", "é" * 90_000 + " end", None, " ", "a.b " * 20_000]
    column = pa.chunked_array([texts[:3], texts[3:]], pa.string())
    tracemalloc.start()
    words = toxicity.Words(column if hasattr(toxicity, "TRAIN_BYTES") else column.combine_chunks(), SMALL)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    assert len(words.texts) == len(texts)
    for i in (0, 1, 2, *range(len(texts) - 6, len(texts))):
        buckets, first, _, _ = toxicity.grams(pa.array([texts[i]], pa.string()), SMALL)
        own, sizes = words.of(words.texts[i])
        assert own.tolist() == buckets.tolist() and sizes.tolist() == np.diff(first).tolist()
    values = rng.choices(range(100), k=SMALL.buckets)
    values = np.asarray(values, np.float32)
    assert words.means(values).tolist() == (np.add.reduceat(values[words.grams], words.first[:-1]) / np.diff(words.first)).tolist()


def test_freed_memory_goes_back():
    def used():
        return int(re.search(r"VmRSS:\s+(\d+)", pathlib.Path("/proc/self/status").read_text())[1]) / 1024

    blocks = [b"x" * 60_000 + b"%d" % k for k in range(2_000)]
    last = blocks[-1]  # what lies below it is not handed back by itself
    del blocks
    before = used()
    common.give_back()
    assert last and before - used() > 50


def test_words_are_counted_in_little_memory(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(200_000)}" for _ in range(20_000)) for _ in range(20)] + [None, "", "W1 w1\tw1"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 for i in range(len(texts))])], ["text", "training"])
    want = collections.Counter()
    for i, t in enumerate(texts):
        for w in words_of(t):
            want[w.encode()] += i % 3
    for held in (lm.HELD_BYTES, 1 << 20):
        monkeypatch.setattr(lm, "HELD_BYTES", held)
        tracemalloc.start()
        out = list(lm._counted(common.slices(iter([batch]), "text", lm.COUNT_BYTES)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # slices of 2 MB took some 100 MB
        assert peak < 40 << 20
        got = collections.Counter()
        for b in out:
            for w, c in zip(b.column("word").to_pylist(), b.column("c").to_pylist(), strict=True):
                got[w] += c
        assert got == want
