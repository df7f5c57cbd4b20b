"""Near duplicates against brute force: no link between different texts may be lost."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from docferry.llm import signature_join as join

from odd_data import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5)), strict=False))


def brute(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows; rows with one id are one document."""
    sets = [shingle_set(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(sets):
        for j in range(k):
            y = sets[j]
            if x and y and rows[k][0] is not None and rows[j][0] is not None:
                o = len(x & y)
                if 100 * o >= 75 * (len(x) + len(y) - o):
                    a, b = find(rows[k][0]), find(rows[j][0])
                    parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Groups of near copies around the threshold, chains, passages in unrelated texts, short and odd texts."""
    rng = random.Random(seed)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 160]))]
        texts += [edited(rng, base, rng.randrange(0, 1 + len(base) // 12)) for _ in range(rng.choice([3, 15, 40]))]
    passage = " ".join(f"p{k}" for k in range(50))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 120))) + " " + passage for _ in range(40)]
    chain = [f"c{k}" for k in range(200)]
    for k in range(12):
        chain = [*chain[8:], *(f"c{k}x{j}" for j in range(8))]
        texts.append(" ".join(chain))
    texts += [None, "", " \n", "one", "ONE", "one two", "one two three four", "one two three four five", "same " * 30, "Same " * 40, "x" * 20000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, rows[0], (None, texts[0]), (5000, texts[0]), (5000, "a text of its own under an id that is there twice"), (rows[1][0], texts[3])]


@pytest.mark.parametrize(("seed", "frequent"), [(0, True), (1, False)])
def test_components(spark, seed, frequent, monkeypatch):
    if not frequent:
        monkeypatch.setattr(join, "BLOCK", 8)  # several blocks in a group
        monkeypatch.setattr(join, "BROADCAST_ROWS", 0)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 1, 2, 3) for i, t in rows], "doc_id long, text string, bits string, n int, comp int, id int").repartition(5)
    found = join.near_duplicates(df)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    kept = join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted({str(r.doc_id) for r in kept.collect()}) == sorted({str(i) for i, _, c in brute(rows) if i == c})


def test_without_stars(spark, monkeypatch):
    """The buckets alone find every link."""
    monkeypatch.setattr(join, "ALIKE", 99)
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, join.near_duplicates(df).collect()), key=str) == brute(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert join.near_duplicates(df).count() == 0 and join.one_of_each(df).count() == 0


def test_long_copies(spark):
    text = sentence(3, 30000)
    rows = [(4, text), (2, text + " more"), (9, sentence(4, 25000)), (7, text.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in join.near_duplicates(df).collect()} == {4: 2, 2: 2, 9: 9, 7: 2}


def test_tree_drops_no_pair_that_links():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, int(rng.integers(3, 300))).astype(np.uint64)
        for _ in range(8):
            keep = base[rng.random(len(base)) > rng.random() * 0.4]
            sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, 2).astype(np.uint64))))
    ids = np.arange(len(sets))
    members = join.Members(ids, np.asarray([len(s) for s in sets]), ids, [join.bitmap(s) for s in sets])
    tree = join.SignatureTree(members, join._in_order(members, ids))
    found = {(min(a, b), max(a, b)) for x, y in tree.pairs() for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = {(a, b) for a in ids for b in ids[a + 1 :] if join.links(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))}
    assert len(want) > 20 and want <= found and len(found) < len(ids) * (len(ids) - 1) // 2


def test_components_of_a_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 99), (99, 101)]
    got = {r.node: r.label for r in join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 99: 99, 100: 99, 101: 99}


def near_group(n):
    """Near copies of one text, each at a similarity of about 0.8 to the others."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(200)]
    return [(k, edited(rng, base, 2)) for k in range(n)]


def test_candidates_are_verified_before_blocks_meet(spark, monkeypatch):
    """A group that the stars missed is joined by single pairs; no sets of whole blocks are copied."""
    monkeypatch.setattr(join, "ALIKE", 99)
    monkeypatch.setattr(join, "BLOCK", 8)
    in_blocks, exact = [], join._group_links
    monkeypatch.setattr(join, "_group_links", lambda docs, classes, groups: in_blocks.append(groups.count()) or exact(docs, classes, groups))
    rows = near_group(60)
    found = join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert sum(in_blocks) == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_buckets_in_parts(spark, seed, monkeypatch):
    """Large buckets are dealt in parts, with and without frequent shingles, and lose no link."""
    monkeypatch.setattr(join, "PART", 6)
    monkeypatch.setattr(join, "BLOCK", 8)
    monkeypatch.setattr(join, "ALIKE", 99 if seed == 4 else join.ALIKE)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, join.near_duplicates(df).collect()), key=str) == brute(rows)


def test_no_meeting_holds_a_whole_bucket(spark):
    """A bucket of one large component and some others: meetings are bounded, and any two that may link meet."""
    rows = [(1, k, 0 if k < 400 else k) for k in range(450)] + [(2, k, k) for k in range(5)]
    met = join._meetings(spark.createDataFrame(rows, "grp long, id long, comp long"), 40).collect()
    meetings = {}
    for r in met:
        meetings.setdefault(r.meeting, []).append(r)
    assert max(map(len, meetings.values())) < 3 * 40
    together = {(a.id, b.id) for rs in meetings.values() for a in rs for b in rs if a.whole or a.own != b.own}
    comps = {k: c for g, k, c in rows if g == 1}
    assert {(a, b) for a in comps for b in comps if a != b and comps[a] != comps[b]} <= together
    # the large component's own parts do not meet: each of its members is there once for each part of the others
    assert len([r for r in met if r.id == 399]) <= 3


def test_words_that_collide_in_polynomials(spark):
    """A Thue-Morse word of 1,024 letters and its complement, and the same with words for letters."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    texts = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits), " ".join(("on", "off")[b] for b in bits), " ".join(("off", "on")[b] for b in bits)]
    found = join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    classes = {r.doc_id: r.component_id for r in found.collect()}
    assert classes[0] == 0
    assert classes[1] == 1
    keys = join.shingles(pa.array(texts, pa.large_string()))[2]
    assert len(set(keys[:2].tolist())) == 2
    own = join._sequence_keys(*join.shingles(pa.array(texts))[2:])
    assert all(len(set(k.tolist())) == 4 for k in own)


def test_files_of_ids(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 900, 3)], "a long, b long")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        labels = join.components(edges)
        assert len(labels.inputFiles()) <= spark.sparkContext.defaultParallelism
        assert sorted(labels.collect()) == sorted((n, k) for k in range(0, 900, 3) for n in (k, k + 1))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_memory_of_wide_bitmaps():
    rng = np.random.default_rng(5)
    n, words = 400, 1024
    base = rng.bytes(8 * words)
    bits = [base[:k] + bytes([base[k] ^ 1]) + base[k + 1 :] for k in range(n)]
    sizes = np.full(n, 4 * 8 * words)
    members = join.Members(np.arange(n), sizes, np.arange(n), bits)
    tree = join.SignatureTree(members, np.arange(n))
    tracemalloc.start()
    try:
        assert sum(len(a) for a, _ in tree.pairs()) == n * (n - 1) // 2
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()


def test_counts_of_frequent_shingles():
    texts = [" ".join(f"w{t}x{k}" for k in range(4000)) for t in range(30)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = list(join._describe(iter([batch])))
    found = np.concatenate([np.unique(s) for s in join.shingle_sets(pa.array(texts[:30]))])
    often = rows[-1].column("often")
    assert rows[-1].schema.field("often").type == join._OFTEN
    assert sorted(o["hash"] for o in often[0].as_py()) == sorted(found[found < np.uint64(1 << 63)].view(np.int64).tolist())
    assert {o["n"] for o in often[0].as_py()} == {3}
