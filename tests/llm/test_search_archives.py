"""Decontamination and archives against brute force."""

import base64
import gzip
import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.llm import decontaminate, warc
from docferry.session import scratch_dir

from odd_data import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, size=10):
    doc, hit, found = words(text), set(), set()
    for item, value in items:
        own = words(value)
        k = min(size, len(own))
        windows = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} if k else set()
        for s in range(len(doc) - k + 1 if k else 0):
            if tuple(doc[s : s + k]) in windows:
                hit.update(range(s, s + k))
                found.add(item)
    listed = sorted(str(i) for i in found if i is not None)
    return len(doc), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


VOCABULARY = st.lists(st.sampled_from(["a", "b", "C", "d-e", "é"]), max_size=40).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(text=VOCABULARY, items=st.lists(VOCABULARY, max_size=5), size=st.integers(1, 6))
def test_search_finds_every_window(text, items, size):
    items = list(enumerate(items))
    ranges, found = decontaminate.Searcher(items, size).find(decontaminate.words_of(text))
    n, n_hit, n_items, _, _ = brute(text, items, size)
    assert (len(decontaminate.words_of(text)), sum(b - a for a, b in ranges), len(found)) == (n, n_hit, n_items)


ITEMS = [(10, sentence(50, 30)), (2, sentence(51, 10)), (3, "Short Item"), (4, None), (5, "--- !!"), (None, sentence(52, 12)), (10, sentence(53, 11)), (6, sentence(50, 30))]
DOCS = [
    (1, sentence(60, 20) + " " + sentence(50, 30) + ", " + sentence(61, 5)), (2, None), (3, ""), (4, "this short ITEM here"), (5, sentence(52, 12)), (None, sentence(51, 10)),
    (6, sentence(62, 20000) + ". " + sentence(53, 11)), (7, sentence(50, 9)), (7, sentence(50, 9)), (8, sentence(50, 30).upper()),
]


@pytest.mark.parametrize("table_bytes", [1 << 20, 200])
def test_contamination(spark, table_bytes):
    df = spark.createDataFrame([(*d, "clash", 1) for d in DOCS], "doc_id long, text string, hits string, n_words int").repartition(3)
    bench = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, items string")
    found = decontaminate.contamination(df, bench, table_bytes=table_bytes)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((i, *brute(t, ITEMS))) for i, t in DOCS)
    kept = decontaminate.without_passages(df, bench, table_bytes=table_bytes)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in DOCS if not brute(t, ITEMS)[-1])


def test_empty_tables(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(df, bench.limit(0)).where("contaminated OR n_items > 0").count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2?q=x y\r\nz", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://ä/6", "ünïcode"),
    (7, "http://a/7", "x" * 300000), (8, "http://a/8", "\r\n\r\nhead: no\r\n"), (None, "http://a/n", "<p>same</p>"), (None, None, "alone"), (9, "http://a/9", "twice"), (9, "http://a/9", "twice"),
]


def test_archives(spark):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    found = warc.archive_and_check(df).collect()
    kept = {}
    for i, _, html in PAGES:
        if i is not None:
            kept[html or ""] = max(kept.get(html or "", i), i)
    want = []
    for i, _, html in PAGES:
        top = kept.get(html or "")
        revisit = i is not None and i != top
        want.append((i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", top if revisit else None))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_index_reads_single_records(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc-test")
    index = warc.write_archive(df, folder, record_id="page_id", url="url", payload=F.col("html").cast("binary"))
    chosen = index.where("record_id = 7 OR record_id = 2")
    rows = {r.record_id: r for r in warc.read_records(chosen).collect()}
    assert bytes(rows[7].payload) == b"x" * 300000 and rows[2].payload is None and rows[2].refers_to == 3
    assert rows[2].url == "http://a/2?q=x%20y%0D%0Az"
    # every member is a record of its own, readable by any WARC reader
    entry = index.where("record_id = 6").first()
    with open(entry.path.removeprefix("file:"), "rb") as f:
        f.seek(entry.offset)
        record = gzip.decompress(f.read(entry.length))
    head, _, block = record.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)$", head)[1])
    assert head.startswith(b"WARC/1.1\r\n") and len(block) == length + 4 and block.endswith(b"\r\n\r\n")
    assert warc.read_records(warc.write_archive(df.limit(0), folder + "-none", record_id="page_id", url="url", payload=F.col("html").cast("binary"))).count() == 0


@settings(max_examples=100, deadline=None)
@given(entries=st.lists(st.tuples(st.integers(0, 10**8), st.integers(1, 10**6)), max_size=40))
def test_ranges_cover_their_records(entries):
    entries = sorted(entries)
    seen = []
    for start, length, inside in warc.ranges(entries):
        for k in inside:
            assert start <= entries[k][0] and entries[k][0] + entries[k][1] <= start + length
        seen += inside
    assert seen == list(range(len(entries)))
