"""Registered queries of this package, with SQL where it can say what must come out."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm import alignment, chunked_bpe, decontaminate, lattice_lm, prefix_counts, sharding, signature_join, suffix_dedup, token_files, topk, toxicity, warc, whitening
from docferry.llm.common import read_table, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
END_ID = 2
TOKEN_LIMIT = 1024
SHARD_BYTES = 1 << 20
TOP_K = 10


def query(sql: str | None = None):
    """Register a query under its function name."""

    def add(f):
        @functools.wraps(f)
        def run(spark, sf_dir):
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return run

    return add


@query(f"""
WITH rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS b, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM documents),
buckets AS (
  SELECT depth, h >> (60 - depth) AS p, sum(b) AS s, count(*) AS n, min(h) = max(h) AS one FROM rows, range(0, 61) AS t(depth) GROUP BY 1, 2),
leaves AS (
  SELECT r.doc_id, r.h, min(depth) AS depth FROM rows r JOIN buckets x ON x.p = r.h >> (60 - x.depth) WHERE s <= {SHARD_BYTES} OR one GROUP BY 1, 2)
SELECT l.doc_id, substr(lpad(bin(l.h), 60, '0'), 1, CAST(l.depth AS INT)) AS shard_id, CAST(l.depth AS INT) AS shard_depth,
  CAST(x.s AS BIGINT) AS shard_bytes, x.n AS shard_rows
FROM leaves l JOIN buckets x ON x.depth = l.depth AND x.p = l.h >> (60 - l.depth)
""")
def op1_extendible_shards(spark, sf_dir):
    """The shard of every document, none over the byte limit unless one document is."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.octet_length(F.coalesce("text", F.lit("")))
    return sharding.shard(docs, key=F.col("doc_id"), size=size, limit=SHARD_BYTES).select("doc_id", "shard_id", "shard_depth", "shard_bytes", "shard_rows")


@query()
def op2_lattice_lm(spark, sf_dir):
    """log10 probability of every document under subword lattices learned from nine tenths of them."""
    return lattice_lm.score_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query(f"""
WITH usable AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x, generate_subscripts(embedding, 1) AS i FROM usable),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM parts q JOIN parts c USING (i)
  WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY 1, 2),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= {TOP_K}
""")
def op3_histogram_top_k(spark, sf_dir):
    """The ten best neighbours of every hundredth vector among all vectors."""
    return topk.exact_top_k(read_table(spark, sf_dir, "embeddings"), k=TOP_K, is_query=F.col("vec_id") % 100 == 0)


@query()
def op4_subword_toxicity(spark, sf_dir):
    """How toxic every document is, learned from the labelled ones."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query()
def op5_token_files(spark, sf_dir):
    """Token ids of all documents in bit-packed files, read back."""
    return token_files.encode_and_check(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=END_ID)


def _words_sql(text: str, between: str = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+") -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(regexp_split_to_array({lower}, '{between}'), lambda w: w <> '')"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql("text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, k, w[s : s + k - 1] AS x FROM (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
places AS (
  SELECT r, k, s, w[s : s + k - 1] AS x FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT p.r, p.s, p.k, n.item FROM places p JOIN windows n ON p.k = n.k AND p.x = n.x),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS place FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")
def op6_wu_manber(spark, sf_dir):
    """Benchmark passages in every document."""
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(h, {5 * k + 1}, 5))::BIGINT >> {s}) & 31 AS INT), 1)" for k in range(8) for s in (15, 10, 5, 0)
)


@query(f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = kept OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM p JOIN k USING (html)
""")
def op7_warc_index(spark, sf_dir):
    """All pages written as WARC records and read back by the index."""
    return warc.archive_and_check(read_table(spark, sf_dir, "pages"))


@query()
def op8_chunked_bpe(spark, sf_dir):
    """Ids and decoded texts of all documents, by shared chunks."""
    return chunked_bpe.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), keep_ids=False)


@query()
def op9_prefix_counts(spark, sf_dir):
    """Token counts of all documents, and how much of each fits the limit."""
    return prefix_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=TOKEN_LIMIT)


@query(f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words_sql("text", "[\\x09-\\x0D\\x20]+")} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[s : s + 4] AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS o FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * o >= 75 * (m.n + n.n - o)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
""")
def op10_signature_trees(spark, sf_dir):
    """The group of near duplicates of every document."""
    return signature_join.near_duplicates(read_table(spark, sf_dir, "documents"))


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n, hex(coalesce(text, '')) AS h FROM documents),
w AS (SELECT r, s, md5(substr(h, 2 * s + 1, {2 * suffix_dedup.LENGTH})) AS m FROM (SELECT r, h, unnest(range(0, n - {suffix_dedup.LENGTH - 1})) AS s FROM d)),
marked AS (SELECT r, s, s + {suffix_dedup.LENGTH} AS e FROM (SELECT r, s, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
runs AS (SELECT r, s, e, sum(new) OVER (PARTITION BY r ORDER BY s) AS run FROM (
  SELECT r, s, e, CASE WHEN s <= lag(e) OVER (PARTITION BY r ORDER BY s) THEN 0 ELSE 1 END AS new FROM marked)),
spans AS (SELECT r, min(s) AS s, max(e) AS e FROM runs GROUP BY r, run),
cuts AS (SELECT r, s, e FROM spans UNION ALL SELECT r, n, n FROM d),
pieces AS (SELECT r, s, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s, e), 0) AS b FROM cuts),
kept AS (SELECT r, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS k FROM pieces JOIN d USING (r) GROUP BY r),
gone AS (SELECT r, count(*) AS n_spans, CAST(sum(e - s) AS BIGINT) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN gone USING (r)
""")
def op11_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of strings that stand anywhere else too."""
    kept = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), keep="none")
    n_removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return kept.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op12_block_whitening(spark, sf_dir):
    """The whitened components of every vector."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query()
def op13_lockstep_alignment(spark, sf_dir):
    """How the tokens of two tokenizers line up in every document, and how usual its links are."""
    documents = read_table(spark, sf_dir, "documents")
    return alignment.alignment_links(documents, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
