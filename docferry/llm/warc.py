"""WARC archives with an index, written by tasks and read back by byte ranges.

Every task writes one ``.warc.gz`` file, a gzip member per record, and one index row per record: file, offset,
length, URL, digest, record id and kind. Equal payloads are stored once: the record with the largest id is a response, the
others are revisit records that name it. Which one it is follows from one aggregate per digest and a join of the
digests that occur more than once, which Spark splits where a digest is very common.

Reading starts from index rows: they are dealt by (file, stretch of the file), sorted by offset, ranges that lie close
together are read at once, and every record is parsed from its own range. A selection of the index reads only its own ranges.

Files get names of their own, and the index, which Spark writes, names those that count; files of lost or repeated tasks
are not in it.

Defined results: a null payload is empty; a null URL is left out, line ends and blanks in a URL are percent-encoded; rows
without an id are always responses and no others refer to them; rows that share the largest id are all responses; equal
means the same SHA-1 and length; an empty table gives an empty index; other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docferry.llm.common import file_system, make_folder, shuffle_partitions
from docferry.session import scratch_dir, written

DATE = "1970-01-01T00:00:00Z"
#: Ranges whose gap is at most this many bytes are read at once, up to READ_BYTES.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Bytes of a file that one task reads.
STRETCH_BYTES = 32 << 20
#: Records of which a digest is stored in a result batch at once.
BATCH_ROWS = 512

INDEX = "path string, offset long, length long, record_id long, url string, digest string, record_type string, refers_to long"
RECORD = "record_id long, url string, digest string, record_type string, refers_to long, payload_bytes long, payload binary"


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1 in upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(record_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if record_id is None else f"<urn:record:{record_id}>"


def record_bytes(record_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; with ``refers_to`` a revisit record without the payload, of which ``size`` is the full length."""
    target = "" if url is None else "".join(f"%{ord(c):02X}" if c.isascii() and (c <= " " or c == "\x7f") else c for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(record_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {target}")
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in data.decode().split("\r\n")[1:] if ": " in line)
    return {k.lower(): v for k, v in pairs}


def _record_id(uri: str | None) -> int | None:
    return int(uri[len("<urn:record:") : -1]) if uri and uri.startswith("<urn:record:") else None


def parse_record(data: bytes) -> dict:
    """The columns of RECORD from one record; the payload of a revisit record is null, its size that of the full payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = warc["warc-type"] == "response"
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if whole and payload_digest(payload) != digest:
        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
    return {
        "record_id": _record_id(warc["warc-record-id"]), "url": warc.get("warc-target-uri"), "digest": digest, "record_type": warc["warc-type"],
        "refers_to": _record_id(warc.get("warc-refers-to")), "payload_bytes": int(_headers(http)["content-length"]), "payload": payload if whole else None,
    }


def _kept_once(rows: DataFrame) -> DataFrame:
    """The rows (record_id, url, payload) with sha1 and refers_to: the largest id of an equal payload, null where that is the own one."""
    digested = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # digests first, from the narrow columns: payloads move once, to meet the few digests that repeat
    groups = digested.groupBy(F.col("sha1").alias("of_sha1"), F.col("size").alias("of_size")).agg(F.max("record_id").alias("kept"), F.count("*").alias("n"))
    repeated, _ = written(groups.where("n > 1 AND kept IS NOT NULL").drop("n"), "warc-repeated")
    found = digested.join(repeated, (F.col("sha1") == F.col("of_sha1")) & (F.col("size") == F.col("of_size")), "left")
    refers = F.when(F.col("record_id") != F.col("kept"), F.col("kept"))
    return found.select("record_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "sha1", "size", refers.alias("refers_to"))


def write_archive(df: DataFrame, folder: str, *, record_id: str, url: str, payload: Column, date: str = DATE) -> DataFrame:
    """Write a record per row (``payload`` is binary) to archives below ``folder``; returns the index, kept there too (``index``)."""
    make_folder(f"{folder}/archives")
    arrow = to_arrow_schema(StructType.fromDDL(INDEX))

    def write(batches):
        path, stream, at = f"{folder}/archives/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            entries = []
            for start in range(0, batch.num_rows, BATCH_ROWS):
                for row in batch.slice(start, BATCH_ROWS).to_pylist():
                    if stream is None:
                        fs, place = file_system(path)
                        stream = fs.open_output_stream(place, compression=None)
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    revisit = row["refers_to"] is not None
                    data = record_bytes(row["record_id"], row["url"], row["payload"] or b"", row["size"], digest, row["refers_to"], date)
                    entries.append({"path": path, "offset": at, "length": 0, "record_id": row["record_id"], "url": row["url"], "digest": digest, "record_type": "revisit" if revisit else "response", "refers_to": row["refers_to"]})
                    member = _member(data)
                    stream.write(member)
                    entries[-1]["length"] = len(member)
                    at += len(member)
            yield pa.RecordBatch.from_pylist(entries, arrow)
        if stream is not None:
            stream.close()

    rows = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(url).cast("string").alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    _kept_once(rows).mapInArrow(write, INDEX).write.mode("overwrite").parquet(f"{folder}/index")
    return df.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def ranges(entries: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Reads for sorted (offset, length) pairs: start, length, and the numbers of the pairs that lie in it."""
    start = stop = None
    inside: list[int] = []
    for k, (offset, length) in enumerate(entries):
        if inside and (offset - stop > GAP_BYTES or offset + length - start > READ_BYTES):
            yield start, stop - start, inside
            inside = []
        if not inside:
            start, stop = offset, offset
        inside.append(k)
        stop = max(stop, offset + length)
    if inside:
        yield start, stop - start, inside


def read_records(index: DataFrame, *, keep_payload: bool = True) -> DataFrame:
    """The records of the selected index rows, as RECORD (without the payload unless ``keep_payload``)."""
    schema = RECORD if keep_payload else RECORD.removesuffix(", payload binary")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def fetch(path: str, entries: list[tuple[int, int]]):
        fs, place = file_system(path)
        with fs.open_input_file(place) as f:
            for start, length, inside in ranges(entries):
                f.seek(start)
                data = f.read(length)
                for k in inside:
                    at = entries[k][0] - start
                    record = parse_record(zlib.decompress(data[at : at + entries[k][1]], 31))
                    if not keep_payload:
                        del record["payload"]
                    yield record

    def read(batches):
        for batch in batches:
            by_path: dict[str, list[tuple[int, int]]] = {}
            for row in batch.to_pylist():
                by_path.setdefault(row["path"], []).append((row["offset"], row["length"]))
            found = []
            for path, entries in by_path.items():
                for record in fetch(path, entries):
                    found.append(record)
                    if len(found) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(found, arrow)
                        found = []
            yield pa.RecordBatch.from_pylist(found, arrow)

    wanted = index.select("path", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / STRETCH_BYTES))
    dealt = wanted.repartition(shuffle_partitions(index.sparkSession), "path", "stretch").sortWithinPartitions("path", "offset")
    return dealt.select("path", "offset", "length").mapInArrow(read, schema)


def archive_and_check(df: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a page per row to archives in the shared folder and return what they hold, a row per page."""
    folder = scratch_dir(df.sparkSession, "warc")
    index = write_archive(df, folder, record_id=page_id, url=url, payload=F.col(html).cast("binary"))
    return read_records(index, keep_payload=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
