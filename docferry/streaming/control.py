"""Control messages: what to migrate, taken from a topic.

A message is (topic, partition, offset, value). Parsed rows name the message by these
coordinates and never carry passwords or connection strings; a job gets its secrets from the
message itself when it runs.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docferry.session import create_new, list_names, path_exists, scratch_dir, seconds_since_touched, touch

MESSAGE_SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"

# Topics and the keys a message on each must have.
DOCUMENTS_TOPIC = "send-credential-nosql-topic"
RELATIONAL_TOPIC = "send-credential-sql-topic"
BOTH_TOPIC = "send-credential-topic"
REQUIRED_KEYS = {
    DOCUMENTS_TOPIC: ("uri", "collection"),
    RELATIONAL_TOPIC: ("url", "username", "password", "database"),
    BOTH_TOPIC: (
        "sql_host",
        "sql_port",
        "sql_user",
        "sql_password",
        "sql_database",
        "mongo_uri",
        "mongo_db_name",
    ),
}
# Keys whose values may be shown: names of databases.
SHOWN_KEYS = {
    DOCUMENTS_TOPIC: ("collection",),
    RELATIONAL_TOPIC: ("database",),
    BOTH_TOPIC: ("sql_database", "mongo_db_name"),
}

STARTED, DONE, FAILED = "started", "done", "failed"
COORDINATES = ("topic", "partition", "offset")
PROCESSED_SCHEMA = "topic string, partition int, offset long, status string, attempt int"
#: Seconds after which a job whose driver gave no sign of life may be tried by another one.
LEASE = 600.0
ACCEPTED, BAD_JSON, MISSING_KEY, UNKNOWN_TOPIC = "accepted", "bad json", "missing key", "unknown topic"


@dataclass(frozen=True)
class ControlSource:
    """Where messages come from: ``kafka`` with its options, or a folder of message files."""

    format: str = "json"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)


def control_stream(spark: SparkSession, source: ControlSource) -> DataFrame:
    """Messages as a stream, from the earliest one kept."""
    if source.format == "kafka":
        options = {"startingOffsets": "earliest", **source.options}
        messages = spark.readStream.format("kafka").options(**options).load()
        return messages.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format(source.format).schema(MESSAGE_SCHEMA).options(**source.options)
    return reader.load(source.path)


def control_batch(spark: SparkSession, source: ControlSource) -> DataFrame:
    """The messages there are now, as a table."""
    if source.format == "kafka":
        options = {**source.options, "startingOffsets": "earliest", "endingOffsets": "latest"}
        messages = spark.read.format("kafka").options(**options).load()
        return messages.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
    return spark.read.format(source.format).schema(MESSAGE_SCHEMA).options(**source.options).load(source.path)


def _per_topic(choices: dict[str, Column], otherwise: Column) -> Column:
    out = None
    for topic, value in choices.items():
        out = F.when(F.col("topic") == topic, value) if out is None else out.when(F.col("topic") == topic, value)
    return otherwise if out is None else out.otherwise(otherwise)


def _checked(messages: DataFrame, required: dict[str, Iterable[str]], shown: dict[str, Iterable[str]]) -> DataFrame:
    """Messages with ``status, reason, shown`` and still their ``value``; not for passing on."""
    no_texts = F.expr("CAST(array() AS array<string>)")
    members = F.from_json("value", "map<string,string>")
    valid = F.coalesce(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{"), F.lit(False))
    present = F.transform(F.filter(F.map_entries(members), lambda e: e["value"].isNotNull()), lambda e: e["key"])
    needed = _per_topic({t: F.array(*map(F.lit, keys)) for t, keys in required.items()}, no_texts)
    open_keys = _per_topic({t: F.array(*map(F.lit, keys)) for t, keys in shown.items()}, no_texts)
    sent = F.col("timestamp") if "timestamp" in messages.columns else F.lit(None).cast("timestamp")
    checked = messages.select(
        "topic",
        "partition",
        "offset",
        sent.alias("timestamp"),
        "value",
        valid.alias("_valid"),
        F.when(valid, F.array_except(needed, F.coalesce(present, no_texts))).alias("_missing"),
        F.when(valid, F.map_filter(members, lambda k, _: F.array_contains(open_keys, k))).alias("shown"),
    )
    status = (
        F.when(~F.col("topic").isin(*required), UNKNOWN_TOPIC)
        .when(~F.col("_valid"), BAD_JSON)
        .when(F.size("_missing") > 0, MISSING_KEY)
        .otherwise(ACCEPTED)
    )
    reason = F.when(status == MISSING_KEY, F.array_join("_missing", ",")).when(status != ACCEPTED, status)
    return checked.select(
        "topic", "partition", "offset", "timestamp", "value", status.alias("status"), reason.alias("reason"), "shown"
    )


def parse_control(
    messages: DataFrame,
    required: dict[str, Iterable[str]] = REQUIRED_KEYS,
    shown: dict[str, Iterable[str]] = SHOWN_KEYS,
) -> DataFrame:
    """Check each message against the keys its topic needs.

    Returns ``topic, partition, offset, timestamp, status, reason, shown``: ``shown`` maps the keys that
    may be seen to their values, and is the only part of the value that is passed on.
    """
    return _checked(messages, required, shown).drop("value")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == ACCEPTED)


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be used, with the reason."""
    return parsed.where(F.col("status") != ACCEPTED).select("topic", "partition", "offset", "status", "reason")


def _order() -> Column:
    """When a message was sent; offsets only order the messages of one partition."""
    return F.struct("timestamp", "partition", "offset")


def latest_per_topic(parsed: DataFrame) -> DataFrame:
    """Last accepted message of each topic, by the time it was sent (messages without one come first), then by
    partition and offset; the whole message counts, so there are no half updates."""
    return (
        accepted(parsed)
        .groupBy("topic")
        .agg(
            F.max_by(F.struct("partition", "offset", "shown"), _order()).alias("last"),
            F.count(F.lit(1)).alias("n_messages"),
        )
        .select("topic", "last.partition", "last.offset", "last.shown", "n_messages")
    )


def job_ready(latest: DataFrame, sides: Iterable[str] = (DOCUMENTS_TOPIC, RELATIONAL_TOPIC)) -> DataFrame:
    """One row: how many of the wanted sides have arrived, and whether all have."""
    sides = list(sides)
    found = latest.where(F.col("topic").isin(*sides)).agg(F.countDistinct("topic").alias("n_sides"))
    return found.select("n_sides", (F.col("n_sides") == len(sides)).alias("ready"))


def keep_table(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "complete", *, available_now: bool = True
) -> StreamingQuery:
    """Run a stream into a table at ``path``; in complete mode each batch replaces it."""
    def store(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if output_mode == "complete" else "append").parquet(path)

    if output_mode == "append":
        writer = stream.writeStream.format("parquet").option("path", path)
    else:
        writer = stream.writeStream.foreachBatch(store)
    writer = writer.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _done(spark: SparkSession, processed: str) -> DataFrame:
    if not path_exists(spark, processed) or not list_names(spark, processed):
        return spark.createDataFrame([], PROCESSED_SCHEMA)
    return spark.read.schema(PROCESSED_SCHEMA).json(processed).drop("record")


def _claims(processed: str, coordinates: Iterable) -> str:
    """Folder of the claims on one message; its name starts with a mark that Spark's readers pass over."""
    name = hashlib.sha256(repr(tuple(coordinates)).encode()).hexdigest()
    return f"{processed.rstrip('/')}/_claims/{name}"


def _claim(spark: SparkSession, folder: str, n_failed: int, lease: float) -> int | None:
    """Number of the attempt this driver may make now; None while another one is at it.

    An attempt is an empty file that only one driver can create. Its driver touches it while the job runs, so that one that was
    not touched for ``lease`` seconds and has no outcome belongs to a driver that is gone.
    """
    attempts = list_names(spark, folder)
    if len(attempts) > n_failed and seconds_since_touched(spark, f"{folder}/{attempts[-1]}") < lease:
        return None
    attempt = len(attempts) + 1
    return attempt if create_new(spark, f"{folder}/{attempt:06d}") else None


@contextmanager
def _held(spark: SparkSession, path: str, lease: float) -> Iterator[None]:
    """Touch a claim a few times per lease until the work is over."""
    over = threading.Event()

    def beat() -> None:
        while not over.wait(max(lease / 4, 0.05)):
            touch(spark, path)

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


def _run_claimed(
    spark: SparkSession, coordinates: tuple, n_failed: int, processed: str, lease: float, work: Callable[[], None]
) -> str | None:
    """Claim, run and record one piece of work; its outcome, or None where it is another driver's or done."""
    folder = _claims(processed, coordinates)
    attempt = _claim(spark, folder, n_failed, lease)
    if attempt is None:
        return None
    here = F.lit(True)
    for name, value in zip(COORDINATES, coordinates, strict=True):
        here = here & (F.col(name) == value)

    def record(status: str) -> None:
        # a folder of its own: writers into one folder at the same time remove each other's unfinished files
        row = spark.createDataFrame([(*coordinates, status, attempt)], PROCESSED_SCHEMA).coalesce(1)
        row.write.json(f"{processed.rstrip('/')}/record={uuid.uuid4().hex}")

    # It may have been done after the table of what is done was read, and before the claim.
    if not _done(spark, processed).where(here & (F.col("status") == DONE)).isEmpty():
        return None
    record(STARTED)
    with _held(spark, f"{folder}/{attempt:06d}", lease):
        try:
            work()
            status = DONE
        except Exception as e:  # noqa: BLE001 - the stream goes on; the kind of error is recorded, not its text
            status = f"{FAILED}: {type(e).__name__}"
        record(status)
    return status


def _run_all(messages: DataFrame, job: Callable[[SparkSession, dict], None], processed: str, lease: float) -> list[tuple]:
    """Run the job of each complete message that is not done, oldest first; (coordinates, outcome) of those this driver ran."""
    spark, names = messages.sparkSession, list(COORDINATES)
    required = {BOTH_TOPIC: REQUIRED_KEYS[BOTH_TOPIC]}
    good = accepted(_checked(messages, required, {})).select(*names, F.from_json("value", "map<string,string>").alias("spec"))
    outcomes = _done(spark, processed).groupBy(*names).agg(
        F.count_if(F.col("status") == DONE).alias("n_done"), F.count_if(F.col("status").startswith(FAILED)).alias("n_failed")
    )
    todo = good.dropDuplicates(names).join(outcomes, names, "left").where("coalesce(n_done, 0) = 0")
    ran = []
    for row in todo.orderBy("partition", "offset").toLocalIterator():
        at = (row.topic, row.partition, row.offset)
        status = _run_claimed(spark, at, row.n_failed or 0, processed, lease, lambda spec=row.spec: job(spark, dict(spec)))
        ran += [(at, status)] if status else []
    return ran


def run_on_messages(
    messages: DataFrame,
    job: Callable[[SparkSession, dict], None],
    processed: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    lease: float = LEASE,
) -> StreamingQuery:
    """Run ``job(spark, message)`` once for each complete message on the combined topic.

    A table of messages and what became of them, kept at ``processed``, makes a restarted stream skip what is
    done. A failing job is recorded there and does not stop the stream; bad messages neither. Several drivers may read the
    same messages: each job is claimed by creating a file next to that table, and only one can. A driver that is gone
    without an outcome loses its claim after ``lease`` seconds. :func:`retry_messages` tries the failed and interrupted
    jobs again. A job that was interrupted runs again, so let it replace what it writes.
    """

    def run_batch(batch: DataFrame, _: int) -> None:
        _run_all(batch, job, processed, lease)

    writer = messages.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def retry_messages(
    spark: SparkSession, source: ControlSource, job: Callable[[SparkSession, dict], None], processed: str, *, lease: float = LEASE
) -> list[tuple]:
    """Run the jobs of all messages at the source that failed, were interrupted or never tried; no stream or checkpoint takes part.

    Returns ((topic, partition, offset), outcome) of the jobs that this call ran.
    """
    return _run_all(control_batch(spark, source), job, processed, lease)


def run_when_ready(
    messages: DataFrame,
    job: Callable[[SparkSession, dict[str, dict]], None],
    sides: Iterable[str] = (DOCUMENTS_TOPIC, RELATIONAL_TOPIC),
) -> bool:
    """Run ``job(spark, {topic: message})`` once when every side has sent a complete message.

    Reads the messages there are now, from the earliest, and stops; the last complete message of a
    side counts. Returns whether the job ran; while a side is missing, call again later.
    """
    spark, sides, known = messages.sparkSession, list(sides), {}
    required = {t: REQUIRED_KEYS[t] for t in sides}

    def take(batch: DataFrame, _: int) -> None:
        last = accepted(_checked(batch, required, {})).groupBy("topic").agg(
            F.max(_order()).alias("at"), F.max_by("value", _order()).alias("value")
        )
        for row in last.select("topic", "at", F.from_json("value", "map<string,string>").alias("spec")).collect():
            at = (row.at.timestamp is not None, row.at.timestamp, row.at.partition, row.at.offset)
            if row.topic not in known or at > known[row.topic][0]:
                known[row.topic] = (at, dict(row.spec))

    writer = messages.writeStream.foreachBatch(take).option("checkpointLocation", scratch_dir(spark, "control"))
    writer.trigger(availableNow=True).start().awaitTermination()
    ready = set(known) == set(sides)
    if ready:
        job(spark, {topic: spec for topic, (_, spec) in known.items()})
    return ready


def run_when_all_known(
    spark: SparkSession,
    source: ControlSource,
    job: Callable[[SparkSession, dict[str, dict]], None],
    state: str,
    sides: Iterable[str] = (DOCUMENTS_TOPIC, RELATIONAL_TOPIC),
    *,
    required: dict[str, Iterable[str]] = REQUIRED_KEYS,
    lease: float = LEASE,
) -> str | None:
    """Run ``job(spark, {topic: message})`` once for each new set of last messages, one of every side, over any number of restarts.

    Which message of a topic is the last is kept by a streaming aggregation below ``state``: a call reads only messages that
    came since the one before, by whatever process, and ends. Its table holds coordinates and no values, so secrets stay in
    the messages; those of the last ones are read again when the job runs. The set is claimed as in :func:`run_on_messages`.
    Returns the outcome of the job, or None if it did not run: a side is missing, or the set is done or another driver's.
    """
    sides, state = sorted(sides), state.rstrip("/")
    latest = latest_per_topic(parse_control(control_stream(spark, source), {t: required[t] for t in sides}, {}))
    keep_table(latest, f"{state}/latest", f"{state}/checkpoint", "complete").awaitTermination()
    if not path_exists(spark, f"{state}/latest"):
        return None
    known = spark.read.schema(latest.schema).parquet(f"{state}/latest").select(*COORDINATES)
    if not job_ready(known, sides).head().ready:
        return None
    rows = known.where(F.col("topic").isin(*sides)).orderBy("topic").collect()  # a row per side
    at = (" ".join(f"{r.topic}/{r.partition}/{r.offset}" for r in rows), 0, 0)
    processed = f"{state}/processed"
    outcomes = [r.status for r in _done(spark, processed).where(F.col("topic") == at[0]).collect()]
    if DONE in outcomes:
        return None

    def work() -> None:
        found = control_batch(spark, source).join(F.broadcast(known.where(F.col("topic").isin(*sides))), list(COORDINATES), "left_semi")
        specs = found.select("topic", F.from_json("value", "map<string,string>").alias("spec")).dropDuplicates(["topic"])
        job(spark, {r.topic: dict(r.spec) for r in specs.collect()})

    return _run_claimed(spark, at, sum(s.startswith(FAILED) for s in outcomes), processed, lease, work)
