import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from docferry.session import create_new
from docferry.streaming import (
    control_stream,
    job_ready,
    keep_table,
    latest_per_topic,
    parse_control,
    quarantine,
    retry_messages,
    run_on_messages,
    run_when_all_known,
    run_when_ready,
)
from docferry.streaming.control import BOTH_TOPIC, DOCUMENTS_TOPIC, RELATIONAL_TOPIC, ControlSource, _claims


def sql_message(database, **more):
    return json.dumps({"url": "h", "username": "u", "password": "pw-secret", "database": database, **more})


NOSQL = json.dumps({"uri": "uri-secret", "collection": "docs"})
MESSAGES = [
    (RELATIONAL_TOPIC, 1, sql_message("a-b")),
    (RELATIONAL_TOPIC, 2, "not json"),
    (RELATIONAL_TOPIC, 3, json.dumps({"url": "h", "username": "u", "database": "c"})),
    (RELATIONAL_TOPIC, 4, sql_message("d")),
    (DOCUMENTS_TOPIC, 5, NOSQL),
    ("other", 6, NOSQL),
    (DOCUMENTS_TOPIC, 7, "[1]"),
    (DOCUMENTS_TOPIC, 8, None),
    (DOCUMENTS_TOPIC, 9, json.dumps({"uri": None, "collection": "x"})),
]


@pytest.fixture
def inbox(tmp_path):
    path = tmp_path / "inbox"
    path.mkdir()

    def put(messages):
        n = len(list(path.iterdir()))
        rows = [{"topic": t, "partition": 0, "offset": o, "value": v} for t, o, v in messages]
        (path / f"{n:03d}.json").write_text("\n".join(map(json.dumps, rows)))
        return ControlSource(path=str(path))

    return put


def drain(stream, tmp_path, label, mode):
    run = keep_table(stream, str(tmp_path / label), str(tmp_path / f"{label}-cp"), mode)
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / label))


def test_parse_and_quarantine(spark, inbox, tmp_path):
    parsed = parse_control(control_stream(spark, inbox(MESSAGES)))
    assert parsed.isStreaming
    rows = {r.offset: (r.status, r.reason) for r in drain(parsed, tmp_path, "all", "append").collect()}
    assert rows == {
        1: ("accepted", None),
        2: ("bad json", "bad json"),
        3: ("missing key", "password"),
        4: ("accepted", None),
        5: ("accepted", None),
        6: ("unknown topic", "unknown topic"),
        7: ("bad json", "bad json"),
        8: ("bad json", "bad json"),
        9: ("missing key", "uri"),
    }
    bad = drain(quarantine(parse_control(control_stream(spark, inbox([])))), tmp_path, "bad", "append")
    assert sorted(r.offset for r in bad.collect()) == [2, 3, 6, 7, 8, 9]


def test_no_secret_is_passed_on(spark, inbox, tmp_path):
    parsed = parse_control(control_stream(spark, inbox(MESSAGES)))
    text = json.dumps([r.asDict(True) for r in drain(parsed, tmp_path, "all", "append").collect()])
    assert "secret" not in text and '"a-b"' in text


def test_latest_and_ready_over_several_batches(spark, inbox, tmp_path):
    source = inbox(MESSAGES[:3])
    latest = latest_per_topic(parse_control(control_stream(spark, source)))
    one = drain(latest, tmp_path, "latest", "complete")
    assert [(r.offset, r.shown) for r in one.collect()] == [(1, {"database": "a-b"})]
    assert job_ready(one).head().asDict() == {"n_sides": 1, "ready": False}
    inbox(MESSAGES[3:])
    two = drain(latest, tmp_path, "latest", "complete")
    assert sorted((r.offset, r.shown, r.n_messages) for r in two.collect()) == [
        (4, {"database": "d"}, 2),
        (5, {"collection": "docs"}, 1),
    ]
    assert job_ready(two).head().asDict() == {"n_sides": 2, "ready": True}


def both(database):
    keys = ("sql_host", "sql_port", "sql_user", "sql_password", "mongo_uri", "mongo_db_name")
    return json.dumps({**{k: "x" for k in keys}, "sql_database": database})


def test_one_run_per_message(spark, inbox, tmp_path):
    ran = []

    def job(session, message):
        ran.append(message["sql_database"])
        if message["sql_database"] == "broken":
            raise RuntimeError("x")

    done = str(tmp_path / "done")
    source = inbox([(BOTH_TOPIC, 1, both("one")), (BOTH_TOPIC, 2, "junk"), (BOTH_TOPIC, 3, both("broken")), (BOTH_TOPIC, 4, both("two"))])

    def run(checkpoint):
        run_on_messages(control_stream(spark, source), job, done, str(tmp_path / checkpoint)).awaitTermination()

    run("cp")
    assert ran == ["one", "broken", "two"]
    run("cp")
    assert ran == ["one", "broken", "two"]
    run("new-checkpoint")
    assert ran == ["one", "broken", "two", "broken"]
    inbox([(BOTH_TOPIC, 5, both("three"))])
    run("cp")
    assert ran[4:] == ["three"]
    told = spark.read.json(done).where("status <> 'started'").select("offset", F.col("status"))
    assert {r.offset: r.status for r in told.collect()} == {1: "done", 3: "failed: RuntimeError", 4: "done", 5: "done"}


def test_job_runs_when_both_sides_are_known(spark, inbox):
    ran = []
    job = lambda session, sides: ran.append({t: m.get("database") or m["collection"] for t, m in sides.items()})
    source = inbox(MESSAGES[:4])
    assert run_when_ready(control_stream(spark, source), job) is False and ran == []
    inbox(MESSAGES[4:])
    assert run_when_ready(control_stream(spark, source), job) is True
    assert ran == [{RELATIONAL_TOPIC: "d", DOCUMENTS_TOPIC: "docs"}]


def test_database_names():
    from docferry.plans.jobs import documents_database, relational_database

    assert relational_database({"database": "a-b-1"}) == "a_b_1"
    assert documents_database({"mongo_db_name": "m", "sql_database": "s"}) == "m"
    assert documents_database({"mongo_db_name": "", "sql_database": "s"}) == "s"


def test_time_decides_across_partitions(spark):
    from datetime import datetime

    value = json.dumps({"uri": "u", "collection": "docs"})
    rows = [(DOCUMENTS_TOPIC, 0, 100, datetime(2024, 1, 1), value), (DOCUMENTS_TOPIC, 1, 5, datetime(2024, 1, 2), value), (DOCUMENTS_TOPIC, 1, 900, None, value)]
    messages = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, value string")
    last = latest_per_topic(parse_control(messages)).head()
    assert (last.partition, last.offset, last.n_messages) == (1, 5, 3)


def test_one_of_many_creates_a_file(spark, tmp_path):
    made, path = [], str(tmp_path / "claims" / "one")
    threads = [threading.Thread(target=lambda: made.append(create_new(spark, path))) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(made) == [False] * 7 + [True]


def test_failed_and_interrupted_jobs_are_tried_again(spark, inbox, tmp_path):
    ran, broken, done = [], {"two"}, str(tmp_path / "done")

    def job(session, message):
        ran.append(message["sql_database"])
        if message["sql_database"] in broken:
            raise RuntimeError("x")

    source = inbox([(BOTH_TOPIC, i, both(name)) for i, name in enumerate(("one", "two", "three"))])
    # a driver claimed the third message and was lost before it told what became of it
    assert create_new(spark, f"{_claims(done, (BOTH_TOPIC, 0, 2))}/000001")
    run_on_messages(control_stream(spark, source), job, done, str(tmp_path / "cp")).awaitTermination()
    assert ran == ["one", "two"]
    broken.clear()
    assert retry_messages(spark, source, job, done) == [((BOTH_TOPIC, 0, 1), "done")]
    time.sleep(0.3)
    assert retry_messages(spark, source, job, done, lease=0.2) == [((BOTH_TOPIC, 0, 2), "done")]
    assert retry_messages(spark, source, job, done, lease=0.0) == []
    assert ran == ["one", "two", "two", "three"]
    told = {(r.offset, r.attempt, r.status) for r in spark.read.json(done).collect() if r.status != "started"}
    assert told == {(0, 1, "done"), (1, 1, "failed: RuntimeError"), (1, 2, "done"), (2, 2, "done")}


def test_two_drivers_run_a_job_once(spark, inbox, tmp_path):
    ran, done = [], str(tmp_path / "done")

    def job(session, message):
        ran.append(message["sql_database"])
        time.sleep(2)  # longer than the lease, which the driver at work renews

    source = inbox([(BOTH_TOPIC, 1, both("one")), (BOTH_TOPIC, 2, both("two"))])
    with ThreadPoolExecutor(3) as drivers:
        told = list(drivers.map(lambda _: retry_messages(spark, source, job, done, lease=1.0), range(3)))
    assert sorted(status for one in told for _, status in one) == ["done", "done"]
    assert sorted(ran) == ["one", "two"]


def test_state_outlives_the_process(spark, inbox, tmp_path):
    ran, state = [], str(tmp_path / "state")
    job = lambda session, sides: ran.append({t: m.get("database") or m["collection"] for t, m in sides.items()})
    source = inbox(MESSAGES[:4])
    assert run_when_all_known(spark, source, job, state) is None and ran == []
    inbox(MESSAGES[4:])
    assert run_when_all_known(spark, source, job, state) == "done"
    assert run_when_all_known(spark, source, job, state) is None
    inbox([(RELATIONAL_TOPIC, 11, sql_message("e"))])

    def failing(session, sides):
        raise RuntimeError("x")

    assert run_when_all_known(spark, source, failing, state) == "failed: RuntimeError"
    assert run_when_all_known(spark, source, job, state) == "done"
    assert ran == [{RELATIONAL_TOPIC: "d", DOCUMENTS_TOPIC: "docs"}, {RELATIONAL_TOPIC: "e", DOCUMENTS_TOPIC: "docs"}]
    kept = [p for p in (tmp_path / "state").rglob("*") if p.is_file() and b"secret" in p.read_bytes()]
    assert kept == []
