"""Topics as a source: batches by size or time, starts at the end, restarts, and the sink of three topics."""
import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import topics
from shelfcast.sources.topics import TopicReader
from shelfcast.streaming import jobs


def _land(spark, base, topic, delivery, values):
    topics.land(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), base, topic, delivery)


def _reader(base, names, **options):
    return TopicReader({"path": base + "/l", "state": base + "/s", "topics": ",".join(names), "startingOffsets": "earliest",
                        **{k: str(v) for k, v in options.items()}})


def _values(reader, start, end):
    return [(t, v) for p in reader.partitions(start, end) for b in reader.read(p)
            for t, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]


def test_a_batch_starts_at_its_size_or_after_the_delay(spark):
    base = tempfile.mkdtemp()
    _land(spark, base + "/l", "a", "0", [str(i) for i in range(25)])
    r = _reader(base, ["a", "none"], minRecords=10, maxRecords=10, maxDelay=0.3)
    at, got = r.initialOffset(), []
    for _ in range(2):
        end = r.latestOffset()
        assert end != at
        got += _values(r, at, end)
        at = end
    assert len(got) == 20 and r.latestOffset() == at    # five wait
    time.sleep(0.35)
    end = r.latestOffset()
    got += _values(r, at, end)
    assert [v for _, v in got] == [str(i) for i in range(25)] and r.latestOffset() == end


def test_topics_share_a_batch_and_a_short_one_leaves_its_room(spark):
    base = tempfile.mkdtemp()
    _land(spark, base + "/l", "a", "0", ["a"] * 100)
    _land(spark, base + "/l", "b", "0", ["b"] * 3)
    _land(spark, base + "/l", "b", "1", ["b"] * 3)
    r = _reader(base, ["a", "b"], minRecords=1, maxRecords=20)
    at = r.initialOffset()
    first = _values(r, at, r.latestOffset())
    assert sorted(first) == [("a", "a")] * 14 + [("b", "b")] * 6


def test_a_delivery_counts_once_complete_and_latest_starts_behind_it(spark):
    base = tempfile.mkdtemp()
    _land(spark, base + "/l", "a", "0", ["x", "y"])
    r = _reader(base, ["a"], minRecords=1, startingOffsets="latest")
    at = r.initialOffset()
    assert r.latestOffset() == at
    _land(spark, base + "/l", "a", "1", ["z"])
    os.rename(base + "/l/a/1/_SUCCESS", base + "/l/a/1/_later")
    assert r.latestOffset() == at
    os.rename(base + "/l/a/1/_later", base + "/l/a/1/_SUCCESS")
    assert _values(r, at, r.latestOffset()) == [("a", "z")]


def test_a_restart_is_given_the_kept_position_first(spark):
    base = tempfile.mkdtemp()
    _land(spark, base + "/l", "a", "0", [str(i) for i in range(9)])
    r = _reader(base, ["a"], minRecords=1, maxRecords=4)
    start, first = r.initialOffset(), r.latestOffset()
    again = _reader(base, ["a"], minRecords=1, maxRecords=4)
    assert again.latestOffset() == first and again.initialOffset() == start
    assert [v for _, v in _values(again, first, again.latestOffset())] == ["4", "5", "6", "7"]


@pytest.mark.parametrize("row_group", [3, 1000])
def test_rows_of_a_file_are_cut_across_row_groups(row_group):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base = tempfile.mkdtemp()
    os.makedirs(base + "/l/a/0")
    pq.write_table(pa.table({"value": [str(i) if i % 4 else None for i in range(20)]}), base + "/l/a/0/p.parquet", row_group_size=row_group)
    open(base + "/l/a/0/_SUCCESS", "w").close()
    r = _reader(base, ["a"])
    for lo in range(21):
        for hi in range(lo, 21):
            got = [v for _, v in _values(r, {"a": ["0", "p.parquet", lo]}, {"a": ["0", "p.parquet", hi]})]
            assert got == [str(i) if i % 4 else None for i in range(lo, hi)]


def test_a_large_file_is_read_by_several_tasks_a_row_group_by_one(monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base = tempfile.mkdtemp()
    os.makedirs(base + "/l/a/0")
    pq.write_table(pa.table({"value": [str(i) for i in range(20)]}), base + "/l/a/0/p.parquet", row_group_size=3)
    pq.write_table(pa.table({"value": pa.array([], pa.string())}), base + "/l/a/0/q.parquet")
    open(base + "/l/a/0/_SUCCESS", "w").close()
    monkeypatch.setattr(topics, "PIECE", 5)
    r = _reader(base, ["a"])

    def cuts(lo, hi):
        return [(p.start, p.end) for p in r.partitions({"a": ["0", "p.parquet", lo]}, {"a": ["0", *hi]})]
    assert cuts(0, ("q.parquet", 0)) == [(0, 6), (6, 12), (12, 18), (18, 20)]
    assert cuts(4, ("p.parquet", 17)) == [(4, 9), (9, 15), (15, 17)]
    assert cuts(4, ("p.parquet", 5)) == [(4, 5)] and cuts(20, ("q.parquet", 0)) == []
    assert [v for _, v in _values(r, {"a": ["", "", 0]}, {"a": ["0", "p.parquet", 20]})] == [str(i) for i in range(20)]


def test_three_topics_through_a_query_that_restarts(spark):
    base = tempfile.mkdtemp()
    schema = spark.createDataFrame([], "event_id string, timestamp timestamp_ntz, n int").schema
    msg = lambda i, n=1: json.dumps({"event_id": i, "timestamp": "2024-01-02T03:04:05", "n": n})
    _land(spark, base + "/l", "a", "0", [msg("1"), msg("1"), msg("2"), "{cut", None, json.dumps({"n": 4})])
    _land(spark, base + "/l", "b", "0", [msg("1", "no number"), msg("9")])
    sink = jobs.ingest_sink(base + "/o", {t: jobs.Feed(schema) for t in ("a", "b", "c")})

    def run():
        s = topics.topic_stream(spark, base + "/l", ["a", "b", "c"], base + "/s", starting="earliest", min_records=3, max_records=4, max_delay=0.5)
        jobs.drain(jobs.start(s, base + "/ck", sink=sink, trigger={"processingTime": "0 seconds"}), 0.5)
        return {r["topic"]: (r["received"], r["kept"], r["duplicates"], r["errors"]) for r in jobs.stream_counters(spark, base + "/o").collect()}
    assert run() == {"a": (6, 2, 1, 3), "b": (2, 1, 0, 1), "c": (0, 0, 0, 0)}
    _land(spark, base + "/l", "a", "1", [msg("2"), msg("3")])
    _land(spark, base + "/l", "c", "1", [msg("1")])
    assert run() == {"a": (8, 3, 2, 3), "b": (2, 1, 0, 1), "c": (1, 1, 0, 0)}
    log = spark.read.parquet(base + "/o/a/log")
    assert sorted(r["event_id"] for r in log.collect()) == ["1", "2", "3"]
    dead = spark.read.parquet(base + "/o/a/dead_letter").select(F.col("raw_message")).collect()
    assert len(dead) == 3


def test_an_ingested_batch_is_not_held_in_the_executors_storage(spark, monkeypatch):
    base = tempfile.mkdtemp()
    batch = spark.createDataFrame([("a", json.dumps({"event_id": str(i % 5), "timestamp": "2024-01-02T03:04:05"})) for i in range(9)]
                                  + [("b", None)], "topic string, value string")

    def held(*_):
        raise AssertionError("the batch is cached")
    for name in ("persist", "cache"):
        monkeypatch.setattr(type(batch), name, held)
    schema = spark.createDataFrame([], "event_id string, timestamp timestamp_ntz").schema
    jobs.ingest_sink(base, {t: jobs.Feed(schema) for t in ("a", "b")})(batch, 0)
    got = {r["topic"]: (r["received"], r["kept"], r["duplicates"], r["errors"]) for r in jobs.stream_counters(spark, base).collect()}
    assert got == {"a": (9, 5, 4, 0), "b": (1, 0, 0, 1)}
    assert not os.path.exists(base + "/staged/batch=0")


def test_an_ingested_message_is_decoded_once(spark, monkeypatch):
    base = tempfile.mkdtemp()
    schema = spark.createDataFrame([], "event_id string, timestamp timestamp_ntz, n int").schema
    good = json.dumps({"event_id": "1", "timestamp": "2024-01-02T03:04:05", "n": 1})
    lost = ["{cut", None, "", json.dumps({"n": 4}), json.dumps({"event_id": "2", "timestamp": "2024-01-02T03:04:05", "n": "x"})]
    batch = spark.createDataFrame([(t, v) for t in ("a", "b", "other") for v in [good, good, *lost]] + [(None, good)], "topic string, value string")
    ran, writer = [], type(batch.write)

    def counted(action, frame):
        def run(self, *args, **options):
            ran.append(frame(self)._jdf.queryExecution().optimizedPlan().toString().count("from_json("))
            return action(self, *args, **options)
        return run
    monkeypatch.setattr(writer, "parquet", counted(writer.parquet, lambda w: w._df))
    monkeypatch.setattr(type(batch), "collect", counted(type(batch).collect, lambda df: df))
    jobs.ingest_sink(base, {t: jobs.Feed(schema) for t in ("a", "b")})(batch, 0)
    monkeypatch.undo()
    assert sum(ran) == 2    # one a topic
    got = {r["topic"]: (r["received"], r["kept"], r["duplicates"], r["errors"]) for r in jobs.stream_counters(spark, base).collect()}
    assert got == {t: (7, 1, 1, 5) for t in ("a", "b")}
    for t in ("a", "b"):
        dead = [r[0] for r in spark.read.parquet(f"{base}/{t}/dead_letter").select("raw_message").collect()]
        assert sorted(dead, key=str) == sorted([*lost[:3], '{"n":4}', lost[4]], key=str)
        assert [tuple(r) for r in spark.read.parquet(f"{base}/{t}/log").select("event_id", "n").collect()] == [("1", 1)]


def test_a_second_delivery_repeats_the_messages_of_the_first(spark):
    from shelfcast import registry  # noqa: F401
    from shelfcast.queries_extra import _land_twice
    base = tempfile.mkdtemp()
    _land_twice(spark.range(50).select(F.expr("uuid()").alias("value")), base, "a")
    first, second = (sorted(r[0] for r in spark.read.parquet(f"{base}/a/{d}").collect()) for d in "01")
    assert first == second and len(set(first)) == 50
