"""Structured Streaming jobs.

Every job is a source -> transformations -> sink with a checkpoint in the
shared checkpoint folder, so a restarted (or partially failed) query resumes
exactly where it stopped. Keyed state is Spark's own aggregation state or a
versioned Parquet snapshot, and messages pass an event log that keeps each once;
both are written by ``foreachBatch`` under the batch id, so a replayed batch
replaces what it wrote before.
"""
from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.fold import guarded_fold
from ..operators.latest import latest_by
from ..plans.pricing import avg_of_latest, recommendations
from ..plans.staging import COMPETITOR_ORDER
from ..plans.state import INVENTORY_ORDER
from ..sources.streams import decodable, message


def event_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session time zone is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def dedup(stream: DataFrame, key: str = "event_id", ts: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """Drop repeated ``key`` within the watermark delay (state is bounded by it, rows older
    than the watermark are dropped; ``append_new`` keeps them)."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# Fixed values from the reference: ingest flushes every 2 s, pricing runs every 60 s.
INGEST_TRIGGER = {"processingTime": "2 seconds"}
PRICING_TRIGGER = {"processingTime": "60 seconds"}


def start(df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
          output_mode: str = "append", trigger: dict | None = None, fmt: str | None = None,
          path: str | None = None, partition_by: Sequence[str] | None = None) -> StreamingQuery:
    """Start a query with a checkpoint and a trigger.

    ``trigger`` defaults to ``{'processingTime': '2 seconds'}`` (the reference's
    flush interval); tests pass ``{'availableNow': True}``.
    """
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(**(trigger or INGEST_TRIGGER))
    if sink is not None:
        return w.foreachBatch(sink).start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.format(fmt or "parquet").start(path)


# ---------------------------------------------------------------- snapshots

class Snapshot:
    """A keyed table kept by the batches of a stream, in ``buckets`` by a hash of its keys.

    A batch rewrites the buckets that hold its keys and no others
    (``<path>/data/v=<batch_id>/_bucket=<n>``) and then publishes, under its number and
    as its last step, which version of each bucket counts
    (``<path>/_versions/<batch_id>.json``). A batch that failed half-way leaves nothing
    visible; a replayed one starts from the versions before it and replaces its own.
    Versions that neither the newest nor the one before it names are removed, so the
    table takes at most twice its size plus what a batch writes."""

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _published(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/_versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _pointer(self, version: int) -> dict:
        fs, p = self._fs(f"{self.path}/_versions/{version:020d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _before(self, batch_id: int | None) -> dict | None:
        ids = [i for i in self._published() if batch_id is None or i < batch_id]
        return self._pointer(ids[-1]) if ids else None

    def _folder(self, bucket: str, version: int) -> str:
        return f"{self.path}/data/v={version}/{self.BUCKET}={bucket}"

    def _rows(self, pointer: dict, buckets: Sequence[str]) -> DataFrame | None:
        folders = [self._folder(b, pointer["buckets"][b]) for b in buckets if b in pointer["buckets"]]
        schema = StructType.fromJson(pointer["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else None

    def read(self, before: int | None = None) -> DataFrame | None:
        """The whole table as of the newest batch (before batch ``before``), or None."""
        pointer = self._before(before)
        return None if pointer is None else self._rows(pointer, list(pointer["buckets"]))

    def merge(self, batch: DataFrame, batch_id: int, keys: Sequence[str],
              merged: Callable[[DataFrame | None, DataFrame], DataFrame]) -> list[str]:
        """Replace the buckets of ``batch``'s keys by ``merged(kept rows of them, batch)``;
        returns those buckets."""
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        touched = [str(r[0]) for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        before = self._before(batch_id)
        new = merged(None if before is None else self._rows(before, touched), batch)
        self._publish(new, bucket, touched, before, batch_id)
        return touched

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Replace the whole table."""
        self._publish(df, F.lit(0), ["0"], None, batch_id)

    def _publish(self, new: DataFrame, bucket: Column, touched: Sequence[str], before: dict | None, batch_id: int) -> None:
        if touched:
            out = new.withColumn(self.BUCKET, bucket)
            # rows of a bucket meet in a task, but a whole table keeps its partitions
            (out.repartition(self.BUCKET) if len(touched) > 1 else out).write.mode("overwrite") \
                .partitionBy(self.BUCKET).parquet(f"{self.path}/data/v={batch_id}")
        kept = {} if before is None else before["buckets"]
        pointer = {"schema": new.schema.jsonValue(), "buckets": kept | {b: batch_id for b in touched}}
        fs, target = self._fs(f"{self.path}/_versions/{batch_id:020d}.json")
        _, draft = self._fs(f"{self.path}/_versions/{batch_id:020d}.draft")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(pointer).encode()))
        stream.close()
        if fs.exists(target):
            fs.delete(target, False)
        fs.rename(draft, target)
        self._forget(batch_id)

    def _forget(self, batch_id: int) -> None:
        ids = [i for i in self._published() if i <= batch_id]
        stay = {(b, v) for i in ids[-2:] for b, v in self._pointer(i)["buckets"].items()}
        for i in ids[:-2]:
            for b, v in self._pointer(i)["buckets"].items():
                if (b, v) not in stay:
                    fs, p = self._fs(self._folder(b, v))
                    fs.delete(p, True)
            fs, p = self._fs(f"{self.path}/_versions/{i:020d}.json")
            fs.delete(p, False)


def upsert_sink(snapshot: Snapshot, keys: Sequence[str], order: Sequence[str]):
    """foreachBatch sink: merge the batch's updated rows into the snapshot."""
    def run(batch: DataFrame, batch_id: int) -> None:
        snapshot.merge(batch, batch_id, keys, lambda kept, new: latest_by(
            new if kept is None else kept.unionByName(new), keys, order))
    return run


def additive_sink(snapshot: Snapshot, keys: Sequence[str], sums: Sequence[str], maxes: Sequence[str] = ()):
    """foreachBatch sink: add the batch's per-key partial counts to the snapshot."""
    def run(batch: DataFrame, batch_id: int) -> None:
        def add(kept, new):
            both = new if kept is None else kept.unionByName(new)
            return both.groupBy(*keys).agg(*[F.sum(c).cast(batch.schema[c].dataType).alias(c) for c in sums],
                                           *[F.max(c).alias(c) for c in maxes])
        snapshot.merge(batch, batch_id, keys, add)
    return run


# ---------------------------------------------------------------- jobs

def product_counts(events: DataFrame) -> DataFrame:
    """Per-product partial counters of one batch (or a whole stream)."""
    t = F.col("event_type")
    return (events.filter(F.col("product_id").isNotNull())
            .groupBy("product_id").agg(
                F.count_if(t == "product_view").cast("bigint").alias("total_views"),
                F.count_if(t == "add_to_cart").cast("bigint").alias("total_cart_adds"),
                F.count_if(t == "purchase").cast("bigint").alias("total_purchases"),
                F.coalesce(F.sum(F.when(t == "purchase", F.coalesce(F.col("product_price"), F.lit(0)))),
                           F.lit(0)).cast("decimal(20,2)").alias("revenue")))


def append_new(batch: DataFrame, log_path: str, batch_id: int, key: str = "event_id", ts: str = "timestamp",
               unit: str = "day") -> DataFrame:
    """Write the batch's rows whose ``key`` is in no earlier batch to the event log,
    ``<log>/batch=N/date=...`` (the first date of the ``unit``), and return them.

    A repeated message finds itself in the log however late it comes (a repetition
    has the same time, so only the batch's dates are read), a late message is a row
    like any other, and a replayed batch replaces its own files.

    Whole rows are shuffled twice, by key and by date. The shuffle by key comes first:
    dropping repetitions before it would sort (and spill) every row on both sides."""
    spark = batch.sparkSession
    date = F.to_date(F.date_trunc(unit, ts))
    lo, hi = batch.agg(F.min(date), F.max(date)).first()
    rows = batch.repartition(key).withColumn("date", date)
    seen = event_log(spark, log_path, rows.schema)
    if seen is not None and lo is not None:
        seen = seen.filter((F.col("batch") < batch_id) & F.col("date").between(lo, hi)).select(key)
        rows = rows.join(seen, key, "left_anti")
    # as dropDuplicates, which takes the first value of each column one by one
    one = rows.groupBy(key).agg(F.first(F.struct(*[c for c in rows.columns if c != key])).alias("_row"))
    rows = one.select(key, "_row.*").select(*rows.columns)
    path = os.path.join(log_path, f"batch={batch_id}")
    schema = rows.schema
    # a date's rows meet in a task, but a large date is split over several
    rows.hint("rebalance", "date").write.mode("overwrite").option("compression", "zstd").partitionBy("date").parquet(path)
    return spark.read.schema(schema).parquet(path)


def event_log(spark: SparkSession, log_path: str, schema: StructType) -> DataFrame | None:
    """All batches of the event log (columns of ``schema``, ``batch``), or None."""
    try:
        return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(log_path)
    except AnalysisException:
        return None


def log_sink(log_path: str):
    """foreachBatch sink that keeps every message once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, log_path, batch_id)
    return run


def clickstream_fanout(spark: SparkSession, events: DataFrame, log_path: str, metrics: Snapshot):
    """One read of the clickstream feeds both the event log and the product
    counters; a message counts once however often it is delivered."""
    def run(batch: DataFrame, batch_id: int) -> None:
        new = append_new(batch, log_path, batch_id)
        additive_sink(metrics, ["product_id"],
                      ["total_views", "total_cart_adds", "total_purchases", "revenue"])(product_counts(new), batch_id)
    return run


def running_product_metrics(events: DataFrame) -> DataFrame:
    """T4 on a feed without repetitions: streaming aggregation of the counters
    (update mode, Spark-managed state)."""
    return product_counts(events)


STOCK_KEYS = ["product_id", "warehouse_id"]


def stock_sink(snapshot: Snapshot, log_path: str | None = None):
    """foreachBatch sink that folds a batch into the guarded stock; with an
    event log a change counts once however often its message is delivered.

    Within a batch the rows are applied in (time, tie-break) order, across batches in
    arrival order (equal to the batch fold when the feed is time ordered). The fold is
    the batch one, seeded from the snapshot, so a hot key is no single frame."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if log_path is not None:
            batch = append_new(batch, log_path, batch_id, unit="month")

        def folded(kept, new):
            init = None if kept is None else kept.select(*STOCK_KEYS, F.col("current_stock").alias("stock"))
            both = guarded_fold(new, STOCK_KEYS, INVENTORY_ORDER, "quantity_change", init=init).select(
                *STOCK_KEYS, "current_stock", F.col("skipped").alias("skipped_changes"), "events", F.lit(1).alias("_new"))
            if kept is not None:
                both = both.unionByName(kept.withColumn("_new", F.lit(0)))
            return both.groupBy(*STOCK_KEYS).agg(
                F.max_by("current_stock", "_new").alias("current_stock"),
                F.sum("skipped_changes").alias("skipped_changes"), F.sum("events").alias("events"))
        snapshot.merge(batch, batch_id, STOCK_KEYS, folded)
    return run


def latest_competitor_prices(cp_stream: DataFrame) -> DataFrame:
    """Latest price per (product, competitor) by event time (late, older
    observations never replace newer ones)."""
    cols = ["competitor_price", "our_price", "price_difference", "price_difference_pct", *COMPETITOR_ORDER[:-1]]
    return latest_by(cp_stream.select("product_id", "competitor_name", *cols),
                     ["product_id", "competitor_name"], COMPETITOR_ORDER)


def throughput(stream: DataFrame, window: str = "10 seconds", seconds: float = 10.0,
               delay: str = "1 hour", ts: str = "timestamp", by: Sequence[str] = ()) -> DataFrame:
    """Events per second in tumbling windows (append: closed windows only), for each
    value of the columns ``by``."""
    s = event_time(stream, ts).withWatermark(ts, delay)
    return s.groupBy(*by, F.window(ts, window).alias("w")).agg(F.count(F.lit(1)).alias("events")).select(
        *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events",
        (F.col("events") / F.lit(seconds)).alias("events_per_sec"))


def named_streams(streams: dict[str, DataFrame], ts: str = "timestamp") -> DataFrame:
    """(stream, time) of several streams as one."""
    out = None
    for name, s in streams.items():
        one = event_time(s, ts).select(F.lit(name).alias("stream"), ts)
        out = one if out is None else out.unionByName(one)
    return out


def pricing_trigger(spark: SparkSession, recs: Snapshot, build: Callable[[DataFrame, int], DataFrame]):
    """On every trigger (``PRICING_TRIGGER`` in production) recompute the recommendations
    with the batch's latest event time as ``as_of`` and write a new version."""
    def run(batch: DataFrame, batch_id: int) -> None:
        recs.write(build(batch, batch_id), batch_id)
    return run


# ---------------------------------------------------------------- pricing from kept state

PANE = "hour"


class Pricing:
    """T7 without reading history: purchases are kept as counts by (product, pane), an
    hour each, the newest event time as one row, prices as the latest row per (product,
    competitor) that T6 keeps. A trigger adds its new events to the panes, takes whole
    panes for the look-back and reads single events for the one pane that the look-back
    cuts, from its date in the event log. Panes that have left the look-back go when
    their bucket is next written."""

    def __init__(self, spark: SparkSession, base: str, lookback: str, buckets: int = 32):
        self.spark, self.lookback, self.log = spark, lookback, base + "/log"
        self.panes = Snapshot(spark, base + "/panes", buckets)
        self.clock = Snapshot(spark, base + "/clock", 1)

    def _start(self, at: Column) -> Column:
        return at - F.expr(f"INTERVAL '{self.lookback}'")

    def add(self, batch: DataFrame, batch_id: int) -> Column:
        """Take in a batch; returns the time as of which to price."""
        new = append_new(batch, self.log, batch_id)
        additive_sink(self.clock, ["one"], [], ["newest"])(
            new.groupBy(F.lit(1).alias("one")).agg(F.max("timestamp").alias("newest")), batch_id)
        newest = self.clock.read(before=batch_id + 1).first()["newest"]  # one row
        at = F.lit(str(newest)).cast(new.schema["timestamp"].dataType)
        counts = (purchases(new).groupBy("product_id", F.date_trunc(PANE, "timestamp").cast("timestamp_ntz").alias("pane"))
                  .agg(F.count("*").alias("n")))

        def merged(kept: DataFrame | None, added: DataFrame) -> DataFrame:
            both = added if kept is None else kept.unionByName(added)
            # a pane that the look-back has passed is not needed again: time only moves on
            return (both.where(F.col("pane") >= F.date_trunc(PANE, self._start(at)).cast("timestamp_ntz"))
                    .groupBy("product_id", "pane").agg(F.sum("n").alias("n")))
        self.panes.merge(counts, batch_id, ["product_id"], merged)
        return at

    def demand(self, at: Column, batch_id: int) -> DataFrame:
        """Purchases per product within the look-back before ``at``."""
        cut = F.date_trunc(PANE, self._start(at)).cast("timestamp_ntz")
        parts = None
        panes = self.panes.read(before=batch_id + 1)
        if panes is not None:
            parts = panes.where(F.col("pane") > cut).select("product_id", "n")
        schema = self.spark.read.parquet(f"{self.log}/batch={batch_id}").schema
        events = event_log(self.spark, self.log, schema)
        edge = purchases(events.where((F.col("batch") <= batch_id) & (F.col("date") == F.to_date(cut)))).where(
            (F.col("timestamp") > self._start(at)) & (F.date_trunc(PANE, "timestamp").cast("timestamp_ntz") == cut)).select(
            "product_id", F.lit(1).cast("long").alias("n"))
        rows = edge if parts is None else parts.unionByName(edge)
        return rows.groupBy("product_id").agg(F.sum("n").cast("double").alias("demand_velocity"))


def purchases(events: DataFrame) -> DataFrame:
    return events.where((F.col("event_type") == "purchase") & F.col("product_id").isNotNull())


def pricing_from_state(state: Pricing, prices: Snapshot, products: DataFrame, recs: Snapshot):
    """foreachBatch sink that prices every product from kept state alone."""
    def run(batch: DataFrame, batch_id: int) -> None:
        at = state.add(batch, batch_id)
        recs.write(recommendations(products, avg_of_latest(prices.read()), state.demand(at, batch_id), at), batch_id)
    return run


# ---------------------------------------------------------------- three topics from one entry

@dataclass(frozen=True)
class Feed:
    """What the messages of a topic hold: columns, the column that identifies a message and
    its time, and how wide the folders of the topic's event log are."""
    schema: StructType
    key: str = "event_id"
    ts: str = "timestamp"
    unit: str = "day"


STAGED_GROUP = 32 << 20  # bytes of a row group, which each writing task buffers


def decoded(batch: DataFrame, feeds: dict[str, Feed]) -> DataFrame:
    """(topic, lost, raw_message, ``<k>_<column>`` of the k-th feed) of the feeds' messages.

    ``lost`` are the undecodable ones, with their text, and those without their key, written
    anew. Each message is decoded once, by its topic's schema: a filter on a parsed frame
    would be pushed below the parsing and parse it again."""
    parsed = batch.where(F.col("topic").isin(*feeds)).select("topic", "value", *[
        F.when(F.col("topic") == topic, message(F.col("value"), feed.schema)).alias(f"_{k}")
        for k, (topic, feed) in enumerate(feeds.items())])
    bad, raw, columns = F.lit(True), F.col("value"), []
    for k, (topic, feed) in enumerate(feeds.items()):
        m, mine = F.col(f"_{k}"), F.col("topic") == topic
        keyed = m.getField(feed.key).isNotNull() & m.getField(feed.ts).isNotNull()
        bad = F.when(mine, ~(decodable(m) & keyed)).otherwise(bad)
        again = F.to_json(F.struct(*[m.getField(c).alias(c) for c in feed.schema.names]))
        raw = F.when(mine & decodable(m), F.when(~keyed, again)).otherwise(raw)
        columns += [m.getField(c).alias(f"{k}_{c}") for c in feed.schema.names]
    return parsed.select("topic", bad.alias("lost"), raw.alias("raw_message"), *columns)


def ingest_sink(base: str, feeds: dict[str, Feed]):
    """foreachBatch sink for rows (topic, value) of several topics.

    A batch is read from its source and decoded once, and staged as Parquet in typed columns:
    one held in the executors' storage would grow with the batch. Of each topic, messages not
    seen before go to ``<base>/<topic>/log``, undecodable ones and those without their key to
    ``<base>/<topic>/dead_letter/batch=N``, and the batch's counts (received, kept,
    duplicates, errors) to ``<base>/counters/batch=N``. All are written under the batch id,
    so a replayed batch replaces what it wrote. Other topics' messages are left out."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{base}/staged/batch={batch_id}"
        rows = decoded(batch, feeds)
        # ids and texts differ from row to row: a dictionary is built in vain
        (rows.write.mode("overwrite").option("parquet.block.size", STAGED_GROUP)
         .option("parquet.enable.dictionary", "false").parquet(staged))
        rows = spark.read.schema(rows.schema).parquet(staged)
        try:
            counts = None
            for k, (topic, feed) in enumerate(feeds.items()):
                mine = rows.where(F.col("topic") == topic)
                lost = mine.where("lost").select("raw_message")
                dead = f"{base}/{topic}/dead_letter/batch={batch_id}"
                lost.write.mode("overwrite").parquet(dead)
                good = mine.where("NOT lost").select(*[F.col(f"`{k}_{c}`").alias(c) for c in feed.schema.names])
                new = append_new(good, f"{base}/{topic}/log", batch_id, feed.key, feed.ts, feed.unit)
                for df, name in ((mine, "received"), (new, "kept"), (spark.read.schema(lost.schema).parquet(dead), "errors")):
                    one = df.agg(F.count("*").alias("n")).select(F.lit(topic).alias("topic"), F.lit(name).alias("what"), "n")
                    counts = one if counts is None else counts.unionByName(one)
            wide = counts.groupBy("topic").pivot("what", ["received", "kept", "errors"]).sum("n")
            (wide.withColumn("duplicates", F.col("received") - F.col("kept") - F.col("errors"))
             .coalesce(1).write.mode("overwrite").parquet(f"{base}/counters/batch={batch_id}"))  # a row a topic
        finally:
            target = spark._jvm.org.apache.hadoop.fs.Path(staged)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return run


def stream_counters(spark: SparkSession, base: str) -> DataFrame:
    """Totals of every stream over the batches so far."""
    return spark.read.parquet(base + "/counters").groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in ("received", "kept", "duplicates", "errors")])


def drain(query: StreamingQuery, delay: float) -> None:
    """Let a query over topics take all that has landed, the last messages after ``delay``
    seconds included, and stop it."""
    try:
        query.processAllAvailable()
        time.sleep(delay)
        query.processAllAvailable()
    finally:
        query.stop()
