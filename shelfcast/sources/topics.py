"""Message topics as a streaming source with batches by size or time.

A topic is a folder of deliveries, ``<path>/<topic>/<delivery>/*.parquet`` with a string
column ``value`` (one JSON message a row), such as ``land`` writes. A delivery counts once
its ``_SUCCESS`` is there, and deliveries are read in the order of their names, so a
producer names them in increasing order, as a log does; a delivery named before one that
was already read is not seen.

A micro-batch starts when ``minRecords`` messages wait over all topics, or when some have
waited for ``maxDelay`` seconds; it takes ``maxRecords`` at most, dealt over the topics so
that a full one holds up no other. The driver reads names and row counts (Parquet footers)
of what it is about to admit, never messages; executors read row ranges of the files.

The position reached is kept in the folder ``state`` before Spark is told of it. A restarted
query is first given that position again, so a batch that Spark had not yet recorded has
the rows that it would have had.
"""
from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Fixed values from the reference: a batch is flushed at 100 messages or after 2 s.
MIN_RECORDS = 100
MAX_DELAY = 2.0
MAX_RECORDS = 1_000_000

PIECE = 250_000           # a task reads whole row groups up to so many rows or more
LANDED_GROUP = 32 << 20   # bytes of a row group that ``land`` writes

SCHEMA = "topic string, delivery string, value string"
START = ("", "", 0)    # delivery, file, rows of it that are read


@dataclass
class Piece(InputPartition):
    """Rows ``start`` to ``end`` (exclusive) of a file."""
    topic: str
    delivery: str
    path: str
    start: int
    end: int


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class TopicReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.state = options["path"], options["state"]
        self.topics = [t for t in options["topics"].split(",") if t]
        self.latest = options.get("startingOffsets", "latest") == "latest"
        self.least = int(options.get("minRecords", MIN_RECORDS))
        self.most = int(options.get("maxRecords", MAX_RECORDS))
        self.delay = float(options.get("maxDelay", MAX_DELAY))
        self.counts: dict[str, list[int]] = {}    # rows by row group of files not yet read through
        self.waiting: float | None = None    # since when messages wait
        self.at: dict | None = None
        self.told = True                     # False: the kept position must be given again

    # ---- positions
    def _load(self, name: str) -> dict | None:
        fs, root = _files(self.state)
        if fs.get_file_info(f"{root}/{name}.json").type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(f"{root}/{name}.json") as f:
            return json.loads(f.read())

    def _save(self, name: str, position: dict) -> None:
        fs, root = _files(self.state)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}.draft") as f:
            f.write(json.dumps(position).encode())
        fs.move(f"{root}/{name}.draft", f"{root}/{name}.json")

    def initialOffset(self) -> dict:
        first = self._load("initial")
        if first is None:
            first = {t: list(self._end(t) if self.latest else START) for t in self.topics}
            self._save("initial", first)
        return first

    def latestOffset(self) -> dict:
        if self.at is None:
            kept = self._load("admitted")
            self.told, self.at = kept is None, kept or self.initialOffset()
        if not self.told:
            self.told = True
            return self.at
        there = {t: self._pending(t) for t in self.topics}
        total = sum(n for _, n in there.values())
        if not total:
            self.waiting = None
            return self.at
        now = time.monotonic()
        self.waiting = now if self.waiting is None else self.waiting
        if total < self.least and now - self.waiting < self.delay:
            return self.at
        share, left, new = {}, self.most, dict(self.at)
        for k, t in enumerate(sorted(self.topics, key=lambda t: there[t][1])):
            share[t] = min(there[t][1], left // (len(self.topics) - k))
            left -= share[t]
        for t, take in share.items():
            for delivery, name, start, rows in there[t][0]:
                if not take:
                    break
                n = min(take, rows - start)
                new[t], take = [delivery, name, start + n], take - n
        self._save("admitted", new)
        self.at, self.waiting, self.counts = new, None, {}
        return new

    # ---- files
    def _deliveries(self, topic: str, since: str) -> Iterator[tuple[str, str]]:
        """(delivery, file) of the complete deliveries from ``since`` on, in order."""
        fs, root = _files(self.path)
        folders = fs.get_file_info(pafs.FileSelector(f"{root}/{topic}", allow_not_found=True))
        for d in sorted(f.base_name for f in folders if f.type == pafs.FileType.Directory and f.base_name >= since):
            names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(f"{root}/{topic}/{d}")))
            if "_SUCCESS" in names:
                yield from ((d, n) for n in names if n.endswith(".parquet"))

    def _groups(self, topic: str, delivery: str, name: str) -> list[int]:
        key = f"{topic}/{delivery}/{name}"
        if key not in self.counts:
            fs, root = _files(self.path)
            footer = pq.read_metadata(f"{root}/{key}", filesystem=fs)
            self.counts[key] = [footer.row_group(g).num_rows for g in range(footer.num_row_groups)]
        return self.counts[key]

    def _rows(self, topic: str, delivery: str, name: str) -> int:
        return sum(self._groups(topic, delivery, name))

    def _pending(self, topic: str) -> tuple[list[tuple[str, str, int, int]], int]:
        """Files with unread rows as (delivery, file, rows read, rows) until ``maxRecords``
        are found, and how many were found (``maxRecords`` at most)."""
        at, out, n = tuple(self.at.get(topic, START)), [], 0
        for d, name in self._deliveries(topic, at[0]):
            if (d, name) < at[:2]:
                continue
            start, rows = at[2] if (d, name) == at[:2] else 0, self._rows(topic, d, name)
            if rows > start:
                out.append((d, name, start, rows))
                n += rows - start
            if n >= self.most:
                break
        return out, min(n, self.most)

    def _end(self, topic: str) -> tuple[str, str, int]:
        last = None
        for last in self._deliveries(topic, ""):
            pass
        return START if last is None else (*last, self._rows(topic, *last))

    # ---- batches
    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for t, (d1, n1, r1) in end.items():
            d0, n0, r0 = start.get(t, START)
            for d, name in self._deliveries(t, d0):
                if (d, name) < (d0, n0):
                    continue
                if (d, name) > (d1, n1):
                    break
                lo = r0 if (d, name) == (d0, n0) else 0
                groups = list(accumulate(self._groups(t, d, name)))
                hi = r1 if (d, name) == (d1, n1) else sum(groups[-1:])
                for cut in [*groups, hi]:    # a row group is no two tasks' work
                    if lo < hi and (cut >= hi or cut - lo >= PIECE):
                        out.append(Piece(t, d, f"{self.path}/{t}/{d}/{name}", lo, min(cut, hi)))
                        lo = min(cut, hi)
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        fs, path = _files(partition.path)
        schema = pa.schema([("topic", pa.string()), ("delivery", pa.string()), ("value", pa.string())])
        with fs.open_input_file(path) as f:
            file, first, groups = pq.ParquetFile(f), 0, []
            at = None                        # row with which the chosen groups begin
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if first < partition.end and first + n > partition.start:
                    groups, at = [*groups, g], first if at is None else at
                first += n
            for batch in file.iter_batches(8192, row_groups=groups, columns=["value"]):
                lo, hi = max(partition.start - at, 0), min(partition.end - at, batch.num_rows)
                at += batch.num_rows
                if hi > lo:
                    n = hi - lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(partition.topic), n), pa.repeat(pa.scalar(partition.delivery), n),
                         batch.column(0).slice(lo, n).cast(pa.string())], schema=schema)


class TopicSource(DataSource):
    """``spark.readStream.format("topics")`` with options ``path``, ``topics`` (names, comma
    separated), ``state`` and optionally ``startingOffsets`` (``latest``, or ``earliest``),
    ``minRecords``, ``maxDelay``, ``maxRecords``."""

    @classmethod
    def name(cls) -> str:
        return "topics"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options)


def topic_stream(spark: SparkSession, path: str, topics: Sequence[str], state: str, starting: str = "latest",
                 min_records: int = MIN_RECORDS, max_delay: float = MAX_DELAY, max_records: int = MAX_RECORDS) -> DataFrame:
    """(topic, delivery, value) of the messages of several topics as one stream."""
    spark.dataSource.register(TopicSource)
    return (spark.readStream.format("topics").option("path", path).option("topics", ",".join(topics))
            .option("state", state).option("startingOffsets", starting).option("minRecords", min_records)
            .option("maxDelay", max_delay).option("maxRecords", max_records).load())


def land(rows: DataFrame, path: str, topic: str, delivery: str) -> None:
    """Write ``rows`` (a string column ``value``) as a delivery of ``topic``."""
    (rows.select(F.col("value").cast("string").alias("value")).write.option("parquet.block.size", LANDED_GROUP)
     .parquet(f"{path}/{topic}/{delivery}"))
