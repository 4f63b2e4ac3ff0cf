"""Order-dependent folds.

guarded_fold (A18): stock per key where a change is applied only if the stock
stays >= 0. Rows are range-partitioned by (key, order), so a key of any size is
spread over as many tasks as its rows fill, and sorted inside each partition. A key
that begins in a partition is folded there in order, one Arrow batch at a time. The
rows with which a partition begins may continue a key, whose stock the task can't
know: they are summarised in blocks of bounded size by the stock that they leave as a
function of the stock that they find (``stock_function``). Composing those functions
along a key is one step a block; it gives every block the stock that it starts from,
and the blocks are then folded side by side.

ewm_last (A17): exponentially weighted mean (``adjust=False``) of a short,
already aggregated series per key (hours x category), with a constant-size
accumulator in the ``aggregate`` higher-order function.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .stats import _join_groups


def fold_run(x: np.ndarray, state: int) -> tuple[int, np.ndarray]:
    """Apply deltas ``x`` in order from ``state``; return (final, applied mask)."""
    n = len(x)
    applied = np.ones(n, dtype=bool)
    i, block = 0, 64
    while i < n:
        seg = x[i:i + block]
        tentative = state + np.cumsum(seg)
        neg = np.flatnonzero(tentative < 0)
        if neg.size == 0:
            state = int(tentative[-1])
            i += len(seg)
            block = min(block * 2, 1 << 16)
            continue
        j = int(neg[0])
        if j > 0:
            state = int(tentative[j - 1])
        applied[i + j] = False
        i += j + 1
        block = 64
    return state, applied


# A block of rows whose first stock isn't known yet: rows, and the entering stocks for
# which the stock function is written down.
BLOCK_ROWS = 65_536
BLOCK_STOCKS = 1 << 20


class stock_function:
    """The guarded fold over a run of changes as a function of the entering stock.

    A stock of ``drawdown`` (how far the running sum dips) or more takes every change
    and leaves as itself plus ``total``. Smaller ones meet a change that they can't take:
    at that moment they become a trajectory of their own, and trajectories that come to
    the same stock are one from then on, so only a few are alive at a time. ``add``
    takes the next change, ``table`` gives the stocks left by 0 to drawdown - 1."""

    def __init__(self):
        self.total = self.drawdown = 0
        self.shift = 0                             # added to all live stocks
        self.live = np.zeros(0, np.int64)          # distinct, ascending
        self.names = np.zeros(0, np.int64)         # a trajectory's number, by live stock
        self.same: list[tuple[np.ndarray, np.ndarray]] = []  # trajectories that became others
        self.born = 0                              # trajectory i is that of entering stock i

    def add(self, x: int) -> None:
        entering = self.total                      # of stock 0, had it taken every change
        self.total += x
        if x >= 0:
            self.shift += x
            return
        held = int(np.searchsorted(self.live, -x - self.shift))  # those that can't take it
        self.shift += x
        stocks, names = self.live.copy(), self.names
        stocks[:held] -= x
        if -self.total > self.drawdown:
            new = np.arange(self.drawdown, -self.total)
            stocks = np.concatenate([stocks, new + entering - self.shift])
            names = np.concatenate([names, new])
            self.drawdown = self.born = -self.total
        if held or len(stocks) > len(self.live):
            order = np.argsort(stocks, kind="stable")
            stocks, names = stocks[order], names[order]
            first = np.concatenate([[True], stocks[1:] != stocks[:-1]])
            if not first.all():
                kept = names[first][np.cumsum(first) - 1]
                self.same.append((names[~first], kept[~first]))
                stocks, names = stocks[first], names[first]
            self.live, self.names = stocks, names

    def table(self) -> np.ndarray:
        out = np.zeros(self.born, np.int64)
        out[self.names] = self.live + self.shift
        for gone, kept in reversed(self.same):
            out[gone] = out[kept]
        return out


def blocks_of(x: np.ndarray, most_stocks: int = BLOCK_STOCKS) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(rows, total, drawdown, table) of consecutive blocks of ``x``. A block ends before
    its drawdown would pass ``most_stocks``; a single change beyond that has no table, as
    a stock that can't take it stays what it is."""
    f, rows = stock_function(), 0
    for c in x.tolist():
        if -(f.total + c) > most_stocks:
            if rows:
                yield rows, f.total, f.drawdown, f.table()
            f, rows = stock_function(), 0
            if -c > most_stocks:
                yield 1, c, -c, np.zeros(0, np.int64)
                continue
        f.add(c)
        rows += 1
    if rows:
        yield rows, f.total, f.drawdown, f.table()


STATE = "_stock bigint, _events bigint, _skipped bigint, _last {ts}"
BLOCK = "_part int, _seq int, _total bigint, _drawdown bigint, _table binary, _rows binary, _open boolean"


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _parts(schema: pa.Schema, delta: str, ts: str, emit: str):
    """Sorted partition -> rows of finished keys, the state of the last key, and blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        key = state = None           # the key being folded and its running state
        first = part > 0             # still in the rows that may continue a key
        held: list[pa.RecordBatch] = []
        seq = 0
        own = set(schema.names)

        def out(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        def blocks() -> Iterator[pa.RecordBatch]:
            nonlocal held, seq
            rows = pa.Table.from_batches(held).combine_chunks()
            held, at = [], 0
            for n, total, drawdown, table in blocks_of(rows[delta].to_numpy()):
                piece = rows.slice(at, n)
                yield out({"_key": piece["_key"].slice(0, 1).combine_chunks(), "_k": piece["_k"].slice(0, 1).combine_chunks(),
                           "_s0": piece["_s0"].slice(0, 1).combine_chunks(), "_part": pa.array([part]), "_seq": pa.array([seq]),
                           "_total": pa.array([total]), "_drawdown": pa.array([drawdown]), "_open": pa.array([True]),
                           "_table": pa.array([zlib.compress(table.tobytes(), 1)], pa.binary()),
                           "_rows": pa.array([_packed(piece)], pa.binary())}, 1)
                at, seq = at + n, seq + 1

        def finished(open_: bool) -> pa.RecordBatch:
            k, stock, events, skipped, last = state
            return out({"_key": pa.array([key]), "_k": k, "_stock": pa.array([stock]), "_events": pa.array([events]),
                        "_skipped": pa.array([skipped]), "_last": last, "_part": pa.array([part]), "_seq": pa.array([seq]),
                        "_open": pa.array([open_])}, 1)
        def folded(batch: pa.RecordBatch, a: int, b: int) -> list[pa.RecordBatch]:
            """Fold rows a to b of the running key; returns the skipped ones if asked for."""
            nonlocal state
            k, stock, events, skipped, last = state
            stock, applied = fold_run(batch[delta].slice(a, b - a).to_numpy(), stock)
            hit = np.flatnonzero(applied)
            if len(hit):
                last = batch[ts].slice(a + int(hit[-1]), 1)
            state = (k, stock, events + b - a, skipped + int((~applied).sum()), last)
            return rows_of(batch, np.flatnonzero(~applied) + a)

        def rows_of(batch: pa.RecordBatch, at: np.ndarray) -> list[pa.RecordBatch]:
            if emit != "skipped" or not len(at):
                return []
            rows = batch.take(pa.array(at))
            return [out({f.name: rows[f.name] for f in rows.schema if f.name in own}, len(rows))]

        def whole_keys(batch: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray) -> list[pa.RecordBatch]:
            """Keys that lie in the batch whole, together: only those that skip are folded one by one."""
            a = int(starts[0])
            x, stock = batch[delta].to_numpy(), batch["_s0"].to_numpy()[starts]
            sums = np.cumsum(x[a:ends[-1]])
            before = np.concatenate([[0], sums[ends[:-1] - 1 - a]])
            low = np.minimum.reduceat(sums, starts - a) - before + stock
            final = stock + sums[ends - 1 - a] - before
            skipped, last, gone = np.zeros(len(starts), np.int64), ends - 1, [np.zeros(0, np.int64)]
            for i in np.flatnonzero(low < 0):
                final[i], applied = fold_run(x[starts[i]:ends[i]], int(stock[i]))
                hit = np.flatnonzero(applied)
                skipped[i], last[i] = len(applied) - len(hit), starts[i] + hit[-1] if len(hit) else -1
                gone.append(np.flatnonzero(~applied) + starts[i])
            at, n = pa.array(starts), len(starts)
            return [out({"_key": batch["_key"].take(at), "_k": batch["_k"].take(at), "_stock": pa.array(final),
                         "_events": pa.array(ends - starts), "_skipped": pa.array(skipped),
                         "_last": batch[ts].take(pa.array(last, mask=last < 0)), "_part": pa.array(np.full(n, part)),
                         "_seq": pa.array(np.full(n, seq)), "_open": pa.array(np.zeros(n, bool))}, n),
                    *rows_of(batch, np.concatenate(gone))]
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            keys = batch["_key"]
            change = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [n]])
            done: list[pa.RecordBatch] = []
            new = 0                  # the first of the batch's keys that begins in it
            if first and key is None:
                key = keys[0].as_py()
            if keys[0].as_py() == key:
                new = 1
                if first:
                    held.append(batch.slice(0, int(ends[0])))
                else:
                    done += folded(batch, 0, int(ends[0]))
            if held and (new < len(starts) or sum(map(len, held)) >= BLOCK_ROWS):
                yield from blocks()
            if new < len(starts):
                first = False
                if state is not None:
                    done.append(finished(False))
                if new < len(starts) - 1:
                    done += whole_keys(batch, starts[new:-1], ends[new:-1])
                a = int(starts[-1])
                key = keys[a].as_py()
                state = (batch["_k"].slice(a, 1), batch["_s0"][a].as_py(), 0, 0, pa.nulls(1, schema.field("_last").type))
                done += folded(batch, a, n)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if first and held:
            yield from blocks()
        elif state is not None:
            yield finished(True)
    return run


def _composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks and states by (key, part, seq) -> the stock from which every block starts."""
    key = stock = None
    for pdf in batches:
        found = []
        for k, part, seq, own, s0, total, drawdown, table in zip(*(pdf[c] for c in (
                "_key", "_part", "_seq", "_stock", "_s0", "_total", "_drawdown", "_table"))):
            if k != key:
                key, stock = k, None
            if table is None:        # the key began in this part and was folded there
                stock = int(own)
                continue
            stock = int(s0) if stock is None else stock
            found.append((part, seq, stock))
            if stock >= drawdown:
                stock += int(total)
            elif len(left := np.frombuffer(zlib.decompress(table), np.int64)):
                stock = int(left[stock])
        yield pd.DataFrame(found, columns=["_part", "_seq", "_entering"])


def _refolded(schema: pa.Schema, delta: str, ts: str, emit: str):
    """Blocks with the stock from which they start -> their states or skipped rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                with pa.ipc.open_stream(batch["_rows"][i].as_py()) as r:
                    rows = r.read_all().combine_chunks()
                stock, applied = fold_run(rows[delta].to_numpy(), batch["_entering"][i].as_py())
                if emit == "skipped":
                    found = rows.take(pa.array(np.flatnonzero(~applied)))
                    if len(found):
                        yield found.select(schema.names).cast(schema).combine_chunks().to_batches()[0]
                    continue
                hit = np.flatnonzero(applied)
                last = rows[ts].slice(int(hit[-1]), 1).combine_chunks() if len(hit) else pa.nulls(1, schema.field("_last").type)
                columns = {"_key": batch["_key"].slice(i, 1), "_k": batch["_k"].slice(i, 1), "_part": batch["_part"].slice(i, 1),
                           "_seq": batch["_seq"].slice(i, 1), "_stock": pa.array([stock]), "_events": pa.array([len(rows)]),
                           "_skipped": pa.array([int((~applied).sum())]), "_last": last}
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
    return run


def _folded(df: DataFrame, keys: list[str], order: Sequence[str], delta: str, ts: str, n: int,
            init: DataFrame | None, emit: str) -> tuple[DataFrame, DataFrame, str]:
    """(written rows of the first pass, blocks' rows of the second, schema of a state)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    columns = df.columns if emit == "skipped" else [*dict.fromkeys([*order, delta, ts])]
    rows = df
    if init is not None:
        rows = _join_groups(rows, init.select(*keys, F.greatest(F.col("stock").cast("long"), F.lit(0)).alias("_s0")), keys, "left")
    # only the columns themselves are shuffled
    needed = [*dict.fromkeys([*keys, *columns]), *(["_s0"] if init is not None else [])]
    rows = rows.select(*[(F.coalesce(F.col(c).cast("long"), F.lit(0)) if c == delta else F.col(c)).alias(c) for c in needed])
    rows = rows.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    # one string a key, NULLs included, to tell keys apart in the workers
    rows = rows.select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("_key"), F.struct(*keys).alias("_k"),
                       (F.lit(0).cast("long") if init is None else F.coalesce("_s0", F.lit(0))).alias("_s0"), *columns)
    own = [f for f in rows.schema.fields if f.name in columns] if emit == "skipped" else []
    state = STATE.format(ts=rows.schema[ts].dataType.simpleString())
    ident = f"_key string, _k {rows.schema['_k'].dataType.simpleString()}, _s0 bigint"
    schema = ", ".join([ident, state, BLOCK, *[f"`{f.name}` {f.dataType.simpleString()}" for f in own]])
    spark = df.sparkSession

    def arrow(ddl: str) -> pa.Schema:
        return to_arrow_schema(spark.createDataFrame([], ddl).schema)
    first = materialize(rows.mapInArrow(_parts(arrow(schema), delta, ts, emit), schema), "fold-parts")
    # blocks and the states that may lead up to them: at most two keys a partition
    chain = first.where("_open").select("_key", "_part", "_seq", "_stock", "_s0", "_total", "_drawdown", "_table")
    entering = (chain.repartition("_key").sortWithinPartitions("_key", "_part", "_seq")
                .mapInPandas(_composed, "_part int, _seq int, _entering bigint"))
    blocks = first.where(F.col("_rows").isNotNull()).select("_key", "_k", "_part", "_seq", "_rows").join(entering, ["_part", "_seq"])
    out = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own) if emit == "skipped" else
           ident.replace(", _s0 bigint", "") + ", _part int, _seq int, " + state)
    return first, blocks.mapInArrow(_refolded(arrow(out), delta, ts, emit), out), out


def guarded_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], delta: str, ts: str = "timestamp",
                 num_partitions: int | None = None, init: DataFrame | None = None) -> DataFrame:
    """Per key: final state of the non-negative guarded fold over ``delta``.

    Output: keys, current_stock (long), events, skipped, last_event_at (time of
    the last applied change). ``order`` must make the order within a key total. A NULL
    change is a change of 0, a NULL in a key is a value like any other. ``init`` (keys,
    ``stock``) gives the stock before the first row; 0 where absent or negative.
    """
    keys = list(keys)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, blocks, _ = _folded(df, keys, order, delta, ts, n, init, "state")
    state = ["_key", "_k", "_part", "_seq", "_stock", "_events", "_skipped", "_last"]
    whole = first.where(~F.col("_open")).select("_k", "_stock", "_events", "_skipped", "_last")
    spread = (first.where(F.col("_open") & F.col("_rows").isNull()).select(*state).unionByName(blocks.select(*state))
              .groupBy("_key").agg(
                  F.first("_k").alias("_k"), F.max_by("_stock", F.struct("_part", "_seq")).alias("_stock"),
                  F.sum("_events").alias("_events"), F.sum("_skipped").alias("_skipped"),
                  F.max_by("_last", F.when(F.col("_last").isNotNull(), F.struct("_part", "_seq"))).alias("_last")).drop("_key"))
    return whole.unionByName(spread).select(
        "_k.*", F.col("_stock").alias("current_stock"), F.col("_events").alias("events"),
        F.col("_skipped").alias("skipped"), F.col("_last").alias("last_event_at"))


def skipped_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], delta: str, ts: str = "timestamp",
                    num_partitions: int | None = None, init: DataFrame | None = None) -> DataFrame:
    """The input rows whose change was not applied (would have made stock < 0)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, blocks, _ = _folded(df, list(keys), order, delta, ts, n, init, "skipped")
    skipped = first.where(F.col("_open").isNull()).select(*df.columns).unionByName(blocks)
    return skipped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema])


def ewm_state(series: Column, alpha: float, history: int = 4) -> Column:
    """Fold a time-ordered array<double> into struct(n, y, p1..p<history>).

    y is the EWM (adjust=False) after the last element; p_k the EWM k steps
    earlier (NULL when the series is shorter).
    """
    a = float(alpha)
    init = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("y"),
                    *[F.lit(None).cast("double").alias(f"p{k}") for k in range(1, history + 1)])

    def step(acc, x):
        y_new = F.when(acc["n"] == 0, x).otherwise(F.lit(1 - a) * acc["y"] + F.lit(a) * x)
        shifted = [acc["y"].alias("p1")] + [acc[f"p{k - 1}"].alias(f"p{k}") for k in range(2, history + 1)]
        return F.struct((acc["n"] + 1).alias("n"), y_new.alias("y"), *shifted)

    return F.aggregate(series, init, step)
