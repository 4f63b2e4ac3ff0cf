"""Exact global ranks without a single-partition window.

``Window.orderBy(x)`` with no partitioning moves every row into one task. Here
the rows are range-partitioned on the (total) order, sorted inside each
partition and numbered locally; the numbered rows are written once to the
shared checkpoint folder (so the numbering is computed once and survives lost
executors), and a tiny per-partition count table (one row per partition, a
proven broadcast bound) turns local numbers into global ranks. The ordering
key must be unique (add a tie-break column).
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import materialize


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "rank",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order`` (ascending).

    Runs one range shuffle and one write (eagerly) to the shared checkpoint
    folder; the returned frame reads those files.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = _partitions(df, num_partitions)
    part = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), 33)))
    part = materialize(part, "ranked")
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_cnt")).alias("_offset"))
    return (part.join(F.broadcast(offsets), "_pid")
                .withColumn(rank_col, F.col("_offset") + F.col("_local") + F.lit(1))
                .drop("_pid", "_local", "_offset"))


def _narrowed(df: DataFrame, wanted: Sequence[tuple[str, Column, int, Sequence[int]]]) -> list[list[tuple]]:
    """For each (column, rows, how many they are, ranks) and each rank r a triple (low, high,
    below): the r-th smallest value of the column in those rows (which hold no NULL) lies
    within low..high, and ``below`` of them are smaller than low.

    One pass takes approximate percentiles on either side of each rank, one counts the rows
    that they leave out; a rank that they miss, or a column that is no
    number, keeps the whole range (None, None, 0)."""
    out = [[(None, None, 0)] * len(ranks) for _, _, _, ranks in wanted]
    todo = [i for i, (c, _, _, ranks) in enumerate(wanted) if ranks and isinstance(df.schema[c].dataType, NumericType)]
    if not todo:
        return out
    found = df.agg(*[F.percentile_approx(F.when(wanted[i][1], F.col(wanted[i][0])), F.array(*[
        F.lit(min(1.0, max(0.0, r / max(1, wanted[i][2]) + side * SLACK / ACCURACY)))
        for r in wanted[i][3] for side in (-1, 1)]), ACCURACY).alias(f"p{i}") for i in todo]).first()
    todo = [i for i in todo if found[f"p{i}"] is not None]
    ends = {(i, k): (found[f"p{i}"][2 * k], found[f"p{i}"][2 * k + 1]) for i in todo for k in range(len(wanted[i][3]))}
    counted = []
    for (i, k), (low, high) in ends.items():
        c, kind = F.col(wanted[i][0]), df.schema[wanted[i][0]].dataType
        counted += [F.count_if(wanted[i][1] & (c < F.lit(low).cast(kind))).alias(f"b{i}_{k}"),
                    F.count_if(wanted[i][1] & (c <= F.lit(high).cast(kind))).alias(f"u{i}_{k}")]
    counts = df.agg(F.lit(0).alias("_"), *counted).first()
    for (i, k), (low, high) in ends.items():
        if counts[f"b{i}_{k}"] < wanted[i][3][k] <= counts[f"u{i}_{k}"]:
            out[i][k] = (low, high, counts[f"b{i}_{k}"])
    return out


# Percentiles may be wrong by a share of 1 / ACCURACY of the rows on either side.
ACCURACY, SLACK = 10_000, 2


def rows_at(df: DataFrame, values: Sequence[str], tie: str,
            ranks: Sequence[int] | Callable[[int], Sequence[int]]) -> dict[str, list]:
    """For each column of ``values`` the rows (value, tie) that stand at ``ranks`` (1-based,
    or a function of the number of rows) in the order by (value, tie), NULLs first: selection in place of a sort of all rows.

    The values around a rank are narrowed by percentiles; where one value fills the range,
    so are its ties, if they are numbers. Every pass is an aggregate to one row.
    Only the rows left in between, about ``2 * SLACK / ACCURACY`` of all a rank, are
    ranked. Whatever the percentiles say, counts decide, so the result is exact; a range
    that can't be narrowed is ranked as it is, over many tasks."""
    found = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(v).isNull()).alias(f"n{k}") for k, v in enumerate(values)]).first()
    total, nulls = found["n"], {v: found[f"n{k}"] for k, v in enumerate(values)}
    ranks = ranks(total) if callable(ranks) else ranks
    cuts = [(v, r) for v in values for r in ranks]
    if not cuts:
        return {v: [] for v in values}
    real = {v: [r - nulls[v] for r in ranks if r > nulls[v]] for v in values}
    met = dict(zip(values, map(iter, _narrowed(df, [(v, F.col(v).isNotNull(), total - nulls[v], real[v]) for v in values]))))

    def within(rows: Column, c: str, low, high) -> Column:
        kind = df.schema[c].dataType
        return rows & F.col(c).between(F.lit(low).cast(kind), F.lit(high).cast(kind))

    inside, place = [], []                     # of each cut: the rows left, and which of them it is
    single = []                                # cuts whose rows left have one value
    for i, (v, r) in enumerate(cuts):
        if r <= nulls[v]:
            rows, low, high, below = F.col(v).isNull(), 0, 0, 0
        else:
            low, high, below = next(met[v])
            rows = F.col(v).isNotNull()
            rows, below = rows if low is None else within(rows, v, low, high), below + nulls[v]
        inside.append(rows)
        place.append(r - below)
        if low is not None and low == high:
            single.append(i)
    if single:
        spare = df.agg(*[c for i in single for c in (F.count_if(inside[i] & F.col(tie).isNull()).alias(f"n{i}"),
                                                     F.count_if(inside[i] & F.col(tie).isNotNull()).alias(f"m{i}"))]).first()
        single = [i for i in single if place[i] > spare[f"n{i}"]]
        wanted = [(tie, inside[i] & F.col(tie).isNotNull(), spare[f"m{i}"], [place[i] - spare[f"n{i}"]]) for i in single]
        for i, [(low, high, below)] in zip(single, _narrowed(df, wanted)):
            if low is not None:
                inside[i], place[i] = within(inside[i], tie, low, high), place[i] - spare[f"n{i}"] - below
    # one ranking of the rows left: by cut, then by the column that the cut is about
    entries = [F.when(rows, F.struct(F.lit(i).alias("_cut"), *[
        (F.col(v) if v == cuts[i][0] else F.lit(None).cast(df.schema[v].dataType)).alias(f"_v{k}")
        for k, v in enumerate(values)], F.col(tie).alias("_tie"))) for i, rows in enumerate(inside)]
    left = df.select(F.explode(F.array_compact(F.array(*entries))).alias("_e")).select("_e.*")
    ranked = with_global_rank(left, ["_cut", *[f"_v{k}" for k in range(len(values))], "_tie"], "_r")
    first = {r["_cut"]: r["_r"] for r in ranked.groupBy("_cut").agg(F.min("_r").alias("_r")).collect()}   # a row a cut
    at = {first[i] + place[i] - 1: i for i in range(len(cuts))}
    out = {at[r["_r"]]: r for r in ranked.where(F.col("_r").isin(list(at))).collect()}   # a row a cut
    return {v: [(out[i][f"_v{k}"], out[i]["_tie"]) for i, (w, _) in enumerate(cuts) if w == v] for k, v in enumerate(values)}


def quantile_scores(df: DataFrame, tie: str, scores: dict[str, tuple[str, bool]], n_bins: int = 5) -> DataFrame:
    """``pd.qcut(series.rank(method='first'), q=n, labels=1..n)`` exactly, for several columns:
    ``scores`` maps a new column to (value, whether labels descend).

    With N rows and n = min(n_bins, N) bins, rank r (1-based, ties broken by
    ``tie``) falls in bin max(1, ceil((r-1)*n/(N-1))); N = 1 gives bin 1. Descending
    labels map bin k to n+1-k. The last rows of the first n-1 bins are selected, and every
    row of ``df`` gets its bin by comparison with them, so ``df`` is neither sorted,
    shuffled nor written. It is read several times: give a written table.
    """
    n = 1

    def last(total: int) -> list[int]:
        nonlocal n
        n = max(1, min(n_bins, total))
        return [j * (total - 1) // n + 1 for j in range(1, n)]
    cuts = rows_at(df, list(dict.fromkeys(v for v, _ in scores.values())), tie, last)
    for out_col, (value, descending) in scores.items():
        k = F.lit(1)
        for cut in cuts[value]:
            ends = [F.lit(x).cast(df.schema[c].dataType).alias(c) for c, x in zip((value, tie), cut)]
            k = k + (F.struct(value, tie) > F.struct(*ends)).cast("int")
        df = df.withColumn(out_col, ((F.lit(n + 1) - k) if descending else k).cast("int"))
    return df


def quantile_bins(df: DataFrame, value: str, tie: str, out_col: str, n_bins: int = 5,
                  descending_labels: bool = False) -> DataFrame:
    """``quantile_scores`` of one column."""
    return quantile_scores(df, tie, {out_col: (value, descending_labels)}, n_bins)
