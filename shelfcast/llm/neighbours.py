"""Embedding near-duplicates by neighbour descent (NN-descent).

Equal vectors are one node with the number of its rows, so copies never form pairs.
The nodes get a neighbour graph: lists of their nearest neighbours found so far, and,
apart from the lists, all threshold edges (cosine of ``threshold`` or more) found.

Start: a sort by the sign bits of random projections brings near vectors together.
Windows of ``LEAF`` consecutive nodes, half overlapping, are multiplied and give each
node its first list. Sorting by range splits any number of alike nodes over tasks.

Descent: every node brings its neighbours, forward and backward, together, and those
pairs of them of which one is new are compared (neighbours of neighbours). Lists keep
the ``width`` best. Entries at more than three times the threshold's angle are left
out: neighbours of neighbours of such entries are no nearer than strangers, so nodes
that have nothing near take no part. Rounds go on until less than one in a hundred
list entries changes.

Saturation: a list full of threshold edges may lack some, so it is enlarged without
limit: the node goes through ``CHOICES`` of its neighbours, those that come first in random
orders of the round, so that the nodes of a dense group choose the same few, and is
compared with their whole lists and with all who chose them. The groups are
cut into tiles of bounded size. Rounds go on until they find less than one in a
thousand edges more; every round doubles what a list reaches, so they are few.

Audit: about ``audit`` nodes, picked by a hash, are compared with all others (a bounded
number of queries against all rows, in blocks). While under ``recall`` of their edges
were found, more starting sorts are added, twice as many each time, and the descent
runs again.

Defined results: a vector that is null, empty, zero or holds a null or non-finite
component takes no part: no link, its own component. Vectors of unequal length are
compared as if padded with zeros. Every row counts as a vector of its own, also rows
that repeat a vec_id; a null vec_id names no component and is null beside others, and
a component of nothing else has a null id and is kept. An empty table gives an empty
result. Cosines are sums of products of unit vectors in double precision. Only the
named columns are read.
"""
from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import Stages
from .simhash import components

LEAF = 512        # nodes of a starting window
TILE = 2048       # nodes of a side of a tile
HUB = 256         # backward neighbours of a node that meet in one group
BITS = 48         # projections of a starting sort
SORTS = 6
CHOICES = 4       # neighbours through which a saturated list is enlarged in a round
EDGE = "a bigint, b bigint, sim double"


# vectors

def _packed(dtype: str):
    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        def one(v):
            if v is None or not len(v):
                return None
            x = np.array([np.nan if c is None else c for c in v], dtype) if v.dtype == object else np.asarray(v, dtype)
            if not np.isfinite(x).all() or not x.any():
                return None
            return np.trim_zeros(x + 0.0, "b").tobytes()  # + 0.0: no negative zeros
        return vectors.map(one)
    return pack


def unit(vectors, dtype: str) -> np.ndarray:
    """Packed vectors as rows of length one, padded with zeros."""
    parts = [np.frombuffer(v, dtype).astype(np.float64) for v in vectors]
    out = np.zeros((len(parts), max(map(len, parts), default=0)))
    for row, p in zip(out, parts):
        p = p / np.abs(p).max()  # no overflow or underflow of the squares
        row[:len(p)] = p / np.sqrt(p @ p)
    return out


def _product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    width = min(left.shape[1], right.shape[1])
    return left[:, :width] @ right[:, :width].T


def _frame(a, b, sim) -> pd.DataFrame:
    return pd.DataFrame({"a": np.asarray(a, np.int64), "b": np.asarray(b, np.int64), "sim": np.asarray(sim, np.float64)})


def _best(sims: np.ndarray, floor: float, width: int):
    """(row, column) of at most ``width`` best entries of each row of ``floor`` or more."""
    good = sims >= floor
    if sims.shape[1] > width:
        edge = np.partition(sims, sims.shape[1] - width, axis=1)[:, -width]
        good &= sims >= edge[:, None]
    return np.nonzero(good)


# start

def _codes(dtype: str, sorts: range):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict = {}
        for pdf in batches:
            if not len(pdf):
                continue
            x = unit(pdf["v"], dtype)
            for s in sorts:
                if (s, x.shape[1]) not in planes:
                    # plane i's component j is the same whatever the width of the batch
                    planes[s, x.shape[1]] = np.stack([np.random.default_rng([s, j]).standard_normal(BITS) for j in range(x.shape[1])])
                code = (x @ planes[s, x.shape[1]] > 0) @ (1 << np.arange(BITS, dtype=np.int64)[::-1])
                yield pd.DataFrame({"sort": np.full(len(pdf), s, np.int32), "code": code, "a": pdf["a"], "v": pdf["v"]})
    return run


def _windows(dtype: str, floor: float, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def compared(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, part in rows.groupby("sort"):
                x, ids = unit(part["v"], dtype), part["a"].to_numpy()
                sims = _product(x, x)
                np.fill_diagonal(sims, -2)
                i, j = _best(sims, floor, width)
                yield _frame(ids[i], ids[j], sims[i, j])
        rest, fresh = None, False
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            fresh = True
            while len(rest) >= LEAF:
                yield from compared(rest.iloc[:LEAF])
                rest = rest.iloc[LEAF // 2:].reset_index(drop=True)
                fresh = len(rest) > LEAF - LEAF // 2
        if rest is not None and fresh and len(rest):
            yield from compared(rest)
    return run


def _started(nodes: DataFrame, dtype: str, sorts: range, floor: float, width: int) -> DataFrame:
    coded = nodes.mapInPandas(_codes(dtype, sorts), "sort int, code bigint, a bigint, v binary")
    found = (coded.repartitionByRange("sort", "code", "a").sortWithinPartitions("sort", "code", "a")
             .mapInPandas(_windows(dtype, floor, width), EDGE))
    return found


# descent

def _lists(pairs: DataFrame, width: int) -> DataFrame:
    """(a, b, sim, new): the ``width`` best of each a; new if any of its rows is."""
    from pyspark.sql import Window
    one = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))  # known ones are not new again
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return one.withColumn("_r", rank).where(F.col("_r") <= width).drop("_r")


def _grouped(rows: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """``run`` over the rows of each group of ``keys`` (bounded groups), streamed by sort."""
    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if not len(pdf):
                continue
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            change = np.flatnonzero((rest[keys].to_numpy()[1:] != rest[keys].to_numpy()[:-1]).any(1)) + 1
            bounds = [0, *change.tolist()]
            for i, j in zip(bounds, bounds[1:]):
                yield from run(rest.iloc[i:j])
            rest = rest.iloc[bounds[-1]:].reset_index(drop=True)
        if rest is not None:
            yield from run(rest)
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(streamed, schema)


def _met(dtype: str, floor: float, width: int):
    def run(group: pd.DataFrame) -> Iterator[pd.DataFrame]:
        group = group.drop_duplicates("a")
        ids, new = group["a"].to_numpy(), group["new"].to_numpy(bool)
        if len(ids) < 2 or not new.any():
            return
        x = unit(group["v"], dtype)
        sims = np.where(new[:, None] | new[None, :], _product(x, x), -2)
        np.fill_diagonal(sims, -2)
        i, j = _best(sims, floor, width)
        yield _frame(ids[i], ids[j], sims[i, j])
    return run


def _descent_round(lists: DataFrame, nodes: DataFrame, dtype: str, floor: float, width: int) -> DataFrame:
    backward = F.pmod(F.xxhash64("a", "b"), F.greatest(F.ceil(F.col("n") / HUB), F.lit(1))).cast("int")
    counts = lists.groupBy("b").agg(F.count("*").alias("n"))
    # the forward list joins every block of the backward neighbours
    blocks = counts.select(F.col("b").alias("at"), F.ceil(F.col("n") / HUB).cast("int").alias("blocks"))
    forward = (lists.select(F.col("a").alias("at"), F.col("b").alias("a"), "new").join(blocks, "at", "left")
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).select("at", "block", "a", "new"))
    back = lists.join(counts, "b").select(F.col("b").alias("at"), backward.alias("block"), "a", "new")
    meeting = forward.unionByName(back).join(nodes, "a")
    return _grouped(meeting, ["at", "block"], _met(dtype, floor, width), EDGE)


# saturated lists

def _crossed(dtype: str, threshold: float):
    def run(group: pd.DataFrame) -> Iterator[pd.DataFrame]:
        group = group.drop_duplicates(["a", "asks"])
        left, right = group[group["asks"]], group[~group["asks"]]
        if not len(left) or not len(right):
            return
        ids, others = left["a"].to_numpy(), right["a"].to_numpy()
        y = unit(right["v"], dtype)
        x = unit(left["v"], dtype)
        for s in range(0, len(ids), 256):
            sims = _product(x[s:s + 256], y)
            sims[ids[s:s + 256][:, None] == others[None, :]] = -2
            i, j = np.nonzero(sims >= threshold)
            a, b = ids[s + i], others[j]
            yield _frame(np.minimum(a, b), np.maximum(a, b), sims[i, j]).drop_duplicates(["a", "b"])
    return run


def _enlarged(edges: DataFrame, full: DataFrame, nodes: DataFrame, dtype: str, threshold: float, seed: int,
              stages: Stages) -> DataFrame:
    """Edges between each node of ``full`` and what its chosen neighbours link to."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    itself = full.select("a", F.col("a").alias("b"))
    first = [F.min_by("b", F.xxhash64(F.lit(CHOICES * seed + i), "b")).alias(f"c{i}") for i in range(CHOICES)]
    chosen = stages.written(both.join(full, "a", "left_semi").union(itself).groupBy("a").agg(*first)
                            .select("a", F.explode(F.array_distinct(F.array(*[f"c{i}" for i in range(CHOICES)]))).alias("at")),
                            "neighbours-chosen")
    middle = chosen.groupBy("at").agg(F.count("*").alias("asking"))
    listed = both.select(F.col("a").alias("at"), F.col("b").alias("a")).join(middle.select("at"), "at", "left_semi")
    listed = stages.written(listed.union(chosen.select("at", "a")).union(middle.select("at", F.col("at").alias("a"))).distinct(),
                            "neighbours-listed")
    sizes = stages.written(
        listed.groupBy("at").agg(F.count("*").alias("m")).join(middle, "at").select(
            "at", F.ceil(F.col("asking") / TILE).cast("int").alias("rows"), F.ceil(F.col("m") / TILE).cast("int").alias("columns")),
        "neighbours-tiles")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one(n):
        return F.pmod(F.xxhash64("a"), F.col(n)).cast("int")
    asking = (chosen.join(sizes, "at").withColumn("i", one("rows")).withColumn("j", every("columns"))
              .select("at", "i", "j", "a", F.lit(True).alias("asks")))
    asked = (listed.join(sizes, "at").withColumn("j", one("columns")).withColumn("i", every("rows"))
             .select("at", "i", "j", "a", F.lit(False).alias("asks")))
    met = asking.unionByName(asked).join(nodes, "a")
    return _grouped(met, ["at", "i", "j"], _crossed(dtype, threshold), EDGE)


# audit

def _audited(nodes: DataFrame, edges: DataFrame, dtype: str, threshold: float, audit: int) -> tuple[int, int]:
    """(found, all) edges of about ``audit`` nodes, compared with every node."""
    n = nodes.count()
    step = max(1, n // audit)
    sample = nodes.where(F.pmod(F.xxhash64(F.lit("audit"), "a"), F.lit(step)) == 0).limit(4 * audit)
    asked = sample.collect()  # bounded by the parameter
    shared = nodes.sparkSession.sparkContext.broadcast([(r["a"], bytes(r["v"])) for r in asked])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = np.array([a for a, _ in shared.value], np.int64)
        x = unit([v for _, v in shared.value], dtype)
        for pdf in batches:
            if len(pdf) and len(ids):
                others = pdf["a"].to_numpy()
                sims = _product(x, unit(pdf["v"], dtype))
                sims[ids[:, None] == others[None, :]] = -2
                i, j = np.nonzero(sims >= threshold)
                a, b = ids[i], others[j]
                yield _frame(np.minimum(a, b), np.maximum(a, b), sims[i, j])
    true = nodes.mapInPandas(compare, EDGE).dropDuplicates(["a", "b"])
    found = true.join(edges.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").agg(
        F.count("hit").alias("f"), F.count("*").alias("n")).first()
    shared.unpersist()
    return found["f"], found["n"]


def _edges_of(lists: DataFrame, threshold: float) -> DataFrame:
    return (lists.where(F.col("sim") >= threshold)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim"))


def _merged(*edges: DataFrame) -> DataFrame:
    out = edges[0].select("a", "b", "sim")
    for e in edges[1:]:
        out = out.union(e.select("a", "b", "sim"))
    return out.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def threshold_graph(nodes: DataFrame, dtype: str, stages: Stages, threshold: float = 0.95, width: int = 10,
                    recall: float = 0.98, audit: int = 256, sorts: int = SORTS, audits: int = 5) -> DataFrame:
    """(a, b, sim), a < b: pairs of ``nodes`` (a, v) of cosine ``threshold`` or more."""
    floor = math.cos(min(3 * math.acos(threshold), math.pi / 2))
    lists = edges = None
    used = 0
    for attempt in range(audits):
        more = range(used, used + sorts * 2**max(0, attempt - 1))
        used = more.stop
        started = _started(nodes, dtype, more, floor, width).withColumn("new", F.lit(True))
        if lists is not None:
            started = started.unionByName(lists.withColumn("new", F.lit(False)))
        old, lists = lists, stages.written(_lists(started, width), "neighbours-lists")
        if old is not None:
            stages.remove(old)
        while True:
            met = _descent_round(lists, nodes, dtype, floor, width).withColumn("new", F.lit(True))
            old, lists = lists, stages.written(
                _lists(met.unionByName(lists.withColumn("new", F.lit(False))), width), "neighbours-lists")
            stages.remove(old)
            total, new = lists.agg(F.count("*"), F.count(F.when(F.col("new"), 1))).first()
            if new * 100 < total or not total:
                break
        parts = [_edges_of(lists, threshold)] + ([edges] if edges is not None else [])
        old, edges = edges, stages.written(_merged(*parts), "neighbours-edges")
        if old is not None:
            stages.remove(old)
        full = stages.written(lists.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("least"))
                              .where((F.col("n") >= width) & (F.col("least") >= threshold)).select("a"), "neighbours-full")
        count, seed = edges.count(), 0
        while not full.isEmpty():
            kept = Stages(stages.spark)
            found = _enlarged(edges, full, nodes, dtype, threshold, seed, kept)
            old, edges = edges, stages.written(_merged(edges, found), "neighbours-edges")
            stages.remove(old)
            kept.remove_all_but()
            before, count, seed = count, edges.count(), seed + 1
            if (count - before) * 1000 < count:
                break
        stages.remove(full)
        hit, true = _audited(nodes, edges, dtype, threshold, audit)
        logging.getLogger(__name__).info("audit: %d of %d edges found with %d sorts", hit, true, used)
        if hit >= recall * true:
            break
    stages.remove(lists)
    return edges


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95,
                    width: int = 10, recall: float = 0.98, audit: int = 256) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    stages = Stages(spark)
    single = isinstance(getattr(vectors.schema[embedding].dataType, "elementType", None), FloatType)
    dtype, kind = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = stages.written(vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                                         _packed(dtype)(F.col(embedding).cast(kind)).alias("v")), "neighbours-rows")
    # numbers are given once and written: what is computed again meets the same ones
    nodes = stages.written(rows.where(F.col("v").isNotNull()).groupBy("v")
                           .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                           .withColumn("a", F.monotonically_increasing_id()), "neighbours-nodes")
    edges = threshold_graph(nodes.select("a", "v"), dtype, stages, threshold, width, recall, audit)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(nodes.select(F.col("a").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    label = components(edges.select("a", "b"))
    node = stages.written(
        nodes.join(linked, "a", "left").join(label.withColumnRenamed("node", "a"), "a", "left").select(
            "a", "v", "least", F.coalesce("label", "a").alias("label"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "neighbours-labelled")
    named = node.groupBy("label").agg(F.min("least").alias("component_id"))
    known = node.join(named, "label").select("v", "n_links", "component_id")
    out = stages.written(rows.join(known, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "neighbours-result")
    stages.remove_all_but(out)
    return out
