"""Exact top-k search by tiled matrix products.

Vectors are quantised to integers by column expressions. Candidates are dealt
into shards of about ``SHARD`` rows by a hash of id and vector, queries into
blocks of about ``BLOCK``; every (block, shard) tile is one cogroup whose scores
are matrix products over slices of the tile, of which a partial selection keeps
k per query. The lists are then merged up a tree of fan-in ``FAN`` by grouping on
(query, node): no list of all partial results meets in one task.

The candidates are copied once per query block and the queries once per shard:
the smallest exchange that lets every tile be a task of bounded memory.

Defined results: rows whose id or vector is null, or whose vector holds a null or
a component that isn't finite, take no part; every finite vector does, however large
its components. Rows that repeat an id and vector count once; rows of one id with
other vectors are other candidates, none of them is a candidate of a query of that
id, and a query of such an id takes its smallest vector. Vectors of unequal length
are compared as if padded with zeros. Scores are exact, and rank exactly beyond the
range of a long too, also across tiles; there they come back as the nearest long. No
query or no candidate: no rows.
"""
from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SHARD, BLOCK, FAN = 8192, 4096, 16
SLICE = 256  # queries of a tile that are multiplied at once
LIMIT = 2**63 - 1


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): the distinct rows that take part."""
    x = F.col(embedding).cast("array<double>")
    whole = F.col(vec_id).isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.coalesce(whole, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda v: v + F.lit(0.0)).alias("v"))  # no -0.0
            .dropDuplicates(["vec_id", "v"]))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id",
          embedding: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each
    query, ties to the smaller id. ``is_query`` is a condition on ``vec_id``."""
    rows = written(usable(vectors, vec_id, embedding), "topk-vectors")
    queries = written(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
                      .withColumnRenamed("vec_id", "query_id"), "topk-queries")
    shards = max(1, math.ceil(rows.count() / SHARD))
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    dealt = (rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    tiles = (asked.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard"))
             .applyInPandas(_tile(k, scale), "query_id long, node int, vec_id long, score long, beyond binary"))
    best = tiles.groupBy("query_id", "node").agg(_best(k).alias("top"))
    nodes = shards
    while nodes > 1:
        nodes = math.ceil(nodes / FAN)
        best = (best.withColumn("node", F.floor(F.col("node") / FAN).cast("int"))
                .groupBy("query_id", "node")
                .agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
    return best.select("query_id", F.posexplode("top").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-1 - F.col("hit.order")).alias("score"))


def _best(k: int) -> Column:
    # -1 - score sorts descending and, unlike -score, exists for every long
    return F.slice(F.sort_array(F.collect_list(F.struct((-1 - F.col("score")).alias("order"), "beyond", "vec_id"))), 1, k)


def beyond(score: int) -> bytes | None:
    """For a score that no long holds: bytes that sort as such scores do, highest first."""
    if -LIMIT - 1 <= score <= LIMIT:
        return None
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return key if score < 0 else bytes(255 - b for b in key)


def _quantised(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * x), exact: as doubles where the product is one below 2**53, else as
    Python integers."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(out * scale)
    if (np.abs(scaled) < 2**53).all():
        return scaled
    return np.array([[math.floor(Fraction(x) * scale) for x in row] for row in out.tolist()], object).reshape(out.shape)


def _tile(k: int, scale: int):
    def run(asked: pd.DataFrame, dealt: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(dealt):
            dealt = dealt.sort_values("vec_id", kind="stable")
            node, ids = int(dealt["shard"].iloc[0]), dealt["vec_id"].to_numpy()
            width = max(map(len, [*asked["v"], *dealt["v"]]))
            right, left = _quantised(dealt["v"], width, scale), _quantised(asked["v"], width, scale)
            qids = asked["query_id"].to_numpy()
            if right.dtype == left.dtype == np.float64:
                largest = np.abs(right).max(initial=0) * np.abs(left).max(initial=0) * max(width, 1)
                # doubles multiply fastest and are exact below 2**53, longs below 2**63
                kind = np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object
            else:
                kind = object
            if kind is object:  # to Python integers; numpy's objects would hold doubles
                right, left = ([[int(x) for x in row] for row in m.tolist()] for m in (right, left))
            right, left = np.array(right, kind).reshape(-1, width).T, np.array(left, kind).reshape(-1, width)
            for i in range(0, len(left), SLICE):
                found += [_select(left[i:i + SLICE] @ right, qids[i:i + SLICE], ids, k)]
        if not found:
            return pd.DataFrame({"query_id": [], "node": [], "vec_id": [], "score": [], "beyond": []}).astype(
                {"query_id": "int64", "node": "int32", "vec_id": "int64", "score": "int64", "beyond": object})
        q, v, s = (np.concatenate(x) for x in zip(*found))
        key = [beyond(x) for x in s] if s.dtype == object else [None] * len(s)
        held = np.array([max(-LIMIT - 1, min(LIMIT, x)) for x in s], np.int64) if s.dtype == object else s
        return pd.DataFrame({"query_id": q, "node": np.full(len(q), node, np.int32), "vec_id": v, "score": held,
                             "beyond": pd.Series(key, dtype=object)})
    return run


def _select(scores: np.ndarray, qids: np.ndarray, ids: np.ndarray, k: int):
    """The k best of every row; ``ids`` ascend, so earlier columns win ties."""
    own = qids[:, None] == ids[None, :]
    if scores.dtype == object:
        lowest = min(scores.min(), 0) - 1
        scores = np.where(own, lowest, scores)
        order = np.array([sorted(range(len(ids)), key=lambda j: (-r[j], j))[:k] for r in scores])
        row = np.repeat(np.arange(len(qids)), order.shape[1])
        col = order.ravel()
        good = ~own[row, col]
        row, col = row[good], col[good]
        return qids[row], ids[col], scores[row, col]
    lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
    scores = np.where(own, lowest, scores)
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        above = scores > edge
        level = scores == edge
        room = k - above.sum(1)
        take = above | (level & (np.cumsum(level, axis=1) <= room[:, None]))
    else:
        take = np.ones(scores.shape, bool)
    row, col = np.nonzero(take & ~own)
    return qids[row], ids[col], scores[row, col].astype(np.int64)
