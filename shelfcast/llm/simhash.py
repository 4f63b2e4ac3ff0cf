"""SimHash near-duplicates from a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes. Fingerprints at ``max_bits`` = 4 or
fewer differing bits differ in at most 4 bytes, so they share at least 8 - 4 = 4
positional bytes. Posting lists of single bytes would hold a 256th of all rows
each, so the lists are keyed by three positional bytes at once: 20 triples of
positions are enough for any 4 shared positions to contain one of them. In a list,
the shared positional bytes of each pair are tallied, pairs that reach the
guaranteed minimum are kept, and their differing bits are counted.

Equal fingerprints are one node, so copies never form pairs. Lists longer than
``BLOCK`` are split into pairs of blocks, each a group of its own, so a list that a
dense group of near copies makes long is spread over tasks; every pair of the list
still meets in one of them. A group gives back a spanning forest of its links (no
more links than members), not all pairs. Components come from rounds of smallest
neighbour and pointer jumping over written tables.

Defined results: a null text and one without a word have fingerprint zero and are
linked like any other; fewer words than a shingle make one shingle; repeated rows
have the same fingerprint and so the same component; null doc_ids come back, but
name no component (a component of nothing else has a null id); an empty table gives
an empty result. Only the named columns are read. ``one_of_each`` goes by row: a
component without an id keeps a row, and so does each of two that share their
smallest id.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WORDS = re.compile(WORD.encode())
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
BLOCK = 512
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bits set in over half of the hashes of all word shingles."""
    words = WORDS.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(words) > 1 else np.zeros(1, np.int64)
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if len(words) > shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, SHINGLES_AT_ONCE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[i:i + SHINGLES_AT_ONCE], last[i:i + SHINGLES_AT_ONCE])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def triples() -> list[tuple[int, int, int]]:
    """Triples of the 8 positions, one of which lies in any 4 positions: with the
    positions in three classes in a circle, those within a class and those with two
    in a class and one in the next (Turan's construction)."""
    kind = [p % 3 for p in range(8)]

    def listed(t):
        k = sorted(kind[p] for p in t)
        if k[0] == k[2]:
            return True
        twice = k[1]
        other = k[0] if k[0] != twice else k[2]
        return len(set(k)) == 2 and other == (twice + 1) % 3
    return [t for t in combinations(range(8), 3) if listed(t)]


def _fingerprints(shingle: int):
    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64), index=texts.index)
    return fp


def with_fingerprints(docs: DataFrame, text: str, doc_id: str, shingle: int) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), _fingerprints(shingle)(F.col(text)).alias("fp"))


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b) of a forest that connects what links of at most ``max_bits`` (0 to 4)
    differing bits connect. ``fps``: distinct long ``fp``, read more than once."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees matches for 0 to 4 differing bits")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255) for p in range(8)]
    keys = F.array(*[(F.lit(i) * (1 << 24) + byte[a] * (1 << 16) + byte[b] * (1 << 8) + byte[c]).cast("int")
                     for i, (a, b, c) in enumerate(triples())])
    postings = fps.select("fp", F.explode(keys).alias("key"))
    # the lists that must be split; Spark broadcasts them if their written size is small
    long = written(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                   .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "simhash-long")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = (postings.join(long, "key", "left")
              .withColumn("mine", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "fp"))
    return (placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInPandas(_linked(max_bits), "a long, b long"))


def _linked(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            part = pdf.to_numpy(np.int64)
            if rest is not None:
                part = np.concatenate([rest, part])
            if not len(part):
                continue
            change = np.flatnonzero((part[1:, :3] != part[:-1, :3]).any(1)) + 1
            if len(change):
                yield _groups(part[:change[-1]], change[:-1], max_bits)
                rest = part[change[-1]:]
            else:
                rest = part
        if rest is not None:
            yield _groups(rest, np.zeros(0, np.int64), max_bits)
    return run


def _groups(part: np.ndarray, change: np.ndarray, max_bits: int) -> pd.DataFrame:
    bounds = np.concatenate([[0], change, [len(part)]])
    sizes = np.diff(bounds)
    out = [np.zeros((0, 2), np.int64)]
    for g in np.flatnonzero(sizes > 1):
        rows = part[bounds[g]:bounds[g + 1]]
        out.append(forest(rows[:, 4], rows[:, 3], rows[0, 1] != rows[0, 2], max_bits))
    return pd.DataFrame(np.concatenate(out), columns=["a", "b"])


def forest(fps: np.ndarray, block: np.ndarray, across: bool, max_bits: int) -> np.ndarray:
    """A spanning forest of the links among ``fps`` (only between blocks if ``across``).
    A pair is kept if its tally of shared positional bytes reaches 8 - max_bits, and
    then verified by its differing bits."""
    n = len(fps)
    differ = fps[:, None] ^ fps[None, :]
    tally = (np.ascontiguousarray(differ).view(np.uint8).reshape(n, n, 8) == 0).sum(2)
    near = (tally >= 8 - max_bits)
    if across:
        near &= block[:, None] != block[None, :]
    near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= max_bits
    np.fill_diagonal(near, False)
    edges, seen = [], np.zeros(n, bool)
    for s in np.flatnonzero(near.any(1)):
        if seen[s]:
            continue
        seen[s] = True
        todo = [s]
        while todo:
            u = todo.pop()
            new = np.flatnonzero(near[u] & ~seen)
            seen[new] = True
            edges += [(fps[u], fps[v]) for v in new]
            todo += new.tolist()
    return np.array(edges, np.int64).reshape(-1, 2)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node with an edge can reach."""
    edges = written(edges.distinct(), "simhash-links")
    both = written(edges.union(edges.select("b", "a")).distinct(), "simhash-neighbours")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                     .withColumnRenamed("a", "node"), "simhash-labels")
    while True:
        offered = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("offer")))
        lower = written(labels.join(offered, labels.node == offered.a).select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label")), "simhash-lower")
        jump = lower.select(F.col("node").alias("via"), F.col("label").alias("far"))
        labels = written(lower.join(jump, lower.label == jump.via, "left")
                         .select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "simhash-labels")
        changed = labels.where("label < old").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels


def _labelled(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, least, label) of every distinct fingerprint of ``rows``: the smallest doc_id
    that has it and the smallest fingerprint of its component."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(links(nodes.select("fp"), max_bits))
    return nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    rows = written(with_fingerprints(docs, text, doc_id, shingle), "simhash-fingerprints")
    labelled = _labelled(rows, max_bits)
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = written(labelled.join(named, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(of_node, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component: of its smallest doc_id (null if it has no
    other), then by a hash of the row. Fingerprints are computed once and the texts
    shuffled once, to the chosen (doc_id, hash of the row)."""
    own = F.col(doc_id).cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.xxhash64(*columns, *[c.isNull() for c in columns])  # a null leaves a hash as it is
    key = [own.isNull().alias("none"), F.coalesce(own, F.lit(0)).alias("id"), row.alias("row")]
    rows = written(docs.select(own.alias("doc_id"), *key, _fingerprints(shingle)(F.col(text)).alias("fp")), "simhash-fingerprints")
    chosen = (rows.join(_labelled(rows, max_bits).select("fp", "label"), "fp").groupBy("label")
              .agg(F.min(F.struct("none", "id", "row")).alias("k")).select("k.*").distinct())
    stay = written(chosen, "simhash-stay")
    found = docs.select(F.struct(*columns).alias("doc"), *key).join(stay, ["none", "id", "row"])
    alike = F.row_number().over(Window.partitionBy("none", "id", "row").orderBy("row"))
    return found.withColumn("alike", alike).where("alike = 1").select("doc.*")
