"""URL rules by a sort-merge range join over reversed-host keys.

A host's labels in reverse order are its canonical key, under which a host and all
its subdomains lie in one interval and intervals nest or are apart. Urls are dealt
into ranges of (key, path, id), cut at points taken from a small sample (which
balances the work and decides nothing else); a rule goes to every range its
interval meets. In each range one sorted sweep keeps a stack of the nested rules
that are active and asks it, longest first, for a rule whose path begins the url's.

A host that owns a third of all pages is cut between its paths and ids, so no range
gathers it. A range receives the rules that begin in it and the active rules at its
left edge, which are those of one host's ancestors.

Defined results: a null url or one without :// has an empty host and path and gets
the default verdict; of two rules alike the smaller verdict holds; rules with a null
host, path or verdict are none; without rules every url gets the default; repeated
rows come back as often as they occur. Only the named columns are read.
"""
from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

RANGE_ROWS = 50_000
SAMPLED = 32  # rows of the sample a range

Key = tuple[str, ...]


def key_of(host: str) -> Key:
    return tuple(reversed(host.split(".")))


def after(key: Key) -> Key:
    """The least key above every key that begins with ``key``."""
    return (*key[:-1], key[-1] + "\0")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rest = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return (pages.withColumn("_rest", rest)
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1), upper, lower))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)).drop("_rest"))


class Stack:
    """Active rules: a level for each rule host that begins the current key."""

    def __init__(self):
        self.levels: list[tuple[Key, dict[str, tuple[str, str]], list[int]]] = []

    def move_to(self, key: Key) -> None:
        while self.levels and key[:len(self.levels[-1][0])] != self.levels[-1][0]:
            self.levels.pop()

    def push(self, key: Key, paths: dict[str, tuple[str, str]]) -> None:
        self.move_to(key)
        self.levels.append((key, paths, sorted({len(p) for p in paths}, reverse=True)))

    def longest(self, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        best = None
        for _, paths, lengths in self.levels:
            for n in lengths:
                if n <= len(path) and (found := paths.get(path[:n])):
                    if best is None or len(found[0]) > len(best[0]):
                        best = found
                    break
        return best


def sweep(rules: list[tuple[str, str, str]], urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
    """The longest rule of every (host, path)."""
    by_key: dict[Key, dict[str, tuple[str, str]]] = defaultdict(dict)
    for host, path, verdict in sorted(rules, reverse=True):
        by_key[key_of(host)][path] = (host + path, verdict)
    keys = [key_of(h) for h, _ in urls]
    starts = sorted(by_key)
    out: list[tuple[str, str] | None] = [None] * len(urls)
    stack, i = Stack(), 0
    for u in sorted(range(len(urls)), key=keys.__getitem__):
        while i < len(starts) and starts[i] <= keys[u]:
            stack.push(starts[i], by_key[starts[i]])
            i += 1
        stack.move_to(keys[u])
        out[u] = stack.longest(urls[u][1])
    return out


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id",
          keep: Sequence[str] = ("page_id",), default: str = "allow") -> DataFrame:
    """The ``keep`` columns, host, path, rule (null if none fits) and verdict.
    ``rules``: host, path, verdict."""
    result = ("host", "path", "rule", "verdict")
    carried = [c for c in keep if c.lower() not in result]
    kept = [f"_k{i}" for i in range(len(carried))]
    urls = with_host_and_path(pages.select(
        F.col(url).alias("_url"), F.coalesce(F.col(page_id).cast("string"), F.lit("")).alias("_id"),
        *[F.col(c).alias(k) for c, k in zip(carried, kept)]), "_url").drop("_url")
    cuts = _cuts(urls)
    shared = pages.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def range_of(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path, ident in batches:
            yield pd.Series([bisect_right(shared.value, (key_of(h), p, i)) for h, p, i in zip(host, path, ident)],
                            index=host.index, dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_met(hosts: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_right(shared.value, (k := key_of(h), "", "")),
                                     bisect_right(shared.value, (after(k), "", "")) + 1)) for h in hosts], index=hosts.index)

    dealt = urls.withColumn("range", range_of("host", "path", "_id"))
    rules = (rules.select(*[F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict")]).dropna()
             .withColumn("range", F.explode(ranges_met("host"))))
    out = urls.select(*kept, "host", "path").schema.add("rule", "string").add("verdict", "string")
    found = rules.groupBy("range").cogroup(dealt.groupBy("range")).applyInArrow(_sweeper(kept), out)
    return found.select(*[F.col(k).alias(c) for c, k in zip(carried, kept)], "host", "path", "rule",
                        F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _cuts(urls: DataFrame) -> list[tuple[Key, str, str]]:
    """Cut points for ranges of at most about RANGE_ROWS rows; one range a shuffle
    partition at least. The sample has about SAMPLED rows a range."""
    n = urls.count()
    ranges = max(shuffle_partitions(urls.sparkSession), n // RANGE_ROWS + 1)
    step = max(1, n // (ranges * SAMPLED))
    sample = urls.where(F.pmod(F.xxhash64("_id", "host", "path"), F.lit(step)) == 0).select("host", "path", "_id")
    points = sorted((key_of(r["host"]), r["path"], r["_id"]) for r in sample.collect())
    return sorted({points[len(points) * i // ranges] for i in range(1, ranges)}) if points else []


def _sweeper(kept: list[str]):
    def run(rules: pa.Table, dealt: pa.Table) -> pa.Table:
        found = sweep(list(zip(*(rules[c].to_pylist() for c in ("host", "path", "verdict")))),
                      list(zip(dealt["host"].to_pylist(), dealt["path"].to_pylist())))
        out = dealt.select([*kept, "host", "path"])
        for i, name in enumerate(("rule", "verdict")):
            out = out.append_column(name, pa.array([f and f[i] for f in found], pa.string()))
        return out
    return run
