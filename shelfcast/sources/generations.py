"""Tables by day of which every change is published as a generation.

A change writes its rows to ``<path>/data/v=<version>/<day>=YYYY-MM-DD/`` and then, as its
last step, publishes ``<path>/_generations/<n>.json``: the versions that count for each day.
Files are never changed in place, so a reader sees one generation from its first file to
its last, whatever a load, a refresh or a compaction does meanwhile, and a change that
failed half-way leaves nothing visible. What the driver handles is a line a day.

One loader (``append`` or ``replace``) and one compactor may run side by side: whoever
publishes second builds on the other's generation.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # the folder value that Spark gives a NULL day


class DayTable:
    """``day`` names the date column by which the table is laid out; a NULL day is a day.

    The newest ``keep`` generations can be read; versions that none of them names are
    removed, so a reader may be overtaken by ``keep - 1`` changes."""

    def __init__(self, spark: SparkSession, path: str, day: str = "date", keep: int = 2):
        self.spark, self.path, self.day, self.keep = spark, path, day, keep

    # ------------------------------------------------------------ reading
    def generations(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/_generations") if n.endswith(".json")]

    def manifest(self, generation: int | None = None) -> dict:
        """``generation``, ``schema``, ``days`` {day: {"versions": [...], "changed": generation}},
        ``through`` (the generation of its source that a refresh has seen) and ``basis``."""
        known = self.generations()
        if not known:
            return {"generation": 0, "schema": None, "days": {}, "through": 0, "basis": None}
        n = known[-1] if generation is None else generation
        fs, p = self._fs(f"{self.path}/_generations/{n:020d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def read(self, days: Sequence[str] | None = None, manifest: dict | None = None) -> DataFrame | None:
        """The rows of a generation (by default the newest), of ``days`` only if given;
        other days' folders are not listed. None before the first load."""
        m = manifest or self.manifest()
        if m["schema"] is None:
            return None
        wanted = m["days"] if days is None else [d for d in days if d in m["days"]]
        return self._rows(m, [(d, v) for d in wanted for v in m["days"][d]["versions"]])

    def _rows(self, m: dict, parts: Sequence[tuple[str, str]]) -> DataFrame:
        schema = StructType.fromJson(m["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/v={v}/{self.day}={d}" for d, v in parts])
        return rows.select(*schema.names)

    # ------------------------------------------------------------ changing
    def append(self, rows: DataFrame) -> list[str]:
        """Add ``rows`` next to what their days hold; returns those days."""
        version, days = self._write(rows, "append")

        def added(m: dict, n: int) -> dict:
            old = {d: m["days"].get(d, {"versions": []})["versions"] for d in days}
            return m | {"days": m["days"] | {d: {"versions": [*old[d], version], "changed": n} for d in days}}
        self._publish(rows.schema, added)
        return days

    def replace(self, rows: DataFrame, days: Sequence[str] | None = None, through: int = 0, basis: str | None = None) -> list[str]:
        """Put ``rows`` in place of ``days`` (of all days if None); a day of which no row is
        left goes. Days of ``rows`` beyond ``days`` are an error. Returns the days written."""
        version, found = self._write(rows, "replace")
        if days is not None and set(found) - set(days):
            raise ValueError(f"rows of other days than those replaced: {sorted(set(found) - set(days))[:5]}")

        def replaced(m: dict, n: int) -> dict:
            gone = m["days"] if days is None else days
            stay = {d: e for d, e in m["days"].items() if d not in gone}
            return m | {"through": through, "basis": basis,
                        "days": stay | {d: {"versions": [version], "changed": n} for d in found}}
        self._publish(rows.schema, replaced)
        return found

    def compact(self, most: int = 1) -> list[str]:
        """Rewrite the days that lie in more than ``most`` versions as one; contents stay,
        so nothing that follows the table has to be refreshed. Returns those days."""
        before = self.manifest()
        merged = {d: e["versions"] for d, e in before["days"].items() if len(e["versions"]) > most}
        if not merged:
            return []
        version, _ = self._write(self._rows(before, [(d, v) for d, vs in merged.items() for v in vs]), "compact")

        def compacted(m: dict, n: int) -> dict:
            days = dict(m["days"])
            for d, vs in merged.items():
                now = days.get(d, {"versions": []})["versions"]
                if now[:len(vs)] == vs:  # a day that was replaced meanwhile stays as it is now
                    days[d] = days[d] | {"versions": [version, *now[len(vs):]]}
            return m | {"days": days}
        self._publish(StructType.fromJson(before["schema"]), compacted)
        return list(merged)

    def _write(self, rows: DataFrame, kind: str) -> tuple[str, list[str]]:
        """Write a version; a large day is split over several tasks and files."""
        named = {v for n in self.generations() for e in self.manifest(n)["days"].values() for v in e["versions"]}
        for name in self._names(f"{self.path}/data"):  # what an earlier writer of this kind left unpublished
            if name.endswith(f"-{kind}") and name.removeprefix("v=") not in named:
                self._delete(f"{self.path}/data/{name}")
        version = f"{self.manifest()['generation'] + 1}-{kind}"
        folder = f"{self.path}/data/v={version}"
        rows.hint("rebalance", self.day).write.mode("overwrite").partitionBy(self.day).parquet(folder)
        prefix = f"{self.day}="
        return version, [n.removeprefix(prefix) for n in self._names(folder) if n.startswith(prefix)]

    def _publish(self, schema: StructType, change: Callable[[dict, int], dict]) -> None:
        while True:
            newest = self.manifest()
            n = newest["generation"] + 1
            new = change(newest, n) | {"generation": n, "schema": schema.jsonValue()}
            _, draft = self._fs(f"{self.path}/_generations/{uuid.uuid4().hex}.draft")
            fs, target = self._fs(f"{self.path}/_generations/{n:020d}.json")
            stream = fs.create(draft, True)
            stream.write(bytearray(json.dumps(new).encode()))
            stream.close()
            if not fs.exists(target) and fs.rename(draft, target):
                break
            fs.delete(draft, False)
        self._forget()

    def _forget(self) -> None:
        known = self.generations()

        def parts(n: int) -> set[tuple[str, str]]:
            return {(d, v) for d, e in self.manifest(n)["days"].items() for v in e["versions"]}
        stay = set().union(*[parts(n) for n in known[-self.keep:]])
        for n in known[:-self.keep]:
            for d, v in parts(n) - stay:
                self._delete(f"{self.path}/data/v={v}/{self.day}={d}")
            self._delete(f"{self.path}/_generations/{n:020d}.json")

    # ------------------------------------------------------------ the file system below
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)


def refresh(log: DayTable, mart: DayTable, build: Callable[[DataFrame], DataFrame], dimension: DataFrame | None = None) -> list[str]:
    """Build the days of ``mart`` that ``log`` has changed since the mart's last refresh.

    ``build`` maps the log's rows of some days to the mart's rows of those days (each
    mart row must depend on its own day alone). Late rows change the day that they belong
    to, whenever they come. If ``dimension`` (the rows that the build joins) is not what the
    last refresh saw, every day is built again. Returns the days built."""
    source, target = log.manifest(), mart.manifest()
    basis = None if dimension is None else fingerprint(dimension)
    if target["generation"] and basis == target["basis"]:
        touched = [d for d, e in source["days"].items() if e["changed"] > target["through"]]
    else:
        touched = list(source["days"])
    if source["schema"] is not None and (touched or not target["generation"]):
        whole = set(touched) >= set(target["days"])
        mart.replace(build(log.read(touched, source)), None if whole else touched, source["generation"], basis)
    return touched


def fingerprint(df: DataFrame) -> str:
    """Row count and sum of 64-bit row hashes, whatever the order of the rows."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(*cols, *[c.isNull() for c in cols]).cast("decimal(38,0)")
    return "{} {}".format(*df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first())
