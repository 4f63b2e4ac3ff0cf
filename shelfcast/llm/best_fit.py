"""Best-fit packing planned on the length histogram.

Pieces are counted by length, at most ``capacity`` rows, and best-fit decreasing
runs over the counts: a group of equal sequences takes as many pieces of the next
length as fit, the fullest sequences that have room first. Bins that are alike
stay one group with consecutive numbers, so the plan is a short table of slot
ranges. Pieces then take their slots by rank within length. The rank comes from
two steps, a number within (length, bucket) and the bucket's offset, so no task
gathers all pieces of a hot length.

Defined results: null texts are empty, and the end id alone makes a piece of
length 1; repeated rows are packed as often as they occur; an empty table gives an
empty result. Only the named columns are read.
"""
from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, text_of, written
from .tokens import chunk_tokenizer

BUCKET_ROWS = 1_000_000


class Slots(NamedTuple):
    """Ranks [first, first + sequences * per) of a length: ``per`` pieces lie in each
    of consecutive sequences from ``sequence``, the first at ``offset``."""
    length: int
    first: int
    count: int
    per: int
    sequence: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int) -> list[Slots]:
    """Best-fit decreasing over counts."""
    out: list[Slots] = []
    rooms: list[int] = []                       # rooms left, ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number)
    sequences = 0

    def put(room: int, first: int, number: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((first, number))
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} outside 1 to {capacity}")
        left, rank = histogram[length], 0
        while left > 0:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, number = capacity, sequences, math.ceil(left / (capacity // length))
                sequences += number
            per = room // length
            whole = min(number, left // per)
            if whole:
                out.append(Slots(length, rank, whole * per, per, first, capacity - room))
                rank, left = rank + whole * per, left - whole * per
                put(room - per * length, first, whole)
            if whole < number and left:  # fewer are left than one sequence has room for
                out.append(Slots(length, rank, left, left, first + whole, capacity - room))
                put(room - left * length, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            if whole < number:
                put(room, first + whole, number - whole)
    return out


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, text: str = "text",
              doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a document's ids and the end
    id, cut into pieces of ``capacity`` if longer; the first piece takes the rest."""
    fields = "piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    @F.pandas_udf(f"array<struct<{fields.replace(' ', ':').replace(',:', ', ')}>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = chunk_tokenizer(tokenizer_path)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        names = [x.split()[0] for x in fields.split(", ")]
        for texts in batches:
            out = []
            for raw in tokenizer.encode(texts.tolist()):
                ids = np.frombuffer(raw + end, tokenizer.dtype).astype("<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                data = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                out.append([dict(zip(names, (n, cuts[n], len(x) // 4, zlib.crc32(x), x))) for n, x in enumerate(data)])
            yield pd.Series(out, index=texts.index, dtype=object)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.explode(cut(text_of(text))).alias("p")).select("doc_id", "p.*")


def assign(pieces: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with a column ``length``) and their sequence_id and offset. ``pieces``
    is read more than once; give a written table."""
    spark = pieces.sparkSession
    # the number of lengths is at most the capacity
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(histogram, capacity)
    buckets = max(shuffle_partitions(spark), math.ceil(sum(histogram.values()) / BUCKET_ROWS))
    dealt = pieces.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("length", "_b").agg(F.count("*").alias("_n"))
               .select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    ranked = (dealt.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_b").orderBy(*order)) - 1)
              .join(offsets, ["length", "_b"]).withColumn("_rank", F.col("_before") + F.col("_r")))
    # a few ranges a length, so of bounded size whatever the number of pieces
    table = F.broadcast(spark.createDataFrame(
        slots, "_length long, _first long, _count long, _per long, _sequence long, _offset long"))
    at = F.col("_rank") - F.col("_first")
    joined = ranked.join(table, (F.col("length") == F.col("_length")) & (at >= 0) & (at < F.col("_count")))
    return joined.select(*pieces.columns,
                         (F.col("_sequence") + F.floor(at / F.col("_per"))).cast("long").alias("sequence_id"),
                         (F.col("_offset") + F.pmod(at, F.col("_per")) * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, text: str = "text",
         doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every piece with its place: tokenise once (written), plan, assign."""
    return assign(written(pieces_of(docs, tokenizer_path, end_id, capacity, text, doc_id, with_ids), "pack-pieces"), capacity)
