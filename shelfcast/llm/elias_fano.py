"""Token-id files with Elias-Fano document boundaries.

A file holds the ids of its documents one after another, their doc_ids, and the
documents' ends as an Elias-Fano sequence: the low bits of every end in a packed
array, the high bits in unary in a bit vector. ``select`` (a sampled directory and
a popcount scan) finds the high part of the i-th end, so an offset costs about
2 + log2(tokens / documents) bits instead of 64.

Layout, little-endian: eight 64-bit integers (magic, documents, tokens, bytes an
id, low bits, bytes of the low array, bytes of the bit vector, directory entries),
then doc_ids (int64), null flags of the doc_ids (1 byte each), low array, bit
vector, directory (uint32), ids.

Writing: documents are range-partitioned and sorted by doc_id, each task encodes
its range and writes files of about ``FILE_TOKENS`` tokens to the shared folder
under a temporary name and then renames them, so a repeated or speculative task
leaves one whole file. The manifest (a row per file) comes back through Spark's
own committer; files that no manifest row names are never read.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage_path, text_of, written
from .tokens import chunk_tokenizer

MAGIC = 0x31304B5446453031
SAMPLE = 64  # ones of the bit vector a directory entry
FILE_TOKENS = 4_000_000
READ_DOCS = 4096
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass
class EliasFano:
    """A non-decreasing sequence of non-negative integers."""
    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    directory: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        low = np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.directory[i // SAMPLE])
        left = i % SAMPLE  # ones to pass after the one at start
        byte = start >> 3
        head = int(self.high[byte]) >> (start & 7) << (start & 7)
        while (here := int(POPCOUNT[head])) <= left:
            left -= here
            byte += 1
            head = int(self.high[byte])
        for _ in range(left):
            head &= head - 1
        position = byte * 8 + (head & -head).bit_length() - 1
        return (position - i) << self.low_bits | self._low(i)

    def select_range(self, first: int, last: int) -> np.ndarray:
        """The values from the first-th to the one before the last-th: one select by the
        directory, then a scan of the bit vector up to the range's end."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last))
        start = int(self.directory[first // SAMPLE]) >> 3 if first < last else 0
        after = -(-last // SAMPLE)
        stop = (int(self.directory[after]) >> 3) + 1 if after < len(self.directory) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        # ones before the sampled one may share its byte
        skip = int(np.searchsorted(ones, int(self.directory[first // SAMPLE]))) + first % SAMPLE if first < last else 0
        ones = ones[skip:skip + last - first]
        at, width = first * self.low_bits, (last - first) * self.low_bits
        bits = np.unpackbits(self.low[at >> 3:(at + width + 7) >> 3], bitorder="little")[at & 7:(at & 7) + width]
        low = (bits.reshape(last - first, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return ((ones - np.arange(first, last)) << self.low_bits) | low

    def _low(self, i: int) -> int:
        first, bits = i * self.low_bits, self.low_bits
        chunk = self.low[first >> 3:(first + bits + 7) >> 3]
        return int.from_bytes(chunk.tobytes(), "little") >> (first & 7) & ((1 << bits) - 1)

    def all(self) -> np.ndarray:
        return self.select_range(0, self.n)


class TokenFile:
    """The bytes of one file; ``ids(i)`` are document i's, found by two selects."""

    def __init__(self, data: bytes):
        magic, n, tokens, width, low_bits, low, high, directory = np.frombuffer(data, "<i8", 8).tolist()
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = 64

        def take(dtype, count):
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out
        self.n, self.tokens = n, tokens
        self.doc_ids, self.nulls = take("<i8", n), take("u1", n)
        self.ends = EliasFano(n, low_bits, take("u1", low), take("u1", high), take("<u4", directory))
        self.array = take(f"<u{width}", tokens)

    def ids(self, i: int) -> np.ndarray:
        return self.array[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


def file_bytes(doc_ids: list, ids: list[bytes], width: int) -> bytes:
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    tokens = int(ends[-1]) if len(ends) else 0
    e = EliasFano.of(ends, tokens + 1)
    head = np.array([MAGIC, len(ids), tokens, width, e.low_bits, len(e.low), len(e.high), len(e.directory)], "<i8")
    return b"".join([head.tobytes(), np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
                     np.array([d is None for d in doc_ids], "u1").tobytes(), e.low.tobytes(), e.high.tobytes(),
                     e.directory.astype("<u4").tobytes(), *ids])


def _store(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, tokenizer_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
                uri: str | None = None) -> DataFrame:
    """Write the files below ``uri`` (by default a new folder in the shared one) and
    return their manifest in order: part, seq, path, n_docs, n_tokens, start (ids in
    all files before).

    Null texts are empty and hold the end id alone; null doc_ids come first; rows
    that repeat a doc_id follow each other by their text; an empty table writes no
    file. Only the two columns are read."""
    uri = uri or stage_path(docs.sparkSession, "token-files")
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
               .repartitionByRange(shuffle_partitions(docs.sparkSession), F.asc_nulls_first("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text"))
    manifest = written(ordered.mapInArrow(
        _writer(uri, tokenizer_path, end_id), "part int, seq int, path string, n_docs long, n_tokens long"), "token-manifest")
    # running sums in two steps: files within a part, and parts, of which there are as many as tasks wrote
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    totals = {r["part"]: r["n"] for r in manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    offset, offsets = 0, []
    for part in sorted(totals):
        offsets.append((part, offset))
        offset += totals[part]
    parts = F.broadcast(docs.sparkSession.createDataFrame(offsets, "part int, _offset long"))
    return manifest.join(parts, "part").withColumn(
        "start", F.col("_offset") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).drop("_offset")


def _writer(uri: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        tokenizer = chunk_tokenizer(tokenizer_path)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        doc_ids, ids, size = [], [], 0

        def flush():
            nonlocal doc_ids, ids, size, seq
            store, folder = _store(uri)
            store.create_dir(folder, recursive=True)
            name = f"{folder}/tokens-{part:05d}-{seq:05d}.ef"
            with store.open_output_stream(tmp := f"{name}.{uuid.uuid4().hex}") as out:
                out.write(file_bytes(doc_ids, ids, tokenizer.width))
            store.move(tmp, name)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]), pa.array(
                [len(ids)]), pa.array([size // tokenizer.width])], ["part", "seq", "path", "n_docs", "n_tokens"])
            doc_ids, ids, size, seq = [], [], 0, seq + 1
            return row
        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(batch.column("text").to_pylist())):
                doc_ids.append(d)
                ids.append(t + end)
                size += len(ids[-1])
                if size >= FILE_TOKENS * tokenizer.width:
                    yield flush()
        if ids:
            yield flush()
    return run


def read_files(manifest: DataFrame, uri: str, per_document, schema: str) -> DataFrame:
    """``per_document(doc_id, start, ids)`` gives a tuple of ``schema`` for every
    document, from the files that the manifest names; a task a file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in schema.split(",")]
        for pdf in batches:
            for path, start in zip(pdf["path"], pdf["start"]):
                with _store(uri)[0].open_input_file(path) as f:
                    file = TokenFile(f.read())
                begin = 0
                for i in range(0, file.n, READ_DOCS):  # offsets of a few documents at once, never a table of all
                    ends = file.ends.select_range(i, min(i + READ_DOCS, file.n))
                    begins = np.concatenate([[begin], ends[:-1]])
                    begin = int(ends[-1])
                    out = [per_document(None if file.nulls[i + j] else int(file.doc_ids[i + j]), int(start) + int(a),
                                        file.array[a:b]) for j, (a, b) in enumerate(zip(begins.tolist(), ends.tolist()))]
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
    n = shuffle_partitions(manifest.sparkSession)
    return manifest.select("path", "start").repartition(n).mapInPandas(run, schema)
