"""The registered queries of the package: ``queries()`` and ``oracle_sql()``.

Each query applies its operator to its whole table and derives the columns of its
contract from the operator's result.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (best_fit, byte_bpe, elias_fano, html_text, language_id, neighbours, periodic_runs, pii, quality_rules, simhash,
               spelling, top_k, url_rules)
from .common import prepare, stage_path, words_of


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out())
    predict = language_id.predictor(docs, model)
    return docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    uri = stage_path(spark, "token-files")
    manifest = elias_fano.write_files(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, uri=uri)

    def row(doc_id: int | None, start: int, ids: np.ndarray):
        return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
    return elias_fano.read_files(manifest, uri, row, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN
    path = tokenizer_path("byte_bpe_50k.tiktoken")

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe.byte_bpe(path, PATTERN)
        names = {i: str(i) for i in bpe.bytes_of}
        for texts in batches:
            out = []
            for i in range(0, len(texts), 128):
                for ids in bpe.encode_batch(texts.iloc[i:i + 128].tolist()):
                    out.append((len(ids), hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                                hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=texts.index)
    return table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"n_{k}" for k in pii.KINDS] + ["base_sha256", "spans"]

    @F.pandas_udf(", ".join([f"n_{k} long" for k in pii.KINDS] + ["base_sha256 string", "spans string"]))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                base, spans = pii.detect(t)
                out.append((*(sum(s[0] == k for s in base) for k in pii.KINDS),
                            hashlib.sha256(pii.written_out(base).encode()).hexdigest(), pii.written_out(spans)))
            yield pd.DataFrame(out, columns=names, index=texts.index)
    return table(spark, sf_dir, "documents").select("doc_id", found("text").alias("d")).select("doc_id", "d.*")


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def misspelt(doc_id: str, run: str) -> str:
    """The contract's misspelling: one run of a document in 97 lacks a code point."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    i = h % len(run)
    return run if h % 97 else run[:i] + run[i + 1:]


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), min_chars=5, min_count=3, respell=misspelt)
    return spelling.variants(words, ratio=2)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's repetition of a stretch of every tenth document."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    a = F.col("g") % n
    cut = docs.select("doc_id", "text", g.alias("g"), words_of(F.when(h % 10 == 0, F.col("text"))).alias("words"))
    cut = cut.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, 1 + F.floor((n - a) / (3 + F.col("g") % 8)))})
    source = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return cut.select("doc_id", F.when(F.col("p").isNotNull(), F.concat_ws(" ", source)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(repeated_tails(table(spark, sf_dir, "documents"))).select("doc_id", "_found.*")
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda top, r: F.when(  # the first of the greatest, as runs come by start and period
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_quality_rules, op2_top_k, op3_language_id, op4_token_files, op5_byte_bpe, op6_best_fit, op7_html_text,
           op8_pii, op9_url_rules, op10_simhash, op11_spelling, op12_neighbours, op13_periodic_runs, pipeline]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from . import sql
    out = dict(sql.ORACLES)
    import corpus_pipeline
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
