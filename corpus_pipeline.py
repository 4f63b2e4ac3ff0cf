"""A text corpus from ``documents`` to packed training sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and gives
a DataFrame, which is written as Parquet and read again as the next one's docs. All
but the last return the columns of their docs. A null text fails the quality
rules; rows that repeat a doc_id are judged one by one until SimHash keeps one row
of each group; an empty table passes through as one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import best_fit, language_id, pii, quality_rules, simhash
from shelfcast.llm.common import prepare, written
from shelfcast.llm.queries import tokenizer_path

MIN_LANGUAGE_SCORE = 0.5
ORACLE_SQL = None  # language ID, SimHash and packing have no SQL form


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep."""
    prepare(spark)
    whole = docs.select(F.struct("*").alias("doc"), "text", "source")
    return quality_rules.quality_rules(whole, keep=["doc"]).where("kept").select("doc.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the predictor names with some certainty: the posterior
    says which language, the share of known words whether it is any (a text in a learned
    language's close relative may pass). All labelled rows count: two thirds are learned
    from, the rest say how low a share is low. Rows are predicted once and written."""
    prepare(spark)
    learned = lambda doc_id: F.crc32(F.col(doc_id).cast("string")) % 3 != 1
    model = language_id.train(docs, learned("doc_id"))
    if not model.languages:  # nothing to learn from, so no ground to reject anything
        return docs
    predict = language_id.predictor(docs, model)
    judged = written(docs.select(F.struct("*").alias("doc"), predict("text").alias("p")), "language-judged")
    unlearned = language_id.unlearned(judged, model, ~learned("doc.doc_id"), F.col("doc.lang"))
    return (judged
            .where((F.col("p.lang") != "und") & (F.col("p.score") >= MIN_LANGUAGE_SCORE) & ~unlearned)
            .select("doc.*"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, also of a group without a doc_id and of groups whose
    smallest doc_id is the same."""
    prepare(spark)
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    prepare(spark)

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda t: pii.masked(t, pii.detect(t)[1]), na_action="ignore")
    masked = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    prepare(spark)
    return best_fit.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [("quality rules", quality_stage), ("language ID", language_stage), ("near duplicates", near_duplicate_stage),
          ("personal data", private_data_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
