"""The corpus pipeline: quality, repeated lines, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir), works on all of ``docs`` and, but for the last, returns the
columns it was given.  ``n_chars``, where there is one, follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontaminate, lines, minhash, quality
from siltstone.llm.queries import remainder
from siltstone.llm.text import fingerprint, fresh_name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects; it learns from the labels of those not held out.

    Null and empty texts have no features and are judged by the bias alone; repeated rows are judged alike.
    """
    model = quality.learn(docs.where(remainder() != 2), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages of lines out of the texts; no document goes.

    Null texts stay null; copies of a whole text become empty but for the first, by id.
    """
    kept = lines.drop_repeated_lines(docs).select(docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near copies.

    Equal texts without words, null and empty ones together, are a class as well.  Of rows with equal id and text one stays.
    """
    return minhash.survivors(docs, wordless=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs; null texts have none, repeated rows go together."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), columns=[])
    found = found.where("contaminated").select("text_fp").distinct()
    key = fresh_name(docs, "fp")
    keyed = docs.withColumn(key, fingerprint("text"))
    return keyed.join(found.withColumnRenamed("text_fp", key).hint("merge"), key, "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to; a null text has no ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near_copies", keep_one_of_each),
    ("benchmark", drop_contaminated),
    ("tokens", encode),
]

ORACLE_SQL = None  # no stage but the fourth can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
