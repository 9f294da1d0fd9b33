"""The operators of this package as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, chat, decontaminate, filter_audit, fm_index, language, lines, minhash, quality, runs, sql, suffixes, toxicity, vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str = "doc_id") -> Column:
    """Documents of remainder 2 are held out of training; those without an id train nothing either."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4


def _held_out() -> Column:
    return F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")


@_query("op1_grid_order_join", sql.LINKED_VECTORS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = vectors.near_vectors(_table(spark, sf_dir, "embeddings"))
    return linked.select("vec_id", "n_links", "component_id", "kept")


@_query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = language.prototypes(language.gram_counts(docs.where(remainder() != 2)))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", _held_out(), "lang_pred", "score")


@_query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn(docs.where(remainder() != 2), labels)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", _held_out(), "score", "predicted")


@_query("op3_fm_index", sql.REPEATED_WORDS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fm_index.drop_repeated_words(_table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return kept.drop("text")


@_query("op4_line_chunks", sql.REPEATED_LINES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_removed_lines", digest.alias("kept_sha256"))


@_query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, ids=False).drop("text")


_SAID = "</s>[INST] ok [/INST]"

def _as_events(turn: Column, role: Column, text: Column) -> Column:
    """How a log tells a row: an assistant's text comes in three parts, other texts are drafts first and then edited."""
    size = F.length(text)
    third = F.floor(size / 3).cast("int")
    first, second, last = (F.substr(text, start, length) for start, length in ((F.lit(1), third), (third + 1, third), (third * 2 + 1, size)))
    place = F.coalesce(turn, F.lit(0)).cast("bigint") * 4

    def event(later: int, kind: str, said: Column) -> Column:
        return F.struct((place + later).alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))

    streamed = F.array(event(0, "message", first), event(1, "delta", second), event(2, "delta", last))
    edited = F.array(event(0, "message", F.concat(F.lit("draft of "), first)), event(1, "edit", text))
    return F.when(role == "assistant", streamed).otherwise(edited)


@_query("op6_chat_events", sql.CHATS)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", _SAID), (-7, 1, "assistant", _SAID)], kinds))
    # every row is a message of its own, also where turns are tied; equal rows are counted and then numbered,
    # which comes out the same when a task runs again
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy"))
    target = F.struct("turn", "role", F.md5(F.col("text").cast("binary")).alias("text"), "copy")
    events = rows.select("conv_id", target.alias("target"), "role", F.inline(_as_events(F.col("turn"), F.col("role"), F.col("text"))))
    rendered = chat.format_events(events, conversation="conv_id")
    return chat.read_back(rendered).withColumnRenamed("conversation", "conv_id")


@_query("op7_dart_minhash", sql.NEAR_COPIES)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.classify(_table(spark, sf_dir, "documents").select("doc_id", "text"), wordless=True)
    return found.select("doc_id", "class_id", "kept")


@_query("op8_suffix_family", sql.REPEATED_BYTES)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.drop_repeated_bytes(_table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return kept.drop("text")


@_query("op9_decontamination", sql.CONTAMINATION)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.decontaminate(docs.select("doc_id", "text"), items, columns=["doc_id"])
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def with_planted_run(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, by their id, the words from some place on become repetitions of the first few there."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen, g = crc % 10 == 0, F.floor(crc / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    n = F.size(words).cast("bigint")
    a = g % n
    p = F.floor((n - a) / (g % 8 + 3)) + 1
    repeated = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(repeated, F.lit(1), (n - a).cast("int"))), " ")
    return docs.withColumn("text", F.when(chosen & (n > 0), text).otherwise(F.col("text")))


@_query("op11_periodic_runs", sql.PERIODIC_RUNS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_run(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.collapse_runs(docs)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    digests = F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    strongest = [F.col(f"run_{c}").alias(c) for c in ("start", "length", "period")]
    return found.select("doc_id", "n_runs", *strongest, "exponent_milli", *digests)


@_query("op12_filter_audit", sql.FILTER_ORDERS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.learn(docs.where(remainder() != 2).select("doc_id", "text"), labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", _held_out(), "score", "predicted")
