"""Driver queries of the operators, by name: a Spark function and, where SQL can say it, a DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import interpolation, language, licenses, pages, quality, toxicity
from tallyloom.llm.common import held_out_sql
from tallyloom.llm.decontamination import leaks, leaks_sql
from tallyloom.llm.divergence import audited, audited_sql
from tallyloom.llm.near_duplicates import near_duplicates, near_duplicates_sql
from tallyloom.llm.neighbours import neighbours
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.sharding import shard_documents, shard_sql
from tallyloom.llm.spelling import grouped, grouped_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Vocabulary file of op7 and of the pipeline's last stage.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_held_out(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return docs.withColumn("held_out", F.expr(held_out_sql("doc_id", modulus, remainder)))


def learnable(labels: DataFrame, column: str, modulus: int, remainder: int) -> DataFrame:
    """doc_id and label of the documents to learn from."""
    known = labels.select("doc_id", F.col(column).alias("label")).where("label is not null")
    return known.where(f"not {held_out_sql('doc_id', modulus, remainder)}")


def judged(scores: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return with_held_out(scores, modulus, remainder).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return shard_documents(docs, dict.fromkeys(range(16), 1.0), dict.fromkeys(range(17), 1.0))


ORACLES["op1_sharding"] = shard_sql(16)


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op2_decontamination"] = leaks_sql()


@query
def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents")).selectExpr(
        "doc_id",
        "n_words",
        "cast(size(places) as bigint) as n_base",
        "array_min(places) as first_word",
        "array_max(places) as last_word",
        "concat_ws(',', array_sort(array_distinct(place_labels))) as base_labels",
        "concat_ws(',', array_sort(array_distinct(concat(place_labels, labels)))) as labels",
        "greatest(coalesce(array_max(containments), 0d), if(size(places) > 0, 1d, 0d)) as score",
    )


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, learnable(table(spark, folder, "labels"), "toxic", 4, 2))
    return judged(toxicity.scored(docs, model), 4, 2)


@query
def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


ORACLES["op5_near_duplicates"] = near_duplicates_sql(80)


@query
def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extracted(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op7_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), tokenizer_path(), end_id=1, length=4096)


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, learnable(table(spark, folder, "labels"), "quality", 5, 0))
    return judged(quality.scored(docs, model), 5, 0)


@query
def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours(table(spark, folder, "embeddings"), "vec_id % 100 = 0", k=10)


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(f"not {held_out_sql('doc_id', 5, 0)}"))
    found = language.identified(docs, model)
    return with_held_out(found, 5, 0).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op11_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.scored(table(spark, folder, "documents"))


@query
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return grouped(table(spark, folder, "documents"))


ORACLES["op12_spelling"] = grouped_sql()


@query
def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audited(table(spark, folder, "documents"))


ORACLES["op13_divergence"] = audited_sql()
