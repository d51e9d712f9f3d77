"""From raw documents to packed training sequences: quality, language, near copies, benchmark passages, packing.

Stages with Python steps lower the session's limits of an Arrow batch (``common.small_batches``); results do not depend on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import language, quality
from tallyloom.llm.common import free_names, held_out_sql, small_batches, written
from tallyloom.llm.decontamination import leaks
from tallyloom.llm.near_duplicates import near_duplicates
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.queries import learnable, table, tokenizer_path

#: Documents below this quality score are rejected.
QUALITY = 0.3
#: Words that a tokenizing task remembers; fewer than packing alone may, as workers keep what earlier stages loaded.
REMEMBERED = 100_000


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; a null text is judged like an empty one, a null id like others."""
    small_batches(spark)
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels"), "quality", 5, 0))
    score = free_names(docs.columns, ["score"])["score"]
    return quality.scored(docs, model, docs.columns).where(F.col(score) >= QUALITY).select(*docs.columns)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null texts and those without a letter go."""
    small_batches(spark)
    model = language.fit(docs.where(f"not {held_out_sql('doc_id', 5, 0)}"))
    rejected = free_names(docs.columns, ["lang_pred", "score", "rejected"])["rejected"]
    return language.identified(docs, model, docs.columns).where(~F.col(rejected)).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents that share 0.8 of their five-word shingles, in one row; null ids stay."""
    small_batches(spark)
    groups = written(near_duplicates(docs, width=5, percent=80).where("doc_id is not null"))
    repeated = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1")
    gone = groups.where("not kept").select("doc_id").union(repeated.select("doc_id")).distinct()
    once = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = repeated.where("kept").select("doc_id")
    if again.isEmpty():
        return once
    return once.union(docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item; null ids stay."""
    found = leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 4096 tokens."""
    small_batches(spark)
    return pack_documents(docs, tokenizer_path(), end_id=1, length=4096, remembered=REMEMBERED, keep=False)


STAGES = [
    ("quality", by_quality),
    ("language", by_language),
    ("near copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("packing", into_sequences),
]
#: SQL expresses neither the classifiers nor the tokenizer; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's result is written and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
