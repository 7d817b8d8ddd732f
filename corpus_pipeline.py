"""A training-corpus pipeline; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.llm import decontaminate, line_dedup, packing, shingle_join, toxicity
from quaymart.llm.queries import tokenizer_path
from quaymart.llm.workers import reach
from quaymart.operators.sizing import durable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labels does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document, or line, has; documents left without words go."""
    return line_dedup.without_repeated_lines(docs, line_dedup.repeated_lines(docs))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key that tells rows apart that share an id but not the text, or have none, and its name."""
    name = "_key"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return docs.withColumn(name, F.xxhash64("doc_id", "text")), name


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; one without an id only if no other has one.

    Texts without words stay; of rows that repeat both id and text one stays.
    """
    keyed, key = _keyed(docs)
    groups = durable(shingle_join.jaccard_groups(keyed.select(F.col(key).alias("doc_id"), "text"))).select(
        F.col("doc_id").alias(key), "component_id")
    members = groups.distinct().join(keyed.select(key, "doc_id").distinct(), key)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    kept = members.groupBy("component_id").agg(F.min_by(key, first).alias(key))
    copies = groups.select(key).distinct().join(kept, key, "left_anti")
    repeated = groups.groupBy(key).count().where("count > 1").select(key)
    left = keyed.join(copies, key, "left_anti")
    once = left.join(repeated, key, "left_semi").dropDuplicates([key])
    return left.join(repeated, key, "left_anti").unionByName(once).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    keyed, key = _keyed(docs)
    found = decontaminate.overlaps(
        keyed.select(F.col(key).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    dirty = found.select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(dirty, key, "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, placed in training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: A learned model, links and tokens are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written as Parquet and read again."""
    reach(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
