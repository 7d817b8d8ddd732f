"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import (
    centroids, conversation_trie, decontaminate, hilbert_search, line_dedup, packing, prefix_bpe, secrets, shingle_join,
    token_counts, toxicity, url_rules, warc)
from .workers import reach

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, where it is installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tagged = toxicity.tag(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return tagged.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_words", F.array_join(spans, ",").alias("spans"))


def op2_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search.search(_table(spark, sf_dir, "embeddings"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(order: int):
        return F.size(F.filter("base", lambda s: s["kind"] == order)).cast("bigint")

    every = F.array_sort(F.concat("base", "added"))

    def judged(as_: str):
        return F.size(F.filter(every, lambda s: s["judged"] == as_)).cast("bigint").alias(f"n_{as_}")

    def most(what: str):
        return F.coalesce(F.array_max(F.transform(every, lambda s: s[what])), F.lit(0).cast("bigint")).alias(f"most_{what}")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(secrets.BASE)],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(every).alias("spans"),
        judged("example"), judged("reused"), judged("live"), most("owners"), most("repositories"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.line_report(docs, line_dedup.repeated_lines(docs)).select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "position")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_groups(_table(spark, sf_dir, "documents"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.digests(
        _table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_hilbert_search, op3_secrets, op4_line_dedup, op5_token_counts, op6_url_filter, op7_warc,
        op8_packing, op9_decontamination, op10_jaccard_join, op11_prefix_bpe, op12_conversation_trie, op13_centroids)}


#: SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {"op6_url_filter": url_rules.ORACLE}
