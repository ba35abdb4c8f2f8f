"""Registered queries of the corpus operators, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    alignment, chat, decontaminate, embeddings, fixity, jaccard, licenses, lm, mixing, quality, search, token_counts, toxicity)

SEED = 17


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"), k=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), 0.9)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")), 512)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents"), (3, 1, 2), 1.5, 2.0, SEED)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    turns = rows.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.conversation_digests(chat.format_turns(turns))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(5) == 0
    lexicon = toxicity.learn(docs, read(spark, sf_dir, "labels"), held_out)
    return toxicity.score(docs, lexicon, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = remainder(4) == 2
    machine = quality.learn(docs, read(spark, sf_dir, "labels"), held_out)
    return quality.score(docs, machine, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of all pages against a replica in which the last character of some pages is another."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    struck = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2) < "04"
    other = F.when(F.col("html").endswith("#"), F.lit("*")).otherwise(F.lit("#"))
    replica = pages.withColumn("html", F.when(struck, F.concat(F.expr("substr(html, 1, length(html) - 1)"), other))
                               .otherwise(F.col("html")))
    return fixity.audit(fixity.records(pages), fixity.records(replica))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", (remainder(7) == 2).alias("held_out"), "text")
    model, counts = lm.learn(docs.where(~F.coalesce("held_out", F.lit(False))).select("text"))
    return lm.score(docs, model, counts)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.summary(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 10).drop("longest")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.labelled(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=10)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.digests(alignment.aligned(
        read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")),
        str(public_tokenizers.path("piece_bpe_32k.model"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_jaccard_join, op2_embedding_dedup, op3_token_counts, op4_mixing, op5_chat_format, op6_toxicity, op7_quality,
        op8_fixity_audit, op9_lm_scores, op10_decontaminate, op11_license_scan, op12_ranked_search, op13_token_alignment)
}
