"""A training corpus from `documents`: toxicity, quality, near duplicates, benchmark passages, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortline.llm import common, decontaminate, jaccard, mixing, quality, toxicity
from cohortline.llm.queries import SEED, read, remainder

#: No SQL: classifiers are learned. The tests hold each stage against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    lexicon = toxicity.learn(docs, read(spark, sf_dir, "labels"), remainder(5) == 0)
    return toxicity.score(docs, lexicon, "__toxicity").where("__toxicity < 0.5").select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for quality."""
    machine = quality.learn(docs, read(spark, sf_dir, "labels"), remainder(4) == 2)
    return quality.score(docs, machine, "__quality").where("__quality >= 0.7").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies (shingles of 5 words, 80 %)."""
    return jaccard.without_copies(docs, k=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans they share with test items; documents that are mostly such spans go."""
    return decontaminate.remove_overlaps(docs, read(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document once per copy, with its size in words and the copy's number."""
    return mixing.mixed(docs, weights=(3, 1, 2), share=1.5, repeat=2.0, seed=SEED)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("jaccard_join", drop_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
