"""The queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import (
    clustering, decontaminate, exact_dedup, language, license_scan, ngram_jaccard, poisson_mix, quality, suffix_dedup, suffix_tree, toxicity, url_filter,
    whitening,
)
from ticketloom.llm.common import read


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings in three grades: 0 poor, 1 good but toxic, 2 good and not toxic."""
    labels = read(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op1_quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, graded(spark, sf_dir), F.col("grade"))
    return quality.grade(docs, model, select_from=1, select_at=0.5)


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.trim(read(spark, sf_dir, "documents")).drop("spans")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return poisson_mix.replicate(docs, power=0.5, size=1.0, seed=17)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(read(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), components=32)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(read(spark, sf_dir, "embeddings"), k=16, rounds=3, size=64, seed=1)


#: The rules of the URL filter: verdict, host, start of the path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), url_filter.rules_of(spark, URL_RULES))


QUERIES = {f.__name__: f for f in (
    op1_quality_grade, op2_suffix_tree_lm, op3_exact_dedup, op4_suffix_dedup, op5_license_scan, op6_poisson_mix, op7_toxicity,
    op8_decontaminate, op9_ngram_jaccard, op10_language_id, op11_embedding_whitening, op12_centroid_clustering, op13_url_filter)}
