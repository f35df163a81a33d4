"""The registered queries of the text operators, on the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import centroids, collocations, decontamination, language_id, licenses, lm_scoring, near_dedup, packing, quality_rules, repeats, sharding, token_counts, toxicity
from strata.llm.common import table

#: Placement of op3: 64 shards.
SHARDS = [f"shard-{i:02d}" for i in range(64)]


def vocabulary_file(name: str) -> str:
    """A public tokenizer file (read on the driver and, from the same place, on the executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.word_pseudo_likelihood(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", SHARDS)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", F.lit(""), "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    return licenses.licence_scan(docs, "path")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_pseudo_likelihood, op2_repeats, op3_sharding, op4_licenses, op5_token_counts, op6_quality_rules,
                                   op7_decontamination, op8_near_dedup, op9_packing, op10_toxicity,
                                   op11_language_id, op12_collocations, op13_centroids)}
SQL = {"op4_licenses": licenses.licence_sql(),
       "op3_sharding": sharding.placement_sql("doc_id", "documents", SHARDS, columns="doc_id, source, n_chars"),
       "op12_collocations": collocations.collocation_sql(), "op13_centroids": centroids.centroid_sql()}
