"""The operators applied to the given tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blobtally.llm import bayes_quality as bayes
from blobtally.llm import bestfit_packing as packing
from blobtally.llm import compact_windows as passages
from blobtally.llm import conversation_repair as repair
from blobtally.llm import label_sharding as sharding
from blobtally.llm import order_minhash as order
from blobtally.llm import pivot_index as pivots
from blobtally.llm import polar_whitening as polar
from blobtally.llm import quality_rules as rules
from blobtally.llm import simhash_vptree as simhash
from blobtally.llm import suffix_merge as suffixes
from blobtally.llm import temperature_mixing as mixing
from blobtally.llm import text_density as density


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pivot_permutation(spark, sf_dir):
    return pivots.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_distribution_divergence(spark, sf_dir):
    out = rules.quality_rules(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "class_distance", "word_distance", "coverage_distance")


def op10_vantage_point_trees(spark, sf_dir):
    out = simhash.simhash_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return out.select("doc_id", "fingerprint", "component_id")


def op3_compact_windows(spark, sf_dir):
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op4_conflict_best_fit(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_temperature_mixing(spark, sf_dir):
    return mixing.mixture(_table(spark, sf_dir, "documents"), carry=["doc_id", "source"])


def op6_text_density(spark, sf_dir):
    return density.extract(_table(spark, sf_dir, "pages"))


def op7_label_propagation(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op8_prefix_merge_sort(spark, sf_dir):
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_empirical_bayes(spark, sf_dir):
    return bayes.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_order_minhash(spark, sf_dir):
    return order.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op12_grammar_compressed_dp(spark, sf_dir):
    return repair.repair(_table(spark, sf_dir, "conversations"))


def op13_polarisation_covariance(spark, sf_dir):
    return polar.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_pivot_permutation": op1_pivot_permutation,
    "op2_distribution_divergence": op2_distribution_divergence,
    "op3_compact_windows": op3_compact_windows,
    "op4_conflict_best_fit": op4_conflict_best_fit,
    "op5_temperature_mixing": op5_temperature_mixing,
    "op6_text_density": op6_text_density,
    "op7_label_propagation": op7_label_propagation,
    "op8_prefix_merge_sort": op8_prefix_merge_sort,
    "op9_empirical_bayes": op9_empirical_bayes,
    "op10_vantage_point_trees": op10_vantage_point_trees,
    "op11_order_minhash": op11_order_minhash,
    "op12_grammar_compressed_dp": op12_grammar_compressed_dp,
    "op13_polarisation_covariance": op13_polarisation_covariance,
}
ORACLE_SQL: dict[str, str] = {}
