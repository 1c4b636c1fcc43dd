"""The corpus pipeline: from raw documents to packed training bins.

Each stage is a function of (spark, docs, sf_dir); what it returns is written and read again as
the next one's documents. Quality rules drop documents, SimHash keeps one of each group, passages
that earlier documents have go, sources are mixed to their weights, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blobtally.llm import bestfit_packing, compact_windows, quality_rules, simhash_vptree, temperature_mixing
from blobtally.llm.common import collect_tables, drop_tables, materialise

#: Intermediate tables of the stage that ran last, for each application.
_last: dict[str, list[str]] = {}


def _stage(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first removes the intermediate tables of the one before.

    By the time a stage is called its predecessor's result is written, so nothing reads them.
    """
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_tables(spark, _last.pop(app, []))
        with collect_tables() as tables:
            out = operator(docs)
        _last[app] = tables
        return out

    return stage


STAGES = [
    ("quality_rules", _stage(quality_rules.keep_good)),
    ("simhash_near_dedup", _stage(simhash_vptree.keep_one)),
    ("substring_dedup", _stage(compact_windows.drop_repeats)),
    ("source_mixing", _stage(temperature_mixing.mix)),
    ("best_fit_packing", _stage(bestfit_packing.pack)),
]

#: Hash functions, trees and bins have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
