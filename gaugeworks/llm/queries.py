"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import (
    collocations,
    decontaminate,
    hard_negatives,
    language,
    licenses,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    suffix_tree,
    token_files,
)
from gaugeworks.llm.columns import share_code


def _shared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_code(spark)
        return query(spark, sf_dir)

    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = {
        "op1_suffix_tree": suffix_tree.op1_suffix_tree,
        "op2_licenses": licenses.op2_licenses,
        "op3_near_dedup": near_dedup.op3_near_dedup,
        "op4_pack": packing.op4_pack,
        "op5_language": language.op5_language,
        "op6_quality_model": quality_model.op6_quality_model,
        "op7_secrets": secrets.op7_secrets,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_quality_rules": quality_rules.op9_quality_rules,
        "op10_token_files": token_files.op10_token_files,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_sharding": sharding.op12_sharding,
        "op13_collocations": collocations.op13_collocations,
    }
    return {name: _shared(query) for name, query in queries.items()}


def llm_oracles() -> dict[str, str]:
    return {
        "op8_decontaminate": decontaminate.OP8_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op13_collocations": collocations.OP13_SQL,
    }
