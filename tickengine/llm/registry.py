"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tickengine.llm import (
    alignment,
    decontamination,
    licenses,
    nearduplicates,
    packing,
    passages,
    periodicruns,
    pii,
    quality,
    secretscan,
    suffixlevels,
    tokencount,
    topk,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_passages": passages.op1_passages,
        "op2_decontamination": decontamination.op2_decontamination,
        "op3_packing": packing.op3_packing,
        "op4_suffix_levels": suffixlevels.op4_suffix_levels,
        "op5_token_counts": tokencount.op5_token_counts,
        "op6_quality": quality.op6_quality,
        "op7_private": pii.op7_private,
        "op8_topk": topk.op8_topk,
        "op9_licenses": licenses.op9_licenses,
        "op10_near_duplicates": nearduplicates.op10_near_duplicates,
        "op11_secrets": secretscan.op11_secrets,
        "op12_periodic_runs": periodicruns.op12_periodic_runs,
        "op13_alignment": alignment.op13_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_passages": passages.OP1_SQL,
        "op2_decontamination": decontamination.OP2_SQL,
        "op4_suffix_levels": suffixlevels.OP4_SQL,
        "op8_topk": topk.OP8_SQL,
        "op9_licenses": licenses.OP9_SQL,
        "op10_near_duplicates": nearduplicates.OP10_SQL,
    }
