"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

import importlib.util

from . import ctw, curriculum, decontamination, divergence, jaccard_join, license_scan, packing, quality_crf, quality_rules, resampling, suffix_dedup, toxicity, url_filter


def queries() -> dict:
    pipeline = {}
    if importlib.util.find_spec("corpus_pipeline"):  # a file of its own at the top, which may be absent
        import corpus_pipeline

        pipeline = {"pipeline": corpus_pipeline.run}
    return pipeline | {
        "op1_packing": packing.op1_packing,
        "op2_ctw": ctw.op2_ctw,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_decontamination": decontamination.op5_decontamination,
        "op6_jaccard_join": jaccard_join.op6_jaccard_join,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_quality_crf": quality_crf.op9_quality_crf,
        "op10_license_scan": license_scan.op10_license_scan,
        "op11_divergence": divergence.op11_divergence,
        "op12_mixing": curriculum.op12_mixing,
        "op13_resampling": resampling.op13_resampling,
    }


def oracle_sql() -> dict:
    return {
        "op3_quality_rules": quality_rules.OP3_SQL,
        "op5_decontamination": decontamination.OP5_SQL,
        "op10_license_scan": license_scan.OP10_SQL,
        "op11_divergence": divergence.OP11_SQL,
        "op12_mixing": curriculum.OP12_SQL,
    }
