"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from dimlathe.llm import (
    byte_bpe, centroid_clusters, fingerprints, html_extract, license_scan, mixing, ngram_join, pii, quality_rules, sharding,
    spelling_variants, toxicity, warc,
)


def queries():
    return {
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_ngram_join": ngram_join.op2_ngram_join,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_pii": pii.op4_pii,
        "op5_html_extract": html_extract.op5_html_extract,
        "op6_mixing": mixing.op6_mixing,
        "op7_byte_bpe": byte_bpe.op7_byte_bpe,
        "op8_fingerprints": fingerprints.op8_fingerprints,
        "op9_warc": warc.op9_warc,
        "op10_sharding": sharding.op10_sharding,
        "op11_centroid_clusters": centroid_clusters.op11_centroid_clusters,
        "op12_spelling_variants": spelling_variants.op12_spelling_variants,
        "op13_toxicity": toxicity.op13_toxicity,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.OP1_SQL,
        "op3_quality_rules": quality_rules.OP3_SQL,
        "op11_centroid_clusters": centroid_clusters.OP11_SQL,
    }
