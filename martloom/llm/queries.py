"""Registered queries of this package and their SQL."""

from __future__ import annotations

from martloom.llm import (
    decontamination,
    jaccard_join,
    license_scan,
    merkle_manifest,
    packing,
    pii,
    quality_rules,
    secrets,
    spelling_variants,
    substring_dedup,
    suffix_array_dedup,
    url_filters,
    warc_audit,
)

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_secrets": secrets.op3_secrets,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_packing": packing.op5_packing,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_warc_audit": warc_audit.op7_warc_audit,
    "op8_suffix_array_dedup": suffix_array_dedup.op8_suffix_array_dedup,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_pii": pii.op10_pii,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}

ORACLE = {
    **url_filters.ORACLE,
    **substring_dedup.ORACLE,
    **quality_rules.ORACLE,
    **warc_audit.ORACLE,
    **decontamination.ORACLE,
    **merkle_manifest.ORACLE,
    **spelling_variants.ORACLE,
}
