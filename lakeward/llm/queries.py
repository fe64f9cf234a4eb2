"""Registered queries of this package and their SQL."""

from __future__ import annotations

from . import (exact_dedup, fingerprints, licences, lm_score, merkle, mixing, packing, personal_data, quality, repeats,
               simhash, url_filter, vector_codes)

QUERIES = {f.__name__: f for f in (
    simhash.op1_simhash, licences.op2_licence_scan, personal_data.op3_personal_data, repeats.op4_suffix_array_dedup,
    quality.op5_quality_rules, url_filter.op6_url_filter, mixing.op7_source_mixing, packing.op8_best_fit_packing,
    lm_score.op9_lm_scores, exact_dedup.op10_exact_dedup, merkle.op11_merkle_manifest,
    fingerprints.op12_fingerprints, vector_codes.op13_vector_codes)}

ORACLE = {"op3_personal_data": personal_data.SQL, "op5_quality_rules": quality.SQL, "op7_source_mixing": mixing.SQL, "op10_exact_dedup": exact_dedup.SQL,
          "op11_merkle_manifest": merkle.SQL, "op13_vector_codes": vector_codes.SQL}
