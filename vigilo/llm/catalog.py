"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from vigilo.llm import (ego_join, hard_negatives, html_mincut, knn_quality, minhash, packing, pii_bootstrap, quality_rules,
                        secret_scan, sp_lattice, token_counts, vector_codes, warc)

QUERIES = {
    "op1_warc_salvage": warc.op1_warc_salvage,
    "op2_secret_linking": secret_scan.op2_secret_linking,
    "op3_bootstrapped_pii": pii_bootstrap.op3_bootstrapped_pii,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_minhash_near_dedup": minhash.op5_minhash_near_dedup,
    "op6_hierarchical_packing": packing.op6_hierarchical_packing,
    "op7_epsilon_grid_order": ego_join.op7_epsilon_grid_order,
    "op8_nearest_neighbour_quality": knn_quality.op8_nearest_neighbour_quality,
    "op9_minimum_cut_extraction": html_mincut.op9_minimum_cut_extraction,
    "op10_sentencepiece_lattice": sp_lattice.op10_sentencepiece_lattice,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_gnat_vector_codes": vector_codes.op13_gnat_vector_codes,
}

ORACLES = {
    "op1_warc_salvage": warc.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_minhash_near_dedup": minhash.ORACLE,
    "op7_epsilon_grid_order": ego_join.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_gnat_vector_codes": vector_codes.ORACLE,
}
