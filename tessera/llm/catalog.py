"""The subpackage's registered queries and their SQL, by name."""

from __future__ import annotations

from . import decontamination, exact_dedup, html_extract, mixing, ngram_join, pii, secrets, sharding, toxicity, url_filter

QUERIES = {
    "op1_minimax_shards": sharding.op1_minimax_shards,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_temperature_mixing": mixing.op3_temperature_mixing,
    "op4_weak_supervision_pii": pii.op4_weak_supervision_pii,
    "op5_signature_tree_join": ngram_join.op5_signature_tree_join,
    "op6_latent_decontamination": decontamination.op6_latent_decontamination,
    "op7_character_ratio_urls": url_filter.op7_character_ratio_urls,
    "op8_boosted_dom_extraction": html_extract.op8_boosted_dom_extraction,
    "op9_guess_cost_secrets": secrets.op9_guess_cost_secrets,
    "op10_multiple_instance_toxicity": toxicity.op10_multiple_instance_toxicity,
}
ORACLE_SQL = {"op2_exact_dedup": exact_dedup.OP2_SQL, "op5_signature_tree_join": ngram_join.OP5_SQL}
