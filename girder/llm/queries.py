"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from . import conversations, decontaminate, licenses, line_dedup, merkle, mixing, near_dup, quality, repeats, secrets, simhash, toxicity, url_filter

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_poisson_mixing": mixing.op3_poisson_mixing,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_suffix_array_dedup": repeats.op6_suffix_array_dedup,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_minhash_near_dedup": near_dup.op8_minhash_near_dedup,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_simhash_near_dedup": simhash.op11_simhash_near_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op3_poisson_mixing": mixing.ORACLE_SQL,
    "op4_quality_rules": quality.ORACLE_SQL,
    "op7_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op8_minhash_near_dedup": near_dup.ORACLE_SQL,
    "op12_merkle_manifest": merkle.ORACLE_SQL,
    "op13_conversation_repair": conversations.ORACLE_SQL,
}
