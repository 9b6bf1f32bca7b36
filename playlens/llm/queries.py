"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from playlens.llm import (
    op1_token_counts,
    op2_sharding,
    op3_toxicity,
    op4_byte_bpe,
    op5_suffix_dedup,
    op6_substring_dedup,
    op7_transcripts,
    op8_simhash,
    op9_quality_rules,
    op10_decontamination,
    op11_importance,
    op12_url_filter,
    op13_token_alignment,
)

QUERIES = {
    "op1_token_counts": op1_token_counts.query,
    "op2_sharding": op2_sharding.query,
    "op3_toxicity": op3_toxicity.query,
    "op4_byte_bpe": op4_byte_bpe.query,
    "op5_suffix_dedup": op5_suffix_dedup.query,
    "op6_substring_dedup": op6_substring_dedup.query,
    "op7_transcripts": op7_transcripts.query,
    "op8_simhash": op8_simhash.query,
    "op9_quality_rules": op9_quality_rules.query,
    "op10_decontamination": op10_decontamination.query,
    "op11_importance": op11_importance.query,
    "op12_url_filter": op12_url_filter.query,
    "op13_token_alignment": op13_token_alignment.query,
}

ORACLES = {
    "op10_decontamination": op10_decontamination.SQL,
    "op12_url_filter": op12_url_filter.SQL,
    "op5_suffix_dedup": op5_suffix_dedup.SQL,
    "op6_substring_dedup": op6_substring_dedup.SQL,
    "op9_quality_rules": op9_quality_rules.SQL,
}
