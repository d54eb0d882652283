"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import audit, chat, counting, decontamination, interpolation, merkle, mixing, packing, quality, sharding, simhash, suffix_dedup, warc

QUERIES = {
    "op1_decontamination": decontamination.contamination_query,
    "op2_best_fit_packing": packing.packing_query,
    "op3_suffix_dedup": suffix_dedup.suffix_query,
    "op4_interpolated_scores": interpolation.scoring_query,
    "op5_chat_format": chat.chat_query,
    "op6_quality_rules": quality.quality_query,
    "op7_simhash_groups": simhash.simhash_query,
    "op8_token_counts": counting.token_query,
    "op9_warc_records": warc.warc_query,
    "op10_two_pass_shuffle": sharding.shard_query,
    "op11_water_filling": mixing.mix_query,
    "op12_merkle_manifest": merkle.manifest_query,
    "op13_filter_audit": audit.audit_query,
}
SQL = {
    "op1_decontamination": decontamination.CONTAMINATION_SQL,
    "op5_chat_format": chat.CHAT_SQL,
    "op9_warc_records": warc.WARC_SQL,
    "op12_merkle_manifest": merkle.MANIFEST_SQL,
    "op13_filter_audit": audit.AUDIT_SQL,
}
