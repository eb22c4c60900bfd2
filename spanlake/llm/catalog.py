"""The queries of the text operators, with the SQL each is compared with."""

from __future__ import annotations

import corpus_pipeline
from spanlake.llm import bpe, conversations, decontam, fim, htmltext, langid, linededup, mixing, neardup, pii, quality, sharding, substring

QUERIES = {
    "op1_bilstm_crf_pii": pii.op1_bilstm_crf_pii,
    "op2_prefix_decontamination": decontam.op2_prefix_decontamination,
    "op3_hd_language_id": langid.op3_hd_language_id,
    "op4_rendezvous_shards": sharding.op4_rendezvous_shards,
    "op6_site_line_dedup": linededup.op6_site_line_dedup,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_wrapper_induction": htmltext.op8_wrapper_induction,
    "op5_fm_index_substring_dedup": substring.op5_fm_index_substring_dedup,
    "op9_fast_similarity_near_dedup": neardup.op9_fast_similarity_near_dedup,
    "op10_risk_controlled_rules": quality.op10_risk_controlled_rules,
    "op11_viterbi_repair": conversations.op11_viterbi_repair,
    "op12_streaming_fill_in_middle": fim.op12_streaming_fill_in_middle,
    "op13_entropy_balancing": mixing.op13_entropy_balancing,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op4_rendezvous_shards": sharding.ORACLE,
    "op6_site_line_dedup": linededup.ORACLE,
    "op11_viterbi_repair": conversations.ORACLE,
    "op12_streaming_fill_in_middle": fim.ORACLE,
}
