"""The registered queries of this subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from marketlens.llm import (byte_bpe, language_id, license_scan, lm_scoring, minhash, packing, pii, pq_dedup, run_detection, segment_search,
                            token_alignment, token_files, warc_audit)

QUERIES = {
    "op1_segment_search": segment_search.op1_segment_search,
    "op2_language_id": language_id.op2_language_id,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_minhash_dedup": minhash.op4_minhash_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_pii_pseudonyms": pii.op6_pii_pseudonyms,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_warc_audit": warc_audit.op8_warc_audit,
    "op9_pq_dedup": pq_dedup.op9_pq_dedup,
    "op10_packing": packing.op10_packing,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_run_detection": run_detection.op12_run_detection,
    "op13_license_scan": license_scan.op13_license_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op1_segment_search": segment_search.OP1_SQL,
    "op8_warc_audit": warc_audit.OP8_SQL,
}
