"""Queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

from strainflow.llm import audit, bpe, decontaminate, lines, media, ngram_join, ppm, resampling, sharding, suffixes, tokenfile, toxicity, warc

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_best_fit_shards": sharding.op2_best_fit_shards,
    "op3_site_lines": lines.op3_site_lines,
    "op3_host_lines": lines.op3_host_lines,
    "op4_benchmark_windows": decontaminate.op4_benchmark_windows,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_toxic_lexicon": toxicity.op6_toxic_lexicon,
    "op7_arc_to_warc": warc.op7_arc_to_warc,
    "op8_media_sequences": media.op8_media_sequences,
    "op9_ngram_tree_join": ngram_join.op9_ngram_tree_join,
    "op10_token_frames": tokenfile.op10_token_frames,
    "op11_ppm_score": ppm.op11_ppm_score,
    "op12_crc_resampling": resampling.op12_crc_resampling,
    "op13_filter_audit": audit.op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_site_lines": lines.OP3_SQL,
    "op3_host_lines": lines.OP3_HOST_SQL,
    "op4_benchmark_windows": decontaminate.OP4_SQL,
    "op12_crc_resampling": resampling.OP12_SQL,
    "op13_filter_audit": audit.OP13_SQL,
}
