"""The queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tidegauge.llm import decontam, forest, ledger, licenses, manifest, part_codes, piecewise, quality, repeats, shingle_join, simhash, toxicity, warc

QUERIES = {
    "op1_adaptive_prefix_join": shingle_join.op1_adaptive_prefix_join,
    "op2_factorization_machine": toxicity.op2_factorization_machine,
    "op3_content_addressed_warc": warc.op3_content_addressed_warc,
    "op4_piece_sampling": piecewise.op4_piece_sampling,
    "op5_positional_index": decontam.op5_positional_index,
    "op6_blob_ledger": ledger.op6_blob_ledger,
    "op7_projection_forest": forest.op7_projection_forest,
    "op8_interval_expansion": repeats.op8_interval_expansion,
    "op9_positive_unlabelled": quality.op9_positive_unlabelled,
    "op10_license_templates": licenses.op10_license_templates,
    "op11_pigeonring_simhash": simhash.op11_pigeonring_simhash,
    "op12_trie_codes": part_codes.op12_trie_codes,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}

SQL: dict[str, str] = {
    "op1_adaptive_prefix_join": shingle_join.OP1_SQL,
    "op3_content_addressed_warc": warc.OP3_SQL,
    "op5_positional_index": decontam.OP5_SQL,
    "op8_interval_expansion": repeats.OP8_SQL,
    "op12_trie_codes": part_codes.OP12_SQL,
    "op13_merkle_manifest": manifest.OP13_SQL,
}
