"""Registered queries of this subpackage: name -> query, name -> SQL where SQL can express it."""

from __future__ import annotations

from limelight.llm import alignment, chat, collocations, common, decontamination, embeddings, exact, neardup, packing, pii, quality, secrets, substring, suffixes

_t = common.table

QUERIES = {
    "op1_minhash_neardup": lambda s, d: neardup.op1(_t(s, d, "documents")),
    "op2_pii_surrogates": lambda s, d: pii.op2(_t(s, d, "documents")),
    "op3_rlz_substring_dedup": lambda s, d: substring.op3(_t(s, d, "documents")),
    "op4_columnwise_suffix_dedup": lambda s, d: suffixes.op4(_t(s, d, "documents")),
    "op5_grammar_secrets": lambda s, d: secrets.op5(_t(s, d, "documents")),
    "op6_pigeonhole_embeddings": lambda s, d: embeddings.op6(_t(s, d, "embeddings")),
    "op7_factorization_quality": lambda s, d: quality.op7(_t(s, d, "documents"), _t(s, d, "labels")),
    "op8_event_sourced_chat": lambda s, d: chat.op8(s, _t(s, d, "conversations")),
    "op9_prefix_decontamination": lambda s, d: decontamination.op9(_t(s, d, "documents"), _t(s, d, "benchmark")),
    "op10_nnls_packing": lambda s, d: packing.op10(_t(s, d, "documents")),
    "op11_merge_path_alignment": lambda s, d: alignment.op11(_t(s, d, "documents")),
    "op12_golomb_exact_dedup": lambda s, d: exact.op12(_t(s, d, "documents")),
    "op13_toivonen_collocations": lambda s, d: collocations.op13(_t(s, d, "documents")),
}

SQL = {
    "op6_pigeonhole_embeddings": embeddings.SQL,
    "op8_event_sourced_chat": chat.SQL,
    "op9_prefix_decontamination": decontamination.SQL,
    "op12_golomb_exact_dedup": exact.SQL,
    "op13_toivonen_collocations": collocations.SQL,
}
