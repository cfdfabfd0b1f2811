"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, langid, lattice, licences, minhash, mixing, substrings, tokens, toxicity

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_suffix_array_dedup": substrings.query,
    "op3_minhash_near_duplicates": minhash.query,
    "op4_toxicity": toxicity.query,
    "op5_language_id": langid.query,
    "op6_licence_scan": licences.query,
    "op7_benchmark_decontamination": decontaminate.query,
    "op8_token_counts": tokens.query,
    "op9_lattice_embedding_duplicates": lattice.query,
    "op10_source_mixing": mixing.query,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": chat.SQL,
    "op3_minhash_near_duplicates": minhash.SQL,
    "op6_licence_scan": licences.SQL,
    "op9_lattice_embedding_duplicates": lattice.SQL,
}
