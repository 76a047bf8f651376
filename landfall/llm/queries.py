"""The operators' queries over their whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from landfall.llm import (bpe, conversations, decontaminate, jaccard, langid, lattice, linededup, mixing, secrets, suffix, topk, toxicity,
                          whitening)

QUERIES = {
    "op1_toxicity": toxicity.op1,
    "op2_secret_scan": secrets.op2,
    "op3_suffix_dedup": suffix.op3,
    "op4_decontamination": decontaminate.op4,
    "op5_source_mixing": mixing.op5,
    "op6_ngram_jaccard_join": jaccard.op6,
    "op7_language_id": langid.op7,
    "op8_line_dedup": linededup.op8,
    "op9_lattice_lm": lattice.op9,
    "op10_exact_top_k": topk.op10,
    "op11_byte_bpe": bpe.op11,
    "op12_conversation_repair": conversations.op12,
    "op13_embedding_whitening": whitening.op13,
}

ORACLE_SQL = {
    "op4_decontamination": decontaminate.ORACLE_OP4,
    "op6_ngram_jaccard_join": jaccard.ORACLE_OP6,
    "op8_line_dedup": linededup.ORACLE_OP8,
    "op10_exact_top_k": topk.ORACLE_OP10,
}
