"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from panelkit.llm import align, chat, collocations, dedup, encode, jaccard, mixing, outliers, quality_model, setsketch, suffix_tree, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_sentencepiece": encode.op2_sentencepiece,
    "op3_suffix_tree": suffix_tree.op3_suffix_tree,
    "op4_chat": chat.op4_chat,
    "op5_quality": quality_model.op5_quality,
    "op6_jaccard": jaccard.op6_jaccard,
    "op7_outliers": outliers.op7_outliers,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_dedup": dedup.op9_dedup,
    "op10_token_counts": encode.op10_token_counts,
    "op11_collocations": collocations.op11_collocations,
    "op12_alignment": align.op12_alignment,
    "op13_setsketch": setsketch.op13_setsketch,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op4_chat": chat.OP4_SQL,
    "op9_dedup": dedup.OP9_SQL,
    "op11_collocations": collocations.OP11_SQL,
}
