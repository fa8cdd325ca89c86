"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from flagstar.llm import op10_chat, op11_divergence, op12_fim
from flagstar.llm.op01_secrets import op1_secrets
from flagstar.llm.op02_neardup import op2_near_duplicates
from flagstar.llm.op03_mixing import op3_mix_sources
from flagstar.llm.op04_packing import op4_best_fit_packing
from flagstar.llm.op05_tokens import op5_token_files
from flagstar.llm.op06_toxicity import op6_toxicity
from flagstar.llm.op07_pii import op7_pii
from flagstar.llm.op08_nndescent import op8_nn_descent
from flagstar.llm.op09_imatch import op9_imatch
from flagstar.llm.op10_chat import op10_chat_format
from flagstar.llm.op11_divergence import op11_source_divergence
from flagstar.llm.op12_fim import op12_fill_in_middle
from flagstar.llm.op13_bpe import op13_bpe_round_trip

QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_near_duplicates,
        op3_mix_sources,
        op4_best_fit_packing,
        op5_token_files,
        op6_toxicity,
        op7_pii,
        op8_nn_descent,
        op9_imatch,
        op10_chat_format,
        op11_source_divergence,
        op12_fill_in_middle,
        op13_bpe_round_trip,
    )
}

SQL = {
    "op10_chat_format": op10_chat.ORACLE,
    "op11_source_divergence": op11_divergence.ORACLE,
    "op12_fill_in_middle": op12_fim.ORACLE,
}
