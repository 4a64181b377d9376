"""Queries over token ids: the packed id matrix, order-preserving windows and bin completion."""

from __future__ import annotations

from reportlake.llm import bin_completion, token_matrix, tokens, window_packing
from reportlake.llm.registry import query, table


@query("op5_token_matrix")
def op5_token_matrix(spark, sf_dir):
    return token_matrix.pack(table(spark, sf_dir, "documents"), tokens.public_file())


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return window_packing.pack(table(spark, sf_dir, "documents"), tokens.public_file())


@query("op11_bin_completion")
def op11_bin_completion(spark, sf_dir):
    return bin_completion.pack(table(spark, sf_dir, "documents"), tokens.public_file())
