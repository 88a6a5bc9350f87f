"""The queries of this subpackage, and DuckDB SQL for those that SQL can express.

The others are held against brute force, the tokenizer libraries or held-out labels in tests/llm.
"""

from __future__ import annotations

from . import byte_bpe, kmeans_tree, language, line_dedup, ngram_join, packing, pivot_index, reply_trees, secrets, token_shards, toxicity, transaction_log, word_runs
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_token_orc": token_shards.op1_token_orc,
    "op2_embedding_neardup": pivot_index.op2_embedding_neardup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language_id": language.op4_language_id,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_packing": packing.op9_packing,
    "op10_nearest": kmeans_tree.op10_nearest,
    "op11_reply_trees": reply_trees.op11_reply_trees,
    "op12_word_runs": word_runs.op12_word_runs,
    "op13_transaction_log": transaction_log.op13_transaction_log,
}
