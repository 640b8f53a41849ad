"""The registered queries of this subpackage and the SQL texts of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import backoff, bpe, hard_negatives, html_text, language, lines, maxscore, minhash, repeats, tiling, toxicity, vector_codes, word_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_maxscore_top_k": maxscore.op2_maxscore_top_k,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_suffix_repeats": repeats.op4_suffix_repeats,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_minhash_near_dedup": minhash.op6_minhash_near_dedup,
    "op7_greedy_tiling": tiling.op7_greedy_tiling,
    "op8_language_id": language.op8_language_id,
    "op9_stupid_backoff": backoff.op9_stupid_backoff,
    "op10_html_text": html_text.op10_html_text,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_orchard_codes": vector_codes.op12_orchard_codes,
    "op13_batched_bpe": word_bpe.op13_batched_bpe,
}
SQL: dict[str, str] = {
    "op2_maxscore_top_k": maxscore.SQL,
    "op9_stupid_backoff": backoff.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_orchard_codes": vector_codes.SQL,
}
