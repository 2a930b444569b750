"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import alignment, ann, binary_ids, bpe, chat, fingerprints, line_dedup, mixing, packing, simhash, superkmer, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.query,
    "op2_fingerprints": fingerprints.query,
    "op3_binary_ids": binary_ids.query,
    "op4_mixing": mixing.query,
    "op5_toxicity": toxicity.query,
    "op6_bpe": bpe.query,
    "op7_substring_dedup": superkmer.query,
    "op8_line_dedup": line_dedup.query,
    "op9_chat": chat.query,
    "op10_neighbours": ann.query,
    "op11_alignment": alignment.query,
    "op12_packing": packing.query,
    "op13_whitening": whitening.query,
}

ORACLE_SQL: dict[str, str] = {
    "op4_mixing": mixing.OP4_SQL,
    "op7_substring_dedup": superkmer.OP7_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_chat": chat.OP9_SQL,
}
