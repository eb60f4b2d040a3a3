"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from depthbook.llm import (
    lsh_forest,
    packing,
    piece_spans,
    quality_ledger,
    reply_trees,
    secret_scan,
    spectrum_whitening,
    stream_dedup,
    token_groups,
    toxicity_chain,
    unit_dedup,
    url_filter,
    word_bpe,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_secret_scan": secret_scan.op2_secret_scan,
        "op3_quality_ledger": quality_ledger.op3_quality_ledger,
        "op4_word_bpe": word_bpe.op4_word_bpe,
        "op5_lsh_forest": lsh_forest.op5_lsh_forest,
        "op6_reply_trees": reply_trees.op6_reply_trees,
        "op7_stream_dedup": stream_dedup.op7_stream_dedup,
        "op8_unit_dedup": unit_dedup.op8_unit_dedup,
        "op9_toxicity_chain": toxicity_chain.op9_toxicity_chain,
        "op10_packing": packing.op10_packing,
        "op11_spectrum_whitening": spectrum_whitening.op11_spectrum_whitening,
        "op12_token_groups": token_groups.op12_token_groups,
        "op13_piece_spans": piece_spans.op13_piece_spans,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter.ORACLE_OP1,
        "op2_secret_scan": secret_scan.ORACLE_OP2,
        "op3_quality_ledger": quality_ledger.ORACLE_OP3,
        "op5_lsh_forest": lsh_forest.ORACLE_OP5,
        "op6_reply_trees": reply_trees.ORACLE_OP6,
        "op7_stream_dedup": stream_dedup.ORACLE_OP7,
    }
