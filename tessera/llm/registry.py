"""The queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (decontam, mixing, neardup, packing, pathratio, quality, runs, sharding, substrings, topk, turns, urlfilter,
                         warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": decontam.op1,
    "op2_warc_index": warc.op2,
    "op3_mix_sources": mixing.op3,
    "op4_cover_tree_topk": topk.op4,
    "op5_pack_tokens": packing.op5,
    "op6_quality": quality.op6,
    "op7_repeated_spans": substrings.op7,
    "op8_filter_urls": urlfilter.op8,
    "op9_jaccard_classes": neardup.op9,
    "op10_minimax_shards": sharding.op10,
    "op11_repair_conversations": turns.op11,
    "op12_extract_text": pathratio.op12,
    "op13_periodic_runs": runs.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc_index": warc.SQL,
    "op3_mix_sources": mixing.SQL,
    "op8_filter_urls": urlfilter.SQL,
    "op10_minimax_shards": sharding.SQL,
    "op4_cover_tree_topk": topk.SQL,
    "op11_repair_conversations": turns.SQL,
    "op12_extract_text": pathratio.SQL,
}
