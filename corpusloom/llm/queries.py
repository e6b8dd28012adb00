"""Queries of the llm operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import langid, leaks, mixing, packing, pairs, repetition, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": pairs.p1_found,
    "p2_estimates": tokens.p2_estimates,
    "p2_budget": tokens.p2_budget,
    "p3_mixture": mixing.p3_mixture,
    "p3_shares": mixing.p3_shares,
    "p4_found": langid.p4_found,
    "p4_segments": langid.p4_segments,
    "p5_found": repetition.p5_found,
    "p5_repetition": repetition.p5_repetition,
    "p6_sequences": packing.p6_sequences,
    "p6_fill": packing.p6_fill,
    "p7_found": leaks.p7_found,
    "p7_cleaned": leaks.p7_cleaned,
    "p8_found": toxicity.p8_found,
    "p8_rates": toxicity.p8_rates,
}

#: None of these can be said in SQL: their tests hold them against brute force, planted cases or an exact decode.
ORACLE: dict[str, str] = {}
