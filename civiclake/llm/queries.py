"""The registered queries of the corpus operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civiclake.llm import annsearch, bpe, conversations, decontaminate, idfile, ngramjoin, phrases, quality, suffixdedup, tokencount, toxicity, urlfilter, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(*functions: Query, **oracles: str) -> None:
    QUERIES.update({f.__name__: f for f in functions})
    ORACLES.update(oracles)


_register(
    tokencount.op1_token_counts, suffixdedup.op2_suffix_dedup, urlfilter.op3_url_filter, decontaminate.op4_decontaminate, bpe.op5_bpe, ngramjoin.op6_ngram_join, warc.op7_warc, idfile.op8_token_file, annsearch.op9_nearest, quality.op10_quality,
    phrases.op11_phrases, toxicity.op12_toxicity, conversations.op13_conversation_repair,
    op3_url_filter=urlfilter.OP3_SQL, op11_phrases=phrases.OP11_SQL)
