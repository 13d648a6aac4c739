"""Registered queries of the operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfguard.llm import byte_bpe, decontaminate, html_text, line_dedup, manifest, near_dedup, pieces, prefix_trie, quality, token_shards, url_filters, vector_dedup, warc
from shelfguard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": lambda s, d: pieces.op1_sentencepiece(table(s, d, "documents")),
    "op2_line_dedup": lambda s, d: line_dedup.op2_line_dedup(table(s, d, "documents")),
    "op3_url_filters": lambda s, d: url_filters.op3_url_filters(table(s, d, "pages")),
    "op4_near_dedup": lambda s, d: near_dedup.op4_near_dedup(table(s, d, "documents")),
    "op5_quality": lambda s, d: quality.op5_quality(table(s, d, "documents"), table(s, d, "labels")),
    "op6_vector_dedup": lambda s, d: vector_dedup.op6_vector_dedup(table(s, d, "embeddings")),
    "op7_token_shards": lambda s, d: token_shards.op7_token_shards(table(s, d, "documents")),
    "op8_warc": lambda s, d: warc.op8_warc(table(s, d, "pages")),
    "op9_decontaminate": lambda s, d: decontaminate.op9_decontaminate(table(s, d, "documents"), table(s, d, "benchmark")),
    "op10_html_text": lambda s, d: html_text.op10_html_text(table(s, d, "pages")),
    "op11_byte_bpe": lambda s, d: byte_bpe.op11_byte_bpe(table(s, d, "documents")),
    "op12_merkle_manifest": lambda s, d: manifest.op12_merkle_manifest(table(s, d, "documents")),
    "op13_prefix_trie": lambda s, d: prefix_trie.op13_prefix_trie(table(s, d, "conversations")),
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op3_url_filters": url_filters.SQL,
    "op4_near_dedup": near_dedup.SQL,
    "op6_vector_dedup": vector_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op12_merkle_manifest": manifest.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
