"""The queries opN_<name> over the tables of a data folder, and their SQL."""

from __future__ import annotations

from lexmill.llm import alignment, embedding_join, fingerprints, html_main, license_scan, line_dedup, mixing, ngram_join, packing, prefix_trie, quality, tokens, url_filter
from lexmill.session import table

QUERIES = {
    "op1_embedding_join": lambda spark, d: embedding_join.op1(table(spark, d, "embeddings")),
    "op2_ngram_join": lambda spark, d: ngram_join.op2(table(spark, d, "documents")),
    "op3_line_dedup": lambda spark, d: line_dedup.op3(table(spark, d, "documents")),
    "op4_token_counts": lambda spark, d: tokens.op4(table(spark, d, "documents")),
    "op5_winnowing": lambda spark, d: fingerprints.op5(table(spark, d, "documents")),
    "op6_license_scan": lambda spark, d: license_scan.op6(table(spark, d, "documents")),
    "op7_source_mixing": lambda spark, d: mixing.op7(table(spark, d, "documents")),
    "op8_best_fit_packing": lambda spark, d: packing.op8(table(spark, d, "documents")),
    "op9_quality_network": lambda spark, d: quality.op9(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_url_filter": lambda spark, d: url_filter.op10(table(spark, d, "pages"), table(spark, d, "labels")),
    "op11_cross_alignment": lambda spark, d: alignment.op11(table(spark, d, "documents")),
    "op12_html_extraction": lambda spark, d: html_main.op12(table(spark, d, "pages")),
    "op13_prefix_trie": lambda spark, d: prefix_trie.op13(table(spark, d, "conversations")),
}
ORACLES = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op7_source_mixing": mixing.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
