"""Registered queries of the operators, and the SQL that DuckDB can run for the same rows."""

from __future__ import annotations

from fareline.llm import (
    conversation_trie, embedding_dedup, exact_dedup, jaccard_join, lexical_search, mixing, quality,
    sentence_pieces, substring_dedup, suffix_tree, token_files, url_filter, warc,
)

QUERIES = {
    "op1_token_files": token_files.op1_token_files,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_warc": warc.op3_warc,
    "op4_suffix_tree": suffix_tree.op4_suffix_tree,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_quality": quality.op6_quality,
    "op7_mixing": mixing.op7_mixing,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_sentence_pieces": sentence_pieces.op9_sentence_pieces,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_url_filter": url_filter.op13_url_filter,
}

ORACLE_SQL = {
    "op3_warc": warc.OP3_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_lexical_search": lexical_search.OP11_SQL,
    "op12_conversation_trie": conversation_trie.OP12_SQL,
    "op13_url_filter": url_filter.OP13_SQL,
}
