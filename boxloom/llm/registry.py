"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from boxloom.llm import (
    op01_byte_bpe,
    op02_phrases,
    op03_suffixes,
    op04_html,
    op05_lines,
    op06_chat,
    op07_simhash,
    op08_quality,
    op09_benchmark,
    op10_hnsw,
    op11_spelling,
    op12_negatives,
    op13_exact,
)

QUERIES = {
    "op1_byte_bpe": op01_byte_bpe.query,
    "op2_phrase_dedup": op02_phrases.query,
    "op3_suffix_dedup": op03_suffixes.query,
    "op4_html": op04_html.query,
    "op5_line_dedup": op05_lines.query,
    "op6_chat": op06_chat.query,
    "op7_simhash": op07_simhash.query,
    "op8_quality": op08_quality.query,
    "op9_benchmark": op09_benchmark.query,
    "op10_hnsw": op10_hnsw.query,
    "op11_spelling": op11_spelling.query,
    "op12_negatives": op12_negatives.query,
    "op13_exact": op13_exact.query,
}

ORACLES: dict[str, str] = {
    "op2_phrase_dedup": op02_phrases.SQL,
    "op5_line_dedup": op05_lines.SQL,
    "op6_chat": op06_chat.SQL,
    "op12_negatives": op12_negatives.SQL,
    "op13_exact": op13_exact.SQL,
}
