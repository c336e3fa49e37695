"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pitchlake.llm import (decontaminate, exact_dedup, fill_in_middle, filter_audit, html_extract, interpolation,
                           language_id, license_scan, line_dedup, mixing, ngram_join, quality, url_filter)

QUERIES = {
    "op1_html_extract": html_extract.op1_html_extract,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_language_id": language_id.op5_language_id,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_lm_score": interpolation.op11_lm_score,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

SQL = {
    "op2_ngram_join": ngram_join.OP2_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op10_decontaminate": decontaminate.OP10_SQL,
    "op12_fill_in_middle": fill_in_middle.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
