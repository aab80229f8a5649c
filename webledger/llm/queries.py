"""Registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webledger.llm import bpe, decontaminate, html, language, lexical, licenses, lines, naming, packing, secrets, simhash, topk, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lines.op1,
    "op2_html_extraction": html.op2,
    "op3_secret_scan": secrets.op3,
    "op4_license_scan": licenses.op4,
    "op5_simhash_near_dedup": simhash.op5,
    "op6_language_id": language.op6,
    "op7_packing": packing.op7,
    "op8_exact_dedup": naming.op8,
    "op9_byte_bpe": bpe.op9,
    "op10_top_k": topk.op10,
    "op11_decontamination": decontaminate.op11,
    "op12_lexical_search": lexical.op12,
    "op13_whitening": whitening.op13,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": lines.OP1_SQL,
    "op8_exact_dedup": naming.OP8_SQL,
    "op10_top_k": topk.OP10_SQL,
    "op11_decontamination": decontaminate.OP11_SQL,
    "op12_lexical_search": lexical.OP12_SQL,
}
