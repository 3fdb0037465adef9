"""The subpackage's queries and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: query name: module
MODULES = {
    "op5_suffix_array_dedup": "op5_suffix_array_dedup",
    "op1_ngram_jaccard_join": "op1_ngram_jaccard_join",
    "op10_html_extraction": "op10_html_extraction",
    "op6_nearest_neighbours": "op6_nearest_neighbours",
    "op3_quality_classifier": "op3_quality_classifier",
    "op7_toxicity": "op7_toxicity",
    "op2_token_counts": "op2_token_counts",
    "op4_source_mixing": "op4_source_mixing",
    "op8_warc_revisits": "op8_warc_revisits",
    "op9_benchmark_decontamination": "op9_benchmark_decontamination",
}


def load(name: str):
    """The module of a query."""
    return import_module(f"{__package__}.{MODULES[name]}")


def queries() -> dict:
    return {name: load(name).query for name in MODULES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name in MODULES if (sql := getattr(load(name), "ORACLE", None))}
