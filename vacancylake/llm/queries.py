"""All queries of the subpackage, with SQL where another engine can state the rows."""

from __future__ import annotations

from importlib import import_module

from vacancylake.plans.queries import Registered

MODULES = [
    "quality_rules",
    "decontamination",
    "token_files",
    "packing",
    "language_model",
    "line_dedup",
    "personal_data",
    "simhash",
    "suffix_dedup",
    "toxicity",
    "byte_bpe",
    "word_runs",
    "vector_codes",
]


def registered() -> Registered:
    out: Registered = {}
    for name in MODULES:
        out |= import_module(f"vacancylake.llm.{name}").QUERIES
    return out
