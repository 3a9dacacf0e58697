"""Queries of the operators, by name."""

from __future__ import annotations

from importlib import import_module

from shelfwise.llm.registry import ORACLES, QUERIES

_MODULES = (
    "mixing", "secrets", "url_filter", "toxicity", "near_dup", "decontaminate", "embed_dup", "token_output", "html_extract", "license_scan",
    "vector_clusters", "conversations", "warc",
)

for _module in _MODULES:
    import_module(f"shelfwise.llm.{_module}")


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
