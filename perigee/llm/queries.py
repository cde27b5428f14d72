"""The registered queries of the operators; each derives the columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("mixing", "simhash", "quality", "packing", "scoring", "chat", "repeats", "warc", "rules", "vectors", "spelling", "personal", "prefix_trie")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL by name, each from the module of its operator."""
    from importlib import import_module

    found: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for name in MODULES:
        module = import_module(f"perigee.llm.{name}")
        found |= module.QUERIES
        oracles |= getattr(module, "ORACLES", {})
    return found, oracles
