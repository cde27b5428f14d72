"""Registered queries, grouped by the part of the library they exercise."""

from __future__ import annotations

from importlib import import_module

MODULES = ("population", "profiling", "sampling", "evaluation", "lookup", "neighbourhood", "training", "serving", "scale", "files")


def load_all() -> None:
    for name in MODULES:
        import_module(f"perigee.plans.{name}")
