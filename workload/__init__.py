"""Registered queries over the test tables, with equivalent SQL where one exists."""

from __future__ import annotations

import importlib

MODULES = (
    "sources", "cleaning", "features", "macro", "sampling", "evaluation", "loss", "attribution",
    "anomalies", "sequences", "reporting", "models", "composites", "facts",
)


def load():
    """All entries: name to (callable, SQL or None)."""
    from workload.registry import ENTRIES

    for module in MODULES:
        importlib.import_module(f"workload.{module}")
    return ENTRIES
