"""Registered queries, each with the SQL text of its expected result."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ("scans", "filters", "joins", "aggregates", "windows", "sets", "scalars", "quality", "jobs", "dashboards")


def load() -> dict:
    """Name to registered query, over all sections."""
    entries: dict = {}
    for section in SECTIONS:
        found = import_module(f"{__name__}.{section}").QUERIES.entries
        repeated = entries.keys() & found.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        entries.update(found)
    return entries
