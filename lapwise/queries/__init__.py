"""Registry of queries over the given tables and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

AREAS = ["silver", "gold", "reports", "storage", "quality", "learning", "kpis"]


def collect(attribute: str) -> dict:
    found: dict = {}
    for area in AREAS:
        part = getattr(import_module(f"lapwise.queries.{area}"), attribute)
        repeated = found.keys() & part.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        found.update(part)
    return found
