"""The example queries: each runs the engine on the given tables; most have a SQL twin."""

from __future__ import annotations

import importlib

MODULES = ["shredding", "changes", "checks", "outputs", "runs"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"catalog.{name}"), attribute))
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
