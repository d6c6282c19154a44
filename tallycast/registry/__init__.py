"""Queries over the given test tables and the SQL they are checked against."""

from __future__ import annotations

import importlib

_MODULES = ("business", "series", "features", "forecasts", "models", "trees", "files")


def _merged(attribute: str) -> dict:
    merged = {}
    for name in _MODULES:
        merged.update(getattr(importlib.import_module(f"{__name__}.{name}"), attribute))
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict[str, str]:
    return _merged("ORACLE")
