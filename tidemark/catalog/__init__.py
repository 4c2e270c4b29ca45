"""Named queries over the given tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("items", "trends", "feeds", "keywords", "vectors", "streams")


def _loaded():
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
    from tidemark.catalog.base import ORACLES, QUERIES

    return QUERIES, ORACLES


def queries() -> dict:
    return dict(_loaded()[0])


def oracles() -> dict:
    return dict(_loaded()[1])
