"""One thin query per operator on the supplied tables, with its SQL counterpart."""

from __future__ import annotations

import importlib

MODULES = ("scalars", "relational", "windows", "mapping", "matching", "marts", "model", "quality", "ingest", "geo", "facets")


def _load():
    from verigrid.queries import registry

    for module in MODULES:
        importlib.import_module(f"verigrid.queries.{module}")
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_sql():
    return dict(_load().SQL)
