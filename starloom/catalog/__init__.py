"""Runnable queries: every operator bound to the benchmark tables, with its SQL check."""

from __future__ import annotations

from starloom.catalog import city, keyed, music, quality, refresh, storage
from starloom.catalog.base import Query

ALL: dict[str, Query] = {}
for _module in (city, music, keyed, quality, storage, refresh):
    for _name, _query in _module.QUERIES.items():
        if _name in ALL:
            raise ValueError(f"query registered twice: {_name}")
        ALL[_name] = _query
