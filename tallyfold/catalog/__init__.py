"""Registered queries, each with its check in SQL where SQL can express it."""

from __future__ import annotations

from tallyfold.catalog.registry import Query


def all_queries() -> list[Query]:
    from tallyfold.catalog import (
        cleaning, features, learning, places, reports, rollups, storage, streams,
    )

    out: list[Query] = []
    for module in (storage, cleaning, places, features, rollups, reports, streams, learning):
        out.extend(module.QUERIES)
    names = [q.name for q in out]
    if len(set(names)) != len(names):
        raise ValueError("query names must be unique")
    return out
