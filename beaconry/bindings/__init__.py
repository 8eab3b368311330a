"""Every operator bound to the benchmark tables, with the SQL it must agree with."""

from __future__ import annotations

from . import campaign, learning, matching, relational, storage

_PARTS = (relational, storage, campaign, matching, learning)


def all_queries() -> dict:
    return {name: run for part in _PARTS for name, run in part.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
