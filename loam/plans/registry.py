"""Query and oracle registries, filled by the modules of this folder."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "q_first_match"


def query(sql: str | None = None) -> Callable:
    """Register a ``(spark, sf_dir) -> DataFrame`` under its own name, with its oracle."""

    def keep(fn: Callable) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return keep


def load() -> None:
    """Import the modules that register queries."""
    from loam.plans import q_gold, q_relational, q_sources, q_text  # noqa: F401
