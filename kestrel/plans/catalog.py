"""Registry of named queries (Spark callables) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
test tables. The modules ``catalog_*`` register themselves on import.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` as query ``name``; ``oracle`` is its DuckDB SQL (optional)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all():
    # Import for the registration side effect.
    from kestrel.plans import (catalog_geo, catalog_clean, catalog_features,  # noqa: F401
                               catalog_prep, catalog_profile, catalog_metrics,
                               catalog_rules, catalog_models, catalog_balance,
                               catalog_streaming, catalog_sources)
    return QUERIES, ORACLES
