"""Registry of named queries: key → (Spark builder, DuckDB oracle SQL or None).

Keys follow the inventory IDs of SURVEY §2 in lower case (``c03_dedup`` …).
A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(key: str, oracle: str | None = None):
    """Register a query builder under ``key`` with its oracle SQL (None → rows-only check)."""
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules registers their queries
    from starmetrics.plans import (  # noqa: F401
        cleansing, dimensions, joins_q, aggregates_q, windows_q, quality_q, measures_q,
        templates_q, pages_q, ml_q, pricing_q, price_cells_q, streaming_q, measures_sales_q, measures_ops_q, ml_models_q, graph_q, scores_q,
    )
    return REGISTRY
