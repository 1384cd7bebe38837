"""All queries of the engine by name, with their SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from foliant import registry

#: Modules that register queries.
MODULES = (
    "operators.versions", "operators.values", "operators.evaluation", "operators.telemetry",
    "operators.retrieval", "operators.texts", "operators.graph", "operators.verification",
    "operators.folds", "operators.layout", "operators.refinement", "operators.corpus", "operators.claims", "operators.lookup", "operators.reports", "operators.structure", "operators.store", "operators.profiles", "operators.tools", "plans.chat", "plans.flow",
    "streaming.traces", "sources.readers", "sources.writers",
)


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"foliant.{name}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid retrieval: word search and a second ranking fused by reciprocal ranks."""
    _load()
    return registry.QUERIES["hybrid_retrieve"](spark, sf_dir)


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.SQL)
