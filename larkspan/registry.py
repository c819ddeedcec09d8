"""Query registry: a name, the Spark job and, where one exists, the equal SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larkspan.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None = None):
    """Register the decorated function under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__} registered twice")
        REGISTRY[fn.__name__] = Query(fn.__name__, fn, oracle)
        return fn

    return register


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from larkspan.plans import (  # noqa: F401
        aggregates,
        chunks,
        evaluation,
        graph,
        jobs,
        predicates,
        relational,
        reports,
        retrieval,
        scalars,
        semantics,
        sources_sinks,
        streams,
        textual,
        udfs,
        windows,
    )

    return REGISTRY
