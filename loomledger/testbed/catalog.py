"""Every registered query: how to build it and the result to expect."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loomledger.testbed import oracle
from loomledger.testbed.results import comparable

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def register(name: str, build: Build, columns: str = "", body: str | None = None,
             kinds: dict[str, str] | None = None) -> None:
    """``columns`` lists the output columns; ``body`` is the expected result."""
    if name in CATALOG:
        raise ValueError(f"query {name} is registered twice")
    sql = None if body is None else oracle.query(columns.split(), body, kinds)
    CATALOG[name] = Query(lambda spark, sf_dir: comparable(build(spark, sf_dir)), sql)


def load() -> dict[str, Query]:
    """All queries; the case modules register theirs on import."""
    from loomledger.testbed import (  # noqa: F401
        cases_columns,
        cases_generate,
        cases_incremental,
        cases_models,
        cases_operators,
        cases_quality,
        cases_storage,
        cases_strict,
    )

    return CATALOG
