"""Registered queries, each beside the SQL that must give the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark query and, where plain SQL can say it, its equivalent."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


def load() -> None:
    """Import every module that registers queries."""
    from verification import (  # noqa: F401
        cleaning,
        drift,
        features,
        files,
        models,
        splits,
        streams,
        telemetry,
    )
