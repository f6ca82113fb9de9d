"""Registration of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmill.catalog.prelude import PRELUDE
from tripmill.session import ensure_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` follows the shared common table expressions."""
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session(spark)
            return zoneless(fn(spark, sf_dir))
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = PRELUDE + sql
        return run
    return register


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock timestamps, which do not change with the reader's zone."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    if not instants:
        return df
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in instants})
