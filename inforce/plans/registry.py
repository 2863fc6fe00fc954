"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def deliver_as(name: str, columns: tuple[str, ...], spark_type: str, sql_type: str) -> None:
    """Deliver columns that can be NULL in a type every consumer reads alike,
    in a registered query *and* its oracle. pandas, for one, turns a nullable
    integer into float on one side and a masked integer on the other, and a
    NULL date into ``None`` on one side and ``NaT`` on the other; integers as
    DOUBLE and dates as ISO text ('yyyy-MM-dd') avoid both."""
    fn = QUERIES[name]

    def run(spark, d):
        df = fn(spark, d)
        return df.select(*[F.col(c).cast(spark_type).alias(c) if c in columns else F.col(c) for c in df.columns])

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[name] = run
    if name in ORACLES:
        ORACLES[name] = (
            "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS {sql_type}) AS {c}" for c in columns) + ") FROM (\n"
            + ORACLES[name] + "\n) AS _q"
        )


def deliver_as_double(name: str, columns: tuple[str, ...]) -> None:
    """Nullable integer columns as DOUBLE (see ``deliver_as``)."""
    deliver_as(name, columns, "double", "DOUBLE")


def deliver_as_text(name: str, columns: tuple[str, ...]) -> None:
    """Nullable date columns as ISO text (see ``deliver_as``)."""
    deliver_as(name, columns, "string", "VARCHAR")


def finalize(df: DataFrame) -> DataFrame:
    """Exact decimals -> DOUBLE at the very end (result schemas are engine-neutral)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
