"""Maintenance helpers: profiling, distinct counts, claim ingestion.

Profiling is one aggregation pass (partial aggregates per task, one small
final stage); ingestion is a filtered projection with schema-driven casts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def distinct_count(df: DataFrame, key: str, out: str = "id_cnt") -> DataFrame:
    return df.agg(F.countDistinct(key).alias(out))


def profile(df: DataFrame, id_col: str, date_col: str, status_col: str) -> DataFrame:
    """Latest/first snapshot date, distinct statuses, ids and dates, row count."""
    return df.agg(
        F.max(date_col).alias("latest_dt"),
        F.min(date_col).alias("first_dt"),
        F.countDistinct(status_col).alias("status_cnt"),
        F.countDistinct(id_col).alias("id_cnt"),
        F.countDistinct(date_col).alias("date_cnt"),
        F.count(F.lit(1)).alias("row_cnt"),
    )


def segment_date_range(df: DataFrame, segment: Sequence[str], date_col: str, id_col: str) -> DataFrame:
    """First and last date and distinct ids per segment (one aggregation)."""
    return df.groupBy(*segment).agg(
        F.min(date_col).alias("first_dt"), F.max(date_col).alias("last_dt"), F.countDistinct(id_col).alias("id_cnt")
    )


def timestamps_to_dates(df: DataFrame) -> DataFrame:
    """Every timestamp column becomes a DATE (schema-driven, like the notebook's loop)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            out.append(F.to_date(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def claims_ingest(
    src: DataFrame,
    since: dt.date | Column,
    date_col: str = "loss_dt",
    special_covs: Sequence[str] = ("Glass", "Towing"),
) -> DataFrame:
    """Claims on or after ``since`` with the glass/towing amount split out and
    all timestamps reduced to dates. The date filter is pushed into the scan."""
    bound = since if isinstance(since, Column) else F.lit(since)
    df = src.filter(F.col(date_col) >= bound)
    df = df.withColumn(
        "glass_tow_amt",
        F.when(F.col("cov_typ_desc").isin(list(special_covs)), F.col("clm_ttl_inc_amt")).otherwise(
            F.lit(0).cast("decimal(18,4)")
        ),
    )
    return timestamps_to_dates(df)


def add_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """``ALTER TABLE ... ADD COLUMN c DEFAULT v``: new columns with constant defaults."""
    return df.select(F.col("*"), *[F.lit(v).alias(c) for c, v in defaults.items()])


def insert_into(target: DataFrame, rows: DataFrame, by_position: bool = False) -> DataFrame:
    """``INSERT INTO target SELECT ...``: by column name, or by position as a
    column-list-free INSERT binds (the rows take the target's names)."""
    if by_position:
        if len(rows.columns) != len(target.columns):
            raise ValueError("INSERT by position needs the same number of columns")
        rows = rows.toDF(*target.columns)
        return target.union(rows.select(*[F.col(c).cast(t) for c, t in target.dtypes]))
    return target.unionByName(rows)


def top_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """``ORDER BY ... LIMIT n`` (top-k: each task keeps its best n, then one
    merge of at most n rows per task); the limit is the feature here."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "cnt") -> DataFrame:
    """pandas ``value_counts()``: rows per value (within ``by``), NULL values dropped."""
    return df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias(out))
