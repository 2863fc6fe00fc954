"""Small building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a parameter table that may be broadcast without being measured.
BROADCAST_ROW_BOUND = 100_000

# Rows that a task with wide sorts or hash tables is meant to take.
ROWS_PER_TASK = 500_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions of about ``ROWS_PER_TASK`` rows at most, and no fewer than the session's
    shuffles have. Given to ``repartition`` with the keys of a join: AQE merges other
    shuffles up to a size in *compressed* bytes, so well-compressed rows end up in few
    tasks, whose sorts and hash tables then grow with the table; a stated number stays."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def bounded_broadcast(df: DataFrame, row_bound: int | None, limit: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Broadcast ``df`` when it was built from a list of ``row_bound`` rows in the
    code; otherwise (``None``) AQE decides after measuring its size at run time."""
    return F.broadcast(df) if row_bound is not None and row_bound <= limit else df


def cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def order_cols(order: Sequence[str | Column], descending: bool = True, nulls_first: bool = True) -> list[Column]:
    """Explicit null ordering (engines disagree on the default)."""
    out = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        if descending:
            out.append(c.desc_nulls_first() if nulls_first else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_first() if nulls_first else c.asc_nulls_last())
    return out


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def exclude_keys(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``NOT IN`` with the null trap removed: anti join against the non-null keys.

    A null-aware anti join is broadcast-only in Spark; a plain ``left_anti``
    on non-null keys shuffles and scales for a large right side.
    """
    return df.join(drop_null_keys(members.select(*keys), keys), list(keys), "left_anti")


def with_group_aggs(df: DataFrame, key: Sequence[str], aggs: Sequence[Column], null_keys: bool = False) -> DataFrame:
    """Attach per-key aggregates to every row (``agg() OVER (PARTITION BY key)``).

    Written as a partial aggregation joined back rather than a window: a hot
    key ships one partial row per task instead of all its rows to one task,
    and the join back is an equi-join that AQE can split when skewed.

    Rows with a NULL key get NULL aggregates unless ``null_keys=True``, which
    matches NULL keys null-safely as the window would (at the cost of
    re-partitioning on the null-safe key instead of reusing the key's)."""
    g = df.groupBy(*key).agg(*aggs)
    if not null_keys:
        return df.join(g, list(key), "left")
    g = g.select(*[F.col(k).alias(f"_gk_{k}") for k in key], *[c for c in g.columns if c not in key])
    cond = None
    for k in key:
        c = F.col(k).eqNullSafe(F.col(f"_gk_{k}"))
        cond = c if cond is None else cond & c
    return df.join(g, cond, "left").drop(*[f"_gk_{k}" for k in key])
