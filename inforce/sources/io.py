"""Sources and sinks beyond the Parquet inputs.

* ``read_jdbc`` — a relational source read in parallel: either a whole-number
  ``partition_column`` with bounds (``split_predicates``), or explicit ``predicates``
  (one task each).
  Connection details come from the deployment; nothing is hard-coded here.
* ``write_table`` — full overwrite (the source's transient-table replace) or
  append, optionally partitioned, to a path or a catalog table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def split_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """SQL predicates that deal the rows of a table to ``parts`` tasks by a whole-number
    column: together they hold every row exactly once, also values below ``lower`` or
    above ``upper`` and NULLs (in the first part). Fewer parts result where the range
    has fewer values."""
    if parts < 1 or upper < lower:
        raise ValueError("at least one part, and lower <= upper")
    span = upper - lower + 1
    parts = min(parts, span)
    edges = [lower + span * i // parts for i in range(1, parts)]
    if not edges:
        return ["1 = 1"]
    out = [f"{column} < {edges[0]} OR {column} IS NULL"]
    out += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [*out, f"{column} >= {edges[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A relational table, read by one task per predicate. With ``partition_column`` the
    predicates are made by ``split_predicates`` from the bounds."""
    props = dict(properties or {})
    if partition_column is not None and not predicates:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partition column needs both bounds and a number of partitions")
        predicates = split_predicates(partition_column, lower_bound, upper_bound, num_partitions)
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    as_table: bool = False,
) -> None:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)
