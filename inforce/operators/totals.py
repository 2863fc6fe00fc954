"""Running totals that take a new month.

The running ratio is a window over segments x months. Kept as a table of monthly
sums with their running totals, a new month costs a pass over that month's rows and
one row per segment, not a pass over the history. A month that comes late, or again
with more rows, corrects the totals from its month on and leaves earlier rows as
they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_sums(rows: DataFrame, by: Sequence[str], month: str, measures: Sequence[str]) -> DataFrame:
    """(<by>, <month>, <measures>): the sums of new rows, combined before the shuffle."""
    return rows.groupBy(*by, month).agg(*[F.sum(m).alias(m) for m in measures])


def _running(sums: DataFrame, by: Sequence[str], month: str, measures: Sequence[str], before: DataFrame | None = None) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(month).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = sums.select("*", *[F.sum(m).over(w).alias(f"cum_{m}") for m in measures])
    if before is None:
        return out
    names = [f"_b{i}" for i in range(len(by))]
    b = before.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], *[F.col(f"cum_{m}").alias(f"_before_{m}") for m in measures])
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    out = out.join(b, on, "left")

    def total(m: str):
        now, old = F.col(f"cum_{m}"), F.col(f"_before_{m}")
        return F.coalesce(now + old, now, old).alias(f"cum_{m}")  # a sum without values is NULL

    return out.select(*by, month, *measures, *[total(m) for m in measures])


def running_totals(rows: DataFrame, by: Sequence[str], month: str, measures: Sequence[str]) -> DataFrame:
    """(<by>, <month>, <measures>, cum_<measure>): monthly sums and running totals per
    ``by``. Months sort as they are; a null month comes first."""
    return _running(monthly_sums(rows, by, month, measures), by, month, measures)


def add_months(totals: DataFrame, rows: DataFrame, by: Sequence[str], month: str, measures: Sequence[str]) -> DataFrame:
    """``running_totals`` of everything so far with new ``rows``: rows of ``totals``
    before the earliest new month stay; from that month on, monthly sums are united and
    their running totals made again on top of each segment's last row before it."""
    new = monthly_sums(rows, by, month, measures)
    first = new.agg(F.min(month)).scalar()
    marked = totals.withColumn("_first", first)
    early = F.col("_first").isNull() | (F.coalesce(F.col(month) < F.col("_first"), F.lit(True)))
    kept = marked.filter(early).drop("_first")
    late = marked.filter(~early).select(*by, month, *measures)
    before = kept.groupBy(*by).agg(F.max_by(F.struct(*[f"cum_{m}" for m in measures]), F.struct(F.col(month).isNotNull(), F.col(month))).alias("r")).select(*by, "r.*")
    joined = monthly_sums(late.unionByName(new), by, month, measures)
    types = {f.name: f.dataType for f in totals.schema.fields}
    redone = _running(joined, by, month, measures, before)
    return kept.unionByName(redone.select(*[F.col(c).cast(types[c]).alias(c) for c in totals.columns]))
