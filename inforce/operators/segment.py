"""Segmentation: row relativities, banding rules, per-band summaries.

Scale notes
-----------
* Group means over a low-cardinality key (state) are computed by a partial
  (map-side) aggregation and joined back, broadcast when the number of
  groups is bounded. A window ``avg() OVER (PARTITION BY state)`` would send
  every row of a hot state to one task.
* All segmentations are summarised in one pass: each row emits one
  (segmentation, band) pair per banding via ``explode``, then a single
  ``groupBy`` — one scan and one shuffle instead of one per segmentation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inforce.functions.bands import band_expr
from inforce.functions.columns import round_half_up


# --------------------------------------------------------------------------- W22
def relativity_rows(
    df: DataFrame,
    group: str,
    measures: Mapping[str, str],
    digits: int = 6,
) -> DataFrame:
    """Row relativity = row value / mean of its group, for each ``measure -> out``.
    The mean is Σ / count of non-null values (pandas ``mean`` semantics; NULL
    group keys get no mean). AQE measures the means and broadcasts them if they
    are small."""
    aggs = []
    for m in measures:
        aggs.append((F.sum(m).cast("double") / F.count(m).cast("double")).alias(f"_mean_{m}"))
    means = df.groupBy(group).agg(*aggs).filter(F.col(group).isNotNull())
    j = df.join(means, group, "left")
    out = [F.col("*")]
    for m, name in measures.items():
        mean = F.col(f"_mean_{m}")
        out.append(F.round(mean, digits).alias(f"{name}_mean"))
        out.append(
            F.round(F.when(mean == 0, F.lit(None).cast("double")).otherwise(F.col(m).cast("double") / mean), digits).alias(name)
        )
    return j.select(*out).drop(*[f"_mean_{m}" for m in measures])


# --------------------------------------------------------------------------- W21
def numeric_from_text(col: str, none_text: str = "None", default=0) -> Column:
    """``to_numeric(x.replace('None', 0))``: the placeholder text becomes ``default``,
    anything else is cast (ANSI cast raises on junk, like ``to_numeric``)."""
    c = F.col(col)
    return F.when(c == none_text, F.lit(default).cast("double")).otherwise(c.cast("double"))


def segment_bands(df: DataFrame, rules: Mapping[str, tuple], first_match: bool = True) -> DataFrame:
    """Add one band column per entry ``out -> (input column or Column, rules, default)``."""
    out = [F.col("*")]
    for name, (src, rule_list, default) in rules.items():
        out.append(band_expr(src, rule_list, default=default, first_match=first_match).alias(name))
    return df.select(*out)


def category_map(col: str | Column, mapping: Mapping[str, str], default=None) -> Column:
    """Simple ``CASE x WHEN k THEN v ... ELSE default END``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


# --------------------------------------------------------------------------- W23
def segment_summary(
    df: DataFrame,
    by: Sequence[str],
    count_col: str,
    mean_col: str,
    digits: int = 6,
) -> DataFrame:
    """Long-form summary over several segmentations in one pass:
    (segmentation, band, cnt = count of non-null ``count_col``, lrr = mean of
    ``mean_col``). Rows whose band is NULL are dropped (pandas group keys).
    The mean is an exact decimal sum over the count of non-null values, so it
    does not depend on the order rows arrive in."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(b).alias("segmentation"), F.col(b).cast("string").alias("band")) for b in by])
    ).alias("_p")
    exploded = df.select(pairs, F.col(count_col).alias("_c"), F.col(mean_col).cast(f"decimal(18,{digits})").alias("_m"))
    g = (
        exploded.select("_p.segmentation", "_p.band", "_c", "_m")
        .filter(F.col("band").isNotNull())
        .groupBy("segmentation", "band")
        .agg(
            F.count("_c").alias("cnt"),
            round_half_up(F.sum("_m").cast("double") / F.count("_m").cast("double"), digits).alias("lrr"),
        )
    )
    return g


def write_summary(summary: DataFrame, path: str) -> None:
    """One output folder per segmentation (the workbook's one sheet each)."""
    summary.write.mode("overwrite").partitionBy("segmentation").parquet(path)
