"""Skew-safe ordered lags.

``LAG(x, n) OVER (PARTITION BY key ORDER BY t)`` sends every row of a key to
one task. When one key can hold a large share of all rows (a hot policy,
account or quote), that task does the whole key's sort alone.

``bucketed_lags`` splits each key's sequence into contiguous buckets of the
order (e.g. the effective year), so the heavy window runs per (key, bucket)
and a hot key is spread over as many tasks as it has buckets:

1. window over (key, bucket): local lags and the row's position;
2. the last ``max_offset`` rows of every bucket form a small "tail" table
   (at most ``max_offset`` rows per bucket, whatever the key's size);
3. a window over the tails per key gives, for each bucket, the values of the
   ``max_offset`` rows just before it — the rows that cross the boundary;
4. the carry-in values are joined back on (key, bucket), which is the same
   distribution as step 1, so the big side is not shuffled again.

Both branches need the same rows. The columns that the caller keeps, orders by and
lags are written once to the shared folder as Parquet, so whatever they were derived
from is computed once and the tail branch reads back only its own columns. **This
write is a Spark job that runs when the function is called**, before any action on
the result. The result equals the plain window for any data (tested against it).

All lagged values of a row travel as one struct: a window has one ``LAG`` per
offset, however many columns are lagged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inforce.functions.columns import null_safe_parts
from inforce.session import written


def _asc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def _packed(lags: dict[str, Sequence[int]]) -> Column:
    return F.struct(*[F.col(c) for c in lags])


def bucketed_lags(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    lags: dict[str, Sequence[int]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``lag{n}_{col}`` for every ``col -> offsets`` in ``lags``; ``keep`` names
    the columns of ``df`` to carry (all by default), and so what is written.

    ``order`` must make rows unique within a key (add a tiebreak column);
    ``bucket`` must be non-decreasing along ``order`` within a key (NULL
    order values, and a NULL bucket, come first)."""
    key, keep = list(key), list(df.columns if keep is None else keep)
    offsets = sorted({n for v in lags.values() for n in v})
    max_off = offsets[-1]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    # never-NULL stand-ins for the key and the bucket: the windows and the
    # carry-in join use the same plain columns, so the join needs no new shuffle
    gkey = [c for i in range(len(key)) for c in (f"_kn{i}", f"_kf{i}")]
    bkt = df.select(bucket.alias("_bkt")).schema["_bkt"].dataType
    needed = list(dict.fromkeys([*keep, *key, *order, *lags]))
    rows = df.select(*needed, bucket.alias("_bkt"))
    rows = written(rows, "lag-rows")

    def keyed(columns: Sequence[str]) -> DataFrame:
        parts = []
        for i, k in enumerate(key):
            kn, kf = null_safe_parts(F.col(k), types[k])
            parts += [kn.alias(f"_kn{i}"), kf.alias(f"_kf{i}")]
        bn, bf = null_safe_parts(F.col("_bkt"), bkt)
        return rows.select(*columns, *parts, bn.alias("_bn"), bf.alias("_bf"), _packed(lags).alias("_now"))

    w = Window.partitionBy(*gkey, "_bn", "_bf").orderBy(*_asc(order))
    wd = Window.partitionBy(*gkey, "_bn", "_bf").orderBy(*_desc(order))
    local = [F.lag("_now", n).over(w).alias(f"_loc{n}") for n in offsets]
    d = keyed(list(dict.fromkeys([*keep, *order]))).select("*", F.row_number().over(w).alias("_rn"), *local).drop("_now")

    # last max_off rows per (key, bucket): a top-k per group, planned with a
    # partial group limit before its shuffle, so only <= max_off rows per
    # (key, bucket) and task move; this branch reads only its own columns
    tail = keyed(order).select(*gkey, "_bn", "_bf", "_now", F.row_number().over(wd).alias("_rnd")).filter(F.col("_rnd") <= max_off)
    # NULL bucket first, then buckets ascending; within a bucket earliest first
    wt = Window.partitionBy(*gkey).orderBy(F.col("_bn").desc(), F.col("_bf").asc(), F.col("_rnd").desc())
    tsel = [F.col(c) for c in gkey] + [F.col("_bn"), F.col("_bf")]
    tsel += [F.lag("_now", i).over(wt).alias(f"_in{i}") for i in range(1, max_off + 1)]
    # the earliest tail row of a bucket (first row, or the bucket changed from the
    # previous tail row) carries the values just before the bucket; computed on
    # the same window as the lags, so the tail table is shuffled once
    changed = (F.lag("_bn", 1).over(wt) != F.col("_bn")) | (F.lag("_bf", 1).over(wt) != F.col("_bf"))
    first_of_bucket = (F.row_number().over(wt) == 1) | changed
    carry = tail.select(*tsel, first_of_bucket.alias("_first")).filter(F.col("_first")).drop("_first")
    j = d.join(carry, [*gkey, "_bn", "_bf"], "left")
    out = [F.col(c) for c in keep]
    for n in offsets:
        e = F.when(F.col("_rn") > n, F.col(f"_loc{n}"))
        for k in range(1, n + 1):
            e = e.when(F.col("_rn") == k, F.col(f"_in{n - k + 1}"))
        j = j.withColumn(f"_lag{n}", e)
    return j.select(*out, *_unpacked(lags))


def _unpacked(lags: dict[str, Sequence[int]]) -> list[Column]:
    return [F.col(f"_lag{n}")[c].alias(f"lag{n}_{c}") for c, offs in lags.items() for n in offs]


def plain_lags(df: DataFrame, key: Sequence[str], order: Sequence[str], lags: dict[str, Sequence[int]], keep: Sequence[str] | None = None) -> DataFrame:
    """The single-window form (one exchange on the key)."""
    w = Window.partitionBy(*key).orderBy(*_asc(order))
    keep = list(df.columns if keep is None else keep)
    offsets = sorted({n for v in lags.values() for n in v})
    packed = df.select(*list(dict.fromkeys([*keep, *key, *order])), _packed(lags).alias("_now"))
    return packed.select(*keep, *[F.lag("_now", n).over(w).alias(f"_lag{n}") for n in offsets]).select(*keep, *_unpacked(lags))


def ordered_lags(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    lags: dict[str, Sequence[int]],
    bucket: Column | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Lags by the plain window, or skew-safe when a ``bucket`` is given (which
    writes the columns in use to the shared folder when called)."""
    if bucket is None:
        return plain_lags(df, key, order, lags, keep)
    return bucketed_lags(df, key, order, bucket, lags, keep)
