"""Distinct counts that can be aggregated again (§2.4 COUNT DISTINCT under filters).

``COUNT(DISTINCT id)`` of a month cannot be summed to a quarter: an id in two months
would count twice. Here the distinct ids of every group are kept as bitmaps, which
can be united: any filter on the groups and any coarser grouping gives exactly what
``countDistinct`` gives on the raw rows, from the small table alone.

Ids are numbered once (``number_ids``), so ids of any type are small numbers close
to each other. A bitmap row holds 32,768 numbers in 4 KB; a group has one row per
range of numbers it has ids in.

Scale notes
-----------
* Numbers come from the partition and the row within it: no global sort, no window
  over all ids. The dictionary is written, so numbers stay what they are.
* Bitmaps are built with partial aggregation: a group, however hot, ships one bitmap
  per range and task. Uniting bitmaps is an aggregation of the same kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inforce.session import written


def number_ids(df: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """(<id>, id_number) for every id of ``df`` that is not null, written to the shared
    folder when called. ``known``: an earlier dictionary, whose numbers stay; new ids
    get numbers after all of them."""
    ids = df.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    first = F.lit(0)
    if known is not None:
        ids = ids.join(known, id_col, "left_anti")
        # ranges of new numbers begin behind the greatest known one
        first = F.coalesce(known.agg(F.max("id_number") + 1).scalar(), F.lit(0))
    new = written(ids.select(id_col, (first + F.monotonically_increasing_id()).alias("id_number")), "id-numbers")
    return new if known is None else known.select(id_col, "id_number").unionByName(new)


def distinct_bitmaps(df: DataFrame, dims: Sequence[str], id_col: str, numbers: DataFrame) -> DataFrame:
    """(<dims>, bucket, ids): a bitmap of the numbers of each group's ids. Rows with a
    null id count for nothing; null dims are groups like any other."""
    n = F.col("id_number")
    rows = df.select(*dims, id_col).join(numbers, id_col)
    return rows.groupBy(*dims, F.bitmap_bucket_number(n).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("ids"))


def add_bitmaps(one: DataFrame, other: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Two bitmap tables as one: later rows, say of a late month, are united in."""
    return one.unionByName(other).groupBy(*dims, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def count_ids(bitmaps: DataFrame, dims: Sequence[str] = (), where: Column | None = None, name: str = "distinct_cnt") -> DataFrame:
    """Distinct ids by ``dims`` (none: one row), of the groups that ``where`` picks."""
    picked = bitmaps if where is None else bitmaps.filter(where)
    united = picked.groupBy(*dims, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("_n"))
    return united.groupBy(*dims).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))
