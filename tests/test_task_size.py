"""Rows of one task: wide stages are dealt by the number of rows, not by compressed bytes."""

from pyspark.sql import functions as F

from inforce.operators import common as C
from inforce.operators import reconcile as R
from inforce.plans import QUERIES
from inforce.plans import linkage_plans as LP
from inforce.plans import reconcile_plans as RP
from inforce.sources import staging as S

SF = "/root/testdata/sf0.001"


def most_rows_of_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_partitions_follow_the_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert C.partitions_for(spark, 0) == least
    assert C.partitions_for(spark, least * C.ROWS_PER_TASK + 1) == least + 1


def test_allocation_is_dealt_by_rows(spark, monkeypatch):
    # a few thousand rows are small beside the size that merged tasks are filled to
    monkeypatch.setattr(C, "ROWS_PER_TASK", 500)
    rows = S.loss(spark, SF).count()
    assert S.loss_partitions(spark, SF) == -(-rows // 500)
    assert most_rows_of_a_task(RP.alloc(spark, SF)) < 1000


def test_rounded_allocation_is_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_TASK", 500)
    assert most_rows_of_a_task(QUERIES["w16_allocation_rounded"](spark, SF)) < 1000


def test_joined_update_is_dealt_by_rows(spark):
    target = spark.createDataFrame([(str(i), i % 5 or None, float(i)) for i in range(3000)], "k string, m int, ee double")
    source = target.select("k", "m", (F.col("ee") * 2).alias("v"))
    plain = R.update_from(target, source, ["k", "m"], {"v": 0.0}, null_safe=["m"], share="ee")
    dealt = R.update_from(target, source, ["k", "m"], {"v": 0.0}, null_safe=["m"], share="ee", partitions=9)
    assert sorted(dealt.collect(), key=str) == sorted(plain.collect(), key=str)
    assert most_rows_of_a_task(dealt) < 600


def test_terms_that_replaced_nothing_are_spread(spark):
    # three of four policies replaced none
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = S.renewal_terms(spark, SF)
        assert most_rows_of_a_task(t) < t.count() / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_linked_quotes_are_dealt_by_rows(spark, monkeypatch):
    most = []

    def spy(df, name):
        most.append(most_rows_of_a_task(df))
        return df

    monkeypatch.setattr(C, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(LP, "written", spy)
    LP.crosswalk(spark, SF)
    assert most and max(most) < 1000


def test_stored_update_with_repeated_source_keys(spark, tmp_path):
    from inforce.sources.stored import StoredTable

    table = StoredTable(spark, str(tmp_path / "t"), "part")
    table.insert(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), (None, 1, "y"), ("c", 1, "z")], "k string, v int, part string"))
    source = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    seen = []

    def change(rows, src):
        seen.extend(r.part for r in rows.select("part").distinct().collect())
        return rows.withColumn("v", F.lit(2))

    table.update_from(source, ["k"], change)
    assert sorted(seen) == ["x", "y"]
    assert sorted((r.k or "", r.v) for r in table.read().collect()) == [("", 2), ("a", 2), ("b", 2), ("c", 1)]
