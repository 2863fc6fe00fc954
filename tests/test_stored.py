"""Stored tables, snapshots, code runs, bitmap counts and appended totals."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from inforce.operators import distinct as DC
from inforce.operators import snapshots as SN
from inforce.operators import totals as TT
from inforce.sources.stored import StaleTable, StoredTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture()
def table(spark):
    t = StoredTable(spark, os.path.join(tempfile.mkdtemp(prefix="inforce-stored-"), "t"), "p")
    t.insert(spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, "c d/e", None), (5, None, "z")], "id long, p string, v string"))
    return t


# ----------------------------------------------------------------------------- stored tables
def test_insert_and_read(spark, table):
    assert rows(table.read()) == [(1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, "c d/e", None), (5, None, "z")]
    assert table.version() == 1 and "c d/e" in table.partitions()
    table.insert(spark.createDataFrame([("w", 9, "b")], "v string, id int, p string"))  # by name, cast
    assert rows(table.read(only=lambda p: p == "b")) == [(3, "b", "y"), (9, "b", "w")]
    assert rows(table.read(version=1, only=lambda p: p == "b")) == [(3, "b", "y")]
    table.insert(spark.createDataFrame([], "id long, p string, v string"))
    assert table.read().count() == 6


def test_replace_is_idempotent_and_touches_only_its_partitions(spark, table):
    new = spark.createDataFrame([(7, "a", "new")], "id long, p string, v string")
    files = set(table.read(only=lambda p: p != "a").inputFiles())
    for _ in range(2):
        table.replace(new)
        assert rows(table.read()) == [(3, "b", "y"), (4, "c d/e", None), (5, None, "z"), (7, "a", "new")]
        assert set(table.read(only=lambda p: p != "a").inputFiles()) == files


def test_update_and_delete_rewrite_only_touched_partitions(spark, table):
    kept = set(table.read(only=lambda p: p == "b").inputFiles())
    table.update({"v": F.concat("v", F.lit("!"))}, F.col("id") == 2)
    assert rows(table.read()) == [(1, "a", "x"), (2, "a", "x!"), (3, "b", "y"), (4, "c d/e", None), (5, None, "z")]
    table.update({"v": F.lit("n")}, F.col("v").isNull())
    table.delete(F.col("v") == "x")  # NULL conditions delete nothing
    assert rows(table.read()) == [(2, "a", "x!"), (3, "b", "y"), (4, "c d/e", "n"), (5, None, "z")]
    table.delete_in(spark.createDataFrame([(5,), (None,), (77,)], "id long"), "id")
    assert rows(table.read()) == [(2, "a", "x!"), (3, "b", "y"), (4, "c d/e", "n")]
    before = table.version()
    table.delete(F.col("id") == 1000)
    assert table.version() == before  # nothing matched, nothing written
    assert set(table.read(only=lambda p: p == "b").inputFiles()) == kept
    table.delete(F.lit(True))
    assert table.read().count() == 0 and table.read().columns == ["id", "p", "v"]
    table.insert(spark.createDataFrame([(1, "q", "w")], "id long, p string, v string"))
    assert rows(table.read()) == [(1, "q", "w")]


def test_update_may_move_rows_to_another_partition(table):
    table.update({"p": F.lit("b")}, F.col("id") == 1)
    assert rows(table.read(only=lambda p: p == "b")) == [(1, "b", "x"), (3, "b", "y")]
    assert table.read().count() == 5


def test_update_from_and_add_columns(spark, table):
    table.add_columns({"n": F.lit(0)})
    source = spark.createDataFrame([("y", 5), (None, 6)], "v string, n int")

    def change(df, src):
        s = src.select(F.col("v").alias("_v"), F.col("n").alias("_n"))
        return df.join(s, df.v.eqNullSafe(s._v), "left").select("id", "p", "v", F.coalesce("_n", "n").alias("n"))

    table.update_from(source, ["v"], change)
    assert rows(table.read().select("id", "n")) == [(1, 0), (2, 0), (3, 5), (4, 6), (5, 0)]
    assert table.read(version=1).columns == ["id", "p", "v"]


def test_a_reader_sees_the_table_before_or_after_a_write(spark, table):
    old = table.read()  # planned before, run after the rewrites
    table.update({"v": F.lit("later")}, F.lit(True))
    table.delete(F.col("id") > 2)
    assert rows(old) == [(1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, "c d/e", None), (5, None, "z")]
    assert rows(table.read()) == [(1, "a", "later"), (2, "a", "later")]


def test_a_failed_write_leaves_the_old_version(spark, table):
    broken = F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    with pytest.raises(Exception, match="lost"):
        table.update({"v": broken}, F.col("id") < 4)
    assert table.version() == 1 and table.read().count() == 5
    # data was written, the version file was not
    table._write(spark.createDataFrame([(8, "a", "lost")], "id long, p string, v string"))
    assert table.read().count() == 5
    table.delete(F.col("id") == 1)
    assert rows(table.read(only=lambda p: p == "a")) == [(2, "a", "x")]


def test_a_stale_writer_is_refused(spark, table, monkeypatch):
    other, write = StoredTable(spark, table.path, "p"), table._write

    def slow(df):
        out = write(df)
        other.delete(F.col("id") == 5)  # another writer ends first
        return out

    monkeypatch.setattr(table, "_write", slow)
    with pytest.raises(StaleTable):
        table.insert(spark.createDataFrame([(9, "a", "x")], "id long, p string, v string"))
    assert [r[0] for r in rows(other.read())] == [1, 2, 3, 4]


def test_nothing_written(spark):
    t = StoredTable(spark, os.path.join(tempfile.mkdtemp(), "none"), "p")
    assert t.version() == 0 and t.partitions() == []
    with pytest.raises(ValueError, match="nothing"):
        t.read()


# ----------------------------------------------------------------------------- snapshots and runs
TERM = "pol_id string, pol_prd_id long, pol_eff_dt date, pol_exp_dt date, rate_plan_cd string, pol_form_cd string, canc_eff_dt date"
LAST = dt.date(2001, 6, 30)


def random_terms(rng, months=(12, 12, 12, 6, 3)):
    out = []
    for p in [*range(30), None]:
        for _ in range(rng.randrange(1, 7)):
            eff = dt.date(1999, 1, 1) + dt.timedelta(days=rng.randrange(900))
            exp = eff + dt.timedelta(days=rng.choice(months) * 30 + rng.randrange(6))
            canc = eff + dt.timedelta(days=rng.randrange(-20, 420)) if rng.random() < 0.4 else None
            out.append((None if p is None else f"p{p}", len(out), eff, exp, rng.choice("AB"), rng.choice(["1", "2", None]), canc))
    out += [("n1", 900, None, dt.date(2000, 5, 1), "A", "1", None), ("n2", 901, dt.date(2000, 5, 1), None, "A", "1", None), ("z", 902, dt.date(2000, 5, 2), dt.date(2000, 5, 20), "A", "1", None)]
    return out


def month_ends(last=LAST):
    me = dt.date(1999, 1, 31)
    while me <= last:
        yield me
        nxt = (me + dt.timedelta(days=1)).replace(day=28) + dt.timedelta(days=4)
        me = nxt - dt.timedelta(days=nxt.day)


def brute_snapshots(terms, last=LAST):
    out = {}
    for me in month_ends(last):
        for p, prd, eff, exp, plan, form, canc in terms:
            if eff is not None and exp is not None and eff <= me < exp and ((p, me) not in out or (eff, prd) > out[p, me][:2]):
                out[p, me] = (eff, prd, plan, form, "Cancelled" if canc is not None and canc <= me else "InForce")
    return {(p, me, *v[1:]) for (p, me), v in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_and_runs_equal_brute_force(spark, seed):
    terms = random_terms(random.Random(seed))
    df = spark.createDataFrame(terms, TERM).repartition(4)
    want = brute_snapshots(terms)
    got = SN.all_snapshots(df, F.lit(LAST))
    assert {(r.policy_id, r.me_dt, r.pol_prd_id, r.rate_plan_cd, r.pol_form_cd, r.pol_status_cd) for r in got.collect()} == want
    me = dt.date(2000, 7, 31)
    one = {(r.policy_id, r.me_dt, r.pol_prd_id, r.rate_plan_cd, r.pol_form_cd, r.pol_status_cd) for r in SN.month_snapshot(df, me).collect()}
    assert one == {w for w in want if w[1] == me}

    runs = SN.code_runs(df, F.lit(LAST))
    laid = [(r.policy_id, m, r.pol_form_cd, r.pol_status_cd) for r in runs.collect() for m in month_ends() if r.from_me <= m <= r.to_me]
    assert sorted(laid, key=str) == sorted(((p, m, form, status) for p, m, _, _, form, status in want), key=str)
    # longest possible: no two neighbours alike
    ends = {(r.policy_id, r.pol_form_cd, r.pol_status_cd, r.to_me) for r in runs.collect()}
    assert not any((r.policy_id, r.pol_form_cd, r.pol_status_cd, r.from_me.replace(day=1) - dt.timedelta(days=1)) in ends for r in runs.collect())
    counts = {(r.me_dt, r.pol_form_cd, r.pol_status_cd): r.policies for r in SN.counts_by_month(runs).collect()}
    expected = {}
    for _, m, _, _, form, status in want:
        expected[m, form, status] = expected.get((m, form, status), 0) + 1
    assert counts == expected
    assert {(r.policy_id, r.pol_form_cd, r.pol_status_cd) for r in SN.runs_at(runs, me).collect()} == {(p, form, status) for p, m, _, _, form, status in want if m == me}


def test_months_added_to_runs_equal_a_full_build(spark):
    terms = random_terms(random.Random(5))
    df = spark.createDataFrame(terms, TERM)
    runs = SN.code_runs(df, F.lit(dt.date(2000, 11, 30)))
    for me in (dt.date(2000, 12, 31), dt.date(2001, 1, 31), dt.date(2001, 1, 31), dt.date(2001, 2, 28)):  # one month twice
        runs = SN.extend_runs(runs, SN.month_snapshot(df, me))
    assert rows(runs) == rows(SN.code_runs(df, F.lit(dt.date(2001, 2, 28))))


def test_transitions_from_runs_equal_those_from_snapshots(spark):
    from inforce.operators.persistency import code_transitions

    terms = random_terms(random.Random(7))
    df = spark.createDataFrame(terms, TERM)
    snap = SN.all_snapshots(df, F.lit(LAST))
    for since in (dt.date(2000, 3, 31), dt.date(2000, 3, 15)):
        recent = snap.filter((F.col("me_dt") > F.lit(since)) & (F.col("pol_status_cd") == "InForce"))
        now = snap.filter((F.col("me_dt") == F.lit(LAST)) & (F.col("pol_status_cd") == "InForce"))
        got = SN.run_transitions(SN.code_runs(df, F.lit(LAST)), since, from_code="1", none_code="2", last=F.lit(LAST))
        assert rows(got) == rows(code_transitions(recent, now, from_code="1", none_code="2"))


def test_appending_a_month_twice_and_reading_the_latest(spark):
    df = spark.createDataFrame(random_terms(random.Random(9)), TERM)
    table = SN.snapshot_table(spark, os.path.join(tempfile.mkdtemp(), "snap"))
    months = [dt.date(2000, 1, 31), dt.date(2000, 2, 29), dt.date(2000, 2, 29), dt.date(2000, 1, 31)]
    for me in months:
        SN.append_month(table, df, me)
    assert table.partitions() == ["2000-01-31", "2000-02-29"]
    assert rows(table.read()) == rows(SN.month_snapshot(df, months[0]).unionByName(SN.month_snapshot(df, months[1])))
    latest = SN.latest_snapshot(table)
    assert latest.count() > 0 and all("me_dt=2000-02-29" in f for f in latest.inputFiles())
    assert rows(latest) == rows(SN.month_snapshot(df, months[1]))


# ----------------------------------------------------------------------------- distinct counts
def test_bitmap_counts_equal_distinct_counts_under_any_filter(spark):
    rng = random.Random(3)
    data = [(rng.choice(["s", "t", None]), rng.choice([1, 2, 3]), rng.choice(["m1", "m2"]), rng.choice([f"id{rng.randrange(400)}", None])) for _ in range(3000)]
    df = spark.createDataFrame(data, "seg string, st int, month string, id string").repartition(5)
    dims = ["seg", "st", "month"]
    maps = DC.distinct_bitmaps(df, dims, "id", DC.number_ids(df, "id"))
    for by in ([], ["seg"], ["seg", "month"], dims):
        for where in (None, F.col("st") != 2, (F.col("month") == "m1") & F.col("seg").isNotNull(), F.lit(False)):
            raw = df if where is None else df.filter(where)
            # a group without ids has no bitmap: it is absent, not zero
            want = raw.groupBy(*by).agg(F.countDistinct("id").alias("n"))
            want = want if not by else want.filter("n > 0")
            assert rows(DC.count_ids(maps, by, where, "n").select(*by, "n")) == rows(want.select(*by, "n"))


def test_bitmaps_of_a_late_month_are_united(spark):
    one = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, id string")
    two = spark.createDataFrame([("a", "y"), ("a", "z"), ("b", "w")], "k string, id string")
    first = DC.number_ids(one, "id")
    both = DC.number_ids(two, "id", first)
    assert {r.id: r.id_number for r in first.collect()}.items() <= {r.id: r.id_number for r in both.collect()}.items()
    assert both.select("id_number").distinct().count() == both.count() == 4
    maps = DC.add_bitmaps(DC.distinct_bitmaps(one, ["k"], "id", first), DC.distinct_bitmaps(two, ["k"], "id", both), ["k"])
    assert rows(DC.count_ids(maps, ["k"])) == [("a", 3), ("b", 1)] and rows(DC.count_ids(maps)) == [(4,)]


def test_bitmaps_over_several_ranges(spark):
    df = spark.range(100_000).selectExpr("id % 3 as k", "cast(id as string) as id")
    maps = DC.distinct_bitmaps(df, ["k"], "id", DC.number_ids(df, "id"))
    assert rows(DC.count_ids(maps, ["k"])) == [(0, 33_334), (1, 33_333), (2, 33_333)]


# ----------------------------------------------------------------------------- running totals
def test_appended_totals_equal_a_full_run(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", None]), rng.choice(["199901", "199902", "199903", "199904", None]), rng.choice([None, rng.randrange(100)])) for _ in range(400)]
    df = spark.createDataFrame(data, "seg string, month string, x long")
    full = TT.running_totals(df, ["seg"], "month", ["x"])
    month = F.coalesce("month", F.lit("0"))
    steps = [month.isin("0", "199901", "199903"), month == "199904", month == "199902"]  # the last one is late
    table = TT.running_totals(df.filter(steps[0]), ["seg"], "month", ["x"])
    for s in steps[1:]:
        table = TT.add_months(table, df.filter(s), ["seg"], "month", ["x"])
    assert rows(table) == rows(full)
    again = TT.add_months(table, df.limit(0), ["seg"], "month", ["x"])
    assert rows(again) == rows(full)
    # a month in two parts
    parts = TT.add_months(TT.running_totals(df.filter("x < 50 or month < '199903'"), ["seg"], "month", ["x"]), df.filter("x >= 50 and month >= '199903'"), ["seg"], "month", ["x"])
    assert rows(parts) == rows(TT.running_totals(df.filter("x < 50 or x >= 50 and month >= '199903' or month < '199903'"), ["seg"], "month", ["x"]))
