"""Operators against plain-Python brute force on random inputs with NULLs,
ties and edge values (the driver tables have no NULLs, so the oracle check
cannot exercise these paths)."""

import datetime as dt
import random

import pytest

from inforce.operators import events as EV
from inforce.operators import persistency as P
from inforce.operators import selection as SEL

AS_OF = dt.date(2024, 6, 30)


def _rand_date(rnd, lo=dt.date(2022, 1, 1), span=1000, p_null=0.1):
    return None if rnd.random() < p_null else lo + dt.timedelta(days=rnd.randrange(span))


@pytest.mark.parametrize("seed", [1, 2])
def test_development_flags_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(200):
        eff = _rand_date(rnd, p_null=0.0)
        canc = None if rnd.random() < 0.4 else eff + dt.timedelta(days=rnd.choice([0, 1, 29, 30, 31, 364, 365, 366, rnd.randrange(-30, 500)]))
        ctrans = None if canc is None else canc + dt.timedelta(days=rnd.randrange(-60, 10))
        rows.append((str(i), i, eff, canc, ctrans))
    df = spark.createDataFrame(rows, "pol_id string, pol_prd_id int, pol_eff_dt date, canc_eff_dt date, canc_trans_dt date")
    got = {r.pol_prd_id: r.asDict() for r in P.development_flags(df, AS_OF).collect()}
    for _, i, eff, canc, ctrans in rows:
        g = got[i]
        de = (AS_OF - eff).days
        dc = None if canc is None else (canc - eff).days
        assert g["num_days_eff"] == de and g["num_days_canc"] == (-1 if canc is None else dc)
        assert g["cancel_flag"] == (0 if canc is None or dc == 365 else 1)
        assert g["cancel_e_flat"] == int(canc is not None and dc <= 0 and AS_OF >= eff)
        for n in P.DEV_DAYS:
            assert g[f"cancel_e_{n}"] == int(canc is not None and dc <= n and de >= n)
            assert g[f"atr_e_{n}"] == int(de >= n)
        assert g["cancel_e_365"] == int(canc is not None and dc < 365 and de >= 365)
        for n in P.PRE_DAYS:
            assert g[f"atr_pre_{n}"] == (1 if de >= -n else None)
            want = 1 if (de >= -n and canc is not None and (ctrans - canc).days <= -n and canc == eff) else None
            assert g[f"canc_pre_{n}"] == want


@pytest.mark.parametrize("seed", [3, 4])
def test_term_history_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(150):
        pol = rnd.choice(["hot"] * 6 + ["a", "b", "c"])
        eff = _rand_date(rnd, p_null=0.05)
        prem = rnd.choice([None, 0.0, 100.0, 95.0, 110.0, 120.0, 80.0])
        rows.append((pol, i, eff, prem, rnd.choice(["N", "R"]), rnd.choice(["A", "B", None]), rnd.choice([0, 1, None])))
    df = spark.createDataFrame(
        rows, "pol_id string, pol_prd_id int, pol_eff_dt date, prem double, new_rnw_cd string, rate_plan_cd string, cancel_flag int"
    )
    for bucket in (None, "year"):
        from pyspark.sql import functions as F

        b = F.year("pol_eff_dt") if bucket else None
        got = {r.pol_prd_id: r for r in P.term_history(df, compare=["rate_plan_cd"], acct_cr=None, bucket=b).collect()}
        by_pol = {}
        for r in rows:
            by_pol.setdefault(r[0], []).append(r)
        for terms in by_pol.values():
            terms.sort(key=lambda r: (r[2] is not None, r[2] or dt.date.min, r[1]))  # nulls first
            for idx, r in enumerate(terms):
                g = got[r[1]]
                prev1 = terms[idx - 1] if idx >= 1 else None
                prev2 = terms[idx - 2] if idx >= 2 else None
                p1 = (prev1[3] if prev1 and prev1[3] is not None else 0.0)
                p2 = (prev2[3] if prev2 and prev2[3] is not None else 0.0)
                assert g.prev_term_prem == p1 and g.prev_two_term_prem == p2
                assert g.prev_rate_plan_cd == (prev1[5] if prev1 else None)
                assert g.same_rate_plan_cd_ind == int(prev1 is not None and r[5] is not None and r[5] == prev1[5])
                lc = prev1[6] if prev1 else None
                assert g.prior_term_canc_ind == (None if lc is None else str(lc))
                if r[4] == "N" or p1 == 0 or r[3] is None:
                    assert g.renewal_prem_change is None
                else:
                    assert g.renewal_prem_change == pytest.approx(round(r[3] / p1 - 1.0, 6))


def _normalize(rows, id_len=11):
    out = set()
    for pn, day in rows:
        if pn is None:
            continue
        if len(pn) <= id_len + 1:
            v = pn[:id_len]
            if v != "":
                out.add((v, day))
        else:
            for part in pn.split(","):
                if "ph" in part or "pa" in part:
                    continue
                v = part.strip()
                if v != "":
                    out.add((v, day))
    return out


def test_normalize_id_list_brute_force(spark):
    rnd = random.Random(5)
    ids = ["%011d" % rnd.randrange(10**6) for _ in range(20)]
    rows = []
    for _ in range(300):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(5))
        kind = rnd.randrange(7)
        a, b = rnd.choice(ids), rnd.choice(ids)
        pn = [a, a + ",", "", f"{a}, ph{rnd.randrange(99)}, {b}", f" {a} ,{b},", f"pa1,{a}", None][kind]
        rows.append((pn, day))
    df = spark.createDataFrame(rows, "policy_num string, event_day date")
    got = {(r.pol_id, r.event_day) for r in EV.normalize_id_list(df).collect()}
    assert got == _normalize(rows)


def test_selection_brute_force(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", "c", "d", None]), _rand_date(rnd, span=20, p_null=0.15), i,
             rnd.choice(["C", "T", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "pol_id string, eff date, prd int, arm string")
    # newest per key, NULL dates first when descending, ties broken by prd desc
    got = {r.pol_id: r.prd for r in SEL.latest_by_key(df, ["pol_id"], ["eff"], ["prd"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        grp = [r for r in rows if r[0] == k]
        grp.sort(key=lambda r: (r[1] is None, r[1] or dt.date.min, r[2]), reverse=True)
        want[k] = grp[0][2]
    assert got == want
    # ties kept at the per-key maximum, NULLs never qualify
    got2 = sorted(r.prd for r in SEL.extreme_by_key(df, ["pol_id"], "eff", "max").collect())
    want2 = []
    for k in {r[0] for r in rows}:
        vals = [r[1] for r in rows if r[0] == k and r[1] is not None]
        if vals:
            want2 += [r[2] for r in rows if r[0] == k and r[1] == max(vals)]
    assert got2 == sorted(want2)
    # purity: ids whose rows all map to one arm code (control=1, else 2); NULL ids never kept
    got3 = sorted(r.prd for r in SEL.campaign_purity(df, arm_col="arm").collect())
    want3 = []
    for k in {r[0] for r in rows if r[0] is not None}:
        codes = {1 if r[3] == "C" else 2 for r in rows if r[0] == k}
        if len(codes) == 1:
            want3 += [r[2] for r in rows if r[0] == k]
    assert got3 == sorted(want3)


def test_code_transitions_brute_force(spark):
    rnd = random.Random(7)
    mes = [dt.date(2024, m, 28) for m in range(1, 9)]
    rows = []
    for p in range(40):
        for me in sorted(rnd.sample(mes, rnd.randrange(1, 6))):
            rows.append((f"p{p}", me, rnd.choice(["HO3", "HO5", "0"])))
    snaps = spark.createDataFrame(rows, "policy_id string, me_dt date, pol_form_cd string")
    now_ids = {f"p{p}" for p in range(0, 40, 3)}
    now = spark.createDataFrame([(i,) for i in now_ids], "policy_id string")
    got = {r.policy_id: r for r in P.code_transitions(snaps, now, from_code="HO3", label="HO3").collect()}
    want = {}
    for p in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == p), key=lambda r: r[1])
        changes = [seq[i][1] for i in range(1, len(seq)) if seq[i][2] != seq[i - 1][2]]
        if not changes:
            continue
        ini, cur = seq[0][2], seq[-1][2]
        if ini == "HO3" and cur != "0":
            b = "HO3 to Other"
        elif ini == "HO3" and cur == "0":
            b = "HO3 to Nothing"
        elif cur == "HO3" and ini != "0":
            b = "Other to HO3"
        elif cur == "HO3" and ini == "0":
            b = "Nothing to HO3"
        elif cur == ini:
            b = "Multiple Code Changes"
        else:
            b = "No HO3 in Transition"
        want[p] = (ini, cur, max(changes), int(p not in now_ids), b)
    assert {k: (v.initial_code, v.current_code, v.change_dt, v.cancel_flag, v.bucket) for k, v in got.items()} == want


def test_segment_summary_brute_force(spark):
    from decimal import Decimal

    from inforce.operators import segment as G

    rnd = random.Random(8)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice(["u", "v", "w", None]), rnd.choice([1, None]),
             rnd.choice([None, round(rnd.uniform(0.2, 2.0), 6)])) for _ in range(200)]
    df = spark.createDataFrame(rows, "b1 string, b2 string, c int, m double")
    got = {(r.segmentation, r.band): (r.cnt, r.lrr) for r in G.segment_summary(df, ["b1", "b2"], "c", "m").collect()}
    want = {}
    for i, seg in enumerate(["b1", "b2"]):
        for band in {r[i] for r in rows if r[i] is not None}:
            grp = [r for r in rows if r[i] == band]
            ms = [Decimal(str(r[3])) for r in grp if r[3] is not None]
            mean = None if not ms else float(sum(ms)) / len(ms)
            want[(seg, band)] = (sum(1 for r in grp if r[2] is not None), None if mean is None else round(mean, 6))
    assert got.keys() == want.keys()
    for k, (cnt, lrr) in want.items():
        assert got[k][0] == cnt
        assert (got[k][1] is None and lrr is None) or abs(got[k][1] - lrr) < 1e-6


def _rhu(x, d):
    import math

    if x is None:
        return None
    s = 10.0 ** d
    return math.copysign(1.0, x) * math.floor(abs(x) * s + 0.5) / s if x != 0 else 0.0


def test_allocation_and_update_brute_force(spark):
    from inforce.operators import reconcile as R

    rnd = random.Random(9)
    covs = ["BI", "COLL", "MED", "PIP", "XX"]
    loss_rows = [(rnd.choice(["p", "q"]), rnd.choice([1, 2, 3, None]), rnd.choice(covs), f"2024{rnd.randint(1, 12):02d}",
                  float(rnd.choice([0, 1, 2, 5, 7]))) for _ in range(120)]
    loss = spark.createDataFrame(loss_rows, "pol_id string, pol_prd_id bigint, cov_type_abbr string, earned_month string, ee double")
    model_rows = []
    for prd in (1, 2):
        row = [prd]
        for i, _ in enumerate(R.MODEL_COVERAGES):
            row += [1.37 * (i + 1) * prd, 0.3 + i / 7.0]
        model_rows.append(tuple(row))
    schema = "cv_plcy_period_id bigint, " + ", ".join(f"adj_{c}_pp_pred double, {c}_exposure double" for c in R.MODEL_COVERAGES)
    model = spark.createDataFrame(model_rows, schema)
    mdl = {r[0]: r[1:] for r in model_rows}
    for digits in (None, 4):
        got = sorted((r.pol_id, r.pol_prd_id, r.cov_type_abbr, r.earned_month, r.ee, r.adj_bi_pp, r.adj_mp_pp, r.adj_ttl_pp)
                     for r in R.allocate_prediction(loss, model, digits=digits).collect())
        want = []
        for pol, prd, cov, m, ee in loss_rows:
            if prd not in mdl:
                continue  # inner join with the model (NULL periods never match)
            tot = sum(r[4] for r in loss_rows if (r[0], r[1], r[2]) == (pol, prd, cov))
            share = None if tot == 0 else ee / tot
            vals = {}
            for i, c in enumerate(R.MODEL_COVERAGES):
                code = [k for k, v in R.COVERAGE_MAP.items() if v == c][0]
                v = (share * mdl[prd][2 * i] * mdl[prd][2 * i + 1]) if (cov == code and share is not None) else (None if cov == code else 0.0)
                vals[c] = _rhu(v, digits) if v is not None and digits is not None else v
            # a NULL counts as 0 in the rounded total only
            ttl = None if digits is None and None in vals.values() else sum(vals[c] or 0.0 for c in R.MODEL_COVERAGES)
            want.append((pol, prd, cov, m, ee, vals["bi"], vals["mp"], ttl))
        assert len(got) == len(want)
        gs = sorted(got, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
        ws = sorted(want, key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))
        for g, w in zip(gs, ws):
            assert g[:5] == w[:5]
            for a, b in zip(g[5:], w[5:]):
                assert (a is None and b is None) or abs(a - b) < 1e-9


def test_reconcile_metric_brute_force(spark):
    from decimal import Decimal

    from inforce.operators import reconcile as R

    rnd = random.Random(10)
    left = [(rnd.choice([2020, 2021, 2022]), Decimal(rnd.randint(0, 10000)) / 100) for _ in range(80)]
    right = [(rnd.choice([2020, 2021, 2023]), Decimal(rnd.randint(0, 10000)) / 100) for _ in range(80)]
    lf = spark.createDataFrame(left, "y int, m decimal(18,2)")
    rf = spark.createDataFrame(right, "y int, m decimal(18,2)")
    got = {r._g0: (r.left_total, r.right_total, r.pct_diff) for r in R.reconcile_metric(lf, rf, "m", "m", ["y"]).collect()}
    want = {}
    for y in {r[0] for r in left} & {r[0] for r in right}:
        a = float(sum(r[1] for r in left if r[0] == y))
        b = float(sum(r[1] for r in right if r[0] == y))
        want[y] = (a, b, None if a == 0 else round((b - a) / a * 100.0, 2))
    assert got == want


def test_latest_with_aggs_both_directions_brute_force(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(12)
    rows = [(rnd.choice(["a", "b", "c"]), _rand_date(rnd, span=15, p_null=0.2), i, rnd.randint(0, 50)) for i in range(150)]
    df = spark.createDataFrame(rows, "k string, d date, i int, v int")
    for desc in (True, False):
        got = {r.k: (r.i, r.mx) for r in SEL.latest_with_aggs(df, ["k"], ["d", "i"], ["i"], [F.max("v").alias("mx")],
                                                              descending=desc).collect()}
        ref = {r.k: r.i for r in SEL.latest_by_key(df, ["k"], ["d"], ["i"], descending=desc).collect()}
        mx = {k: max(r[3] for r in rows if r[0] == k) for k in ref}
        assert got == {k: (ref[k], mx[k]) for k in ref}
