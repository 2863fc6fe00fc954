"""Registered web-event cohort, id-list and line-stacking queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import events as EV
from inforce.operators import linkage as LK
from inforce.operators import persistency as P
from inforce.operators import selection as SEL
from inforce.plans.persistency_plans import flags_sql
from inforce.plans.registry import deliver_as_double, register
from inforce.plans.shared import LATEST, LATEST_PERS_SQL, _sql, latest_pers
from inforce.sources import lines as LN
from inforce.sources import staging as S


# ----------------------------------------------------------------------------- W31 / W32 / W33
EVENT_FROM = dt.date(2024, 1, 10)
SESSION_WINDOW = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))


def _base(from_day=None, window=None):
    c = (F.col("web_site_identifier") == LN.SITE) & (F.col("internal_traffic") == "false") & (
        F.col("app_user_access_role") == "consumer"
    )
    if from_day is not None:
        c = c & (F.col("event_day") >= F.lit(from_day))
    if window is not None:
        c = c & F.col("event_day").between(F.lit(window[0]), F.lit(window[1]))
    return c


def _qual():
    return (F.col("event_id").isin(LN.QUALIFYING_EVENTS) | (F.col("page_name") == LN.QUALIFYING_PAGE)
            | (F.col("event_detail") == LN.QUALIFYING_DETAIL))
_BASE_SQL = f"web_site_identifier = '{LN.SITE}' AND internal_traffic = 'false' AND app_user_access_role = 'consumer'"
_QUAL_SQL = (f"(event_id IN ({', '.join(repr(x) for x in LN.QUALIFYING_EVENTS)}) OR page_name = '{LN.QUALIFYING_PAGE}' "
             f"OR event_detail = '{LN.QUALIFYING_DETAIL}')")
_WIN_SQL = f"event_day BETWEEN DATE '{SESSION_WINDOW[0]}' AND DATE '{SESSION_WINDOW[1]}'"


@register(
    "w31_event_cohort",
    _sql(
        f"SELECT DISTINCT policy_num, event_day FROM web_events WHERE {_BASE_SQL} AND event_day >= DATE '{EVENT_FROM}' AND {_QUAL_SQL}",
        [LN.WEB_EVENTS_SQL], base=(),
    ),
)
def w31_event_cohort(spark, d):
    return EV.event_cohort(LN.web_events(spark, d), _base(from_day=EVENT_FROM), _qual())


# sessions are marked over their own events, then the marked ones' events listed
SESSION_SQL = f"""session_events AS (
  SELECT DISTINCT policy_num, event_day FROM (
    SELECT policy_num, event_day, session_id, bool_or(COALESCE({_QUAL_SQL}, FALSE)) OVER (PARTITION BY session_id) AS marked
    FROM web_events WHERE {_BASE_SQL} AND {_WIN_SQL}
  ) WHERE marked AND session_id IS NOT NULL
)"""


@register("w31_session_cohort", _sql("SELECT policy_num, event_day FROM session_events", [LN.WEB_EVENTS_SQL, SESSION_SQL], base=()))
def w31_session_cohort(spark, d):
    return EV.session_cohort(LN.web_events(spark, d), _base(window=SESSION_WINDOW), _qual())


NORMALIZE_SQL = """ids AS (
  SELECT DISTINCT pol_id, event_day
  FROM (
    SELECT event_day, unnest(
      CASE WHEN length(policy_num) > 12
           THEN [trim(part) FOR part IN string_split(policy_num, ',') IF NOT (contains(part, 'ph') OR contains(part, 'pa'))]
           ELSE [left(policy_num, 11)] END) AS pol_id
    FROM session_events WHERE policy_num IS NOT NULL)
  WHERE pol_id <> '')"""


def session_ids(spark, d):
    return EV.normalize_id_list(w31_session_cohort(spark, d))


@register("w32_normalize_id_list", _sql("SELECT pol_id, event_day FROM ids", [LN.WEB_EVENTS_SQL, SESSION_SQL, NORMALIZE_SQL], base=()))
def w32_normalize_id_list(spark, d):
    return session_ids(spark, d)


LATEST_DAY_SQL = "latest_day AS (SELECT pol_id, MAX(event_day) AS event_day FROM ids GROUP BY pol_id)"


@register(
    "w32_latest_day_per_id",
    _sql("SELECT pol_id, event_day, upper(strftime(event_day, '%b-%Y')) AS event_month FROM latest_day",
         [LN.WEB_EVENTS_SQL, SESSION_SQL, NORMALIZE_SQL, LATEST_DAY_SQL], base=()),
)
def w32_latest_day_per_id(spark, d):
    return EV.latest_day_per_id(session_ids(spark, d))


STACK_COLS = {
    "pol_type": ("pol_type", "pol_type"),
    "pol_eff_dt": ("pol_eff_dt", "pol_eff_dt"),
    "atr_e_flat": ("atr_e_flat", "atr_e_flat"),
    "atr_e_30": ("atr_e_30", "atr_e_30"),
    "atr_e_60": ("atr_e_60", "atr_e_60"),
    "atr_e_90": ("atr_e_90", "atr_e_90"),
    "atr_e_180": ("atr_e_180", "atr_e_180"),
    "atr_e_365": (None, "atr_e_365"),
    "cancel_flag": ("cancel_flag", "cancel_flag"),
    "cancel_e_flat": ("cancel_e_flat", "cancel_e_flat"),
    "cancel_e_30": ("cancel_e_30", "cancel_e_30"),
    "cancel_e_60": ("cancel_e_60", "cancel_e_60"),
    "cancel_e_90": ("cancel_e_90", "cancel_e_90"),
    "cancel_e_365": (None, "cancel_e_365"),
}


def _padded(df, label):
    return df.withColumn("pol_id", F.lpad("pol_id", 11, "0")).withColumn("pol_type", F.lit(label))


def stacked_lines(spark, d):
    cohort = EV.latest_day_per_id(session_ids(spark, d)).select("pol_id", "event_day")
    auto = _padded(latest_pers(spark, d), "Auto")
    home_flags = P.development_flags(LN.home_policy(spark, d), S.AS_OF)
    home = _padded(SEL.latest_by_key(home_flags, ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"]), "Home")
    return LK.stack_lines(cohort, auto, home, STACK_COLS)


def _stack_sql():
    """One union of both lines, the first line's values before the other's; a column
    that only one line has is NULL in the other."""
    picks = ", ".join(f"first({o} ORDER BY line) FILTER ({o} IS NOT NULL) AS {o}" for o in STACK_COLS)
    lines = []
    for no, (label, src) in enumerate((("Auto", "latest_pers"), ("Home", "home_latest"))):
        cols = ", ".join((f"'{label}'" if o == "pol_type" else pair[no] or "NULL") + f" AS {o}" for o, pair in STACK_COLS.items())
        lines.append(f"SELECT lpad(pol_id, 11, '0') AS pol_id, {no} AS line, {cols} FROM {src}")
    return f"""SELECT d.pol_id, d.event_day, {", ".join("u." + o for o in STACK_COLS)}
FROM latest_day d JOIN (
  SELECT pol_id, {picks} FROM ({" UNION ALL ".join(lines)}) GROUP BY pol_id
) u USING (pol_id)"""


@register(
    "w33_stack_lines",
    _sql(
        _stack_sql(),
        [LN.WEB_EVENTS_SQL, SESSION_SQL, NORMALIZE_SQL, LATEST_DAY_SQL, flags_sql(), LATEST_PERS_SQL, LN.HOME_POLICY_SQL,
         flags_sql("home_policy", "home_pers"),
         f"home_latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} AS rn FROM home_pers) WHERE rn = 1)"],
    ),
)
def w33_stack_lines(spark, d):
    return stacked_lines(spark, d)


deliver_as_double("w33_stack_lines", ("atr_e_365", "cancel_e_365"))
