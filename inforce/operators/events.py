"""Event-log cohorts and id-list normalisation.

Each row is handled on its own (filters, ``split`` + ``explode``); the only
shuffles are the final ``distinct`` / ``groupBy`` on the id, which aggregate
map-side first. The session-level variant is a semi join on the session key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --------------------------------------------------------------------------- W31
def event_cohort(events: DataFrame, base: Column, qualifying: Column, id_col: str = "policy_num",
                 day_col: str = "event_day") -> DataFrame:
    """Distinct (id, day) of rows passing ``base`` filters that are qualifying events."""
    return events.filter(base & qualifying).select(id_col, day_col).distinct()


def session_cohort(events: DataFrame, base: Column, qualifying: Column, session_col: str = "session_id",
                   id_col: str = "policy_num", day_col: str = "event_day") -> DataFrame:
    """Distinct (id, day) of *all* events in sessions that contain a qualifying
    event (semi join on the session id)."""
    sessions = events.filter(base & qualifying).select(session_col)
    return events.filter(base).join(sessions, session_col, "left_semi").select(id_col, day_col).distinct()


# --------------------------------------------------------------------------- W32
def id_rows(df: DataFrame, col: str = "policy_num", day_col: str = "event_day", id_len: int = 11,
            quote_marks: tuple[str, ...] = ("ph", "pa")) -> DataFrame:
    """Per-row part of the id clean-up: one explode, so the input is read once.

    Short values (length <= id_len + 1) keep their first ``id_len`` characters
    (drops a stray trailing comma); longer ones are split on ',', trimmed, and
    parts that look like quote ids are dropped; blank ids are removed."""
    v = F.col(col)
    raw = F.split(v, ",")

    def no_quote(p: Column) -> Column:
        keep = F.lit(True)
        for q in quote_marks:
            keep &= ~p.contains(q)
        return keep

    listed = F.transform(F.filter(raw, no_quote), lambda p: F.trim(p))
    ids = F.when(F.length(v) <= id_len + 1, F.array(F.substring(v, 1, id_len))).when(F.length(v) > id_len + 1, listed)
    return df.select(F.explode(ids).alias("pol_id"), day_col).filter(F.col("pol_id") != "")


def normalize_id_list(df: DataFrame, col: str = "policy_num", day_col: str = "event_day", id_len: int = 11,
                      quote_marks: tuple[str, ...] = ("ph", "pa")) -> DataFrame:
    """Clean a free-text id field into distinct (id, day) rows, blanks removed."""
    return id_rows(df, col, day_col, id_len, quote_marks).distinct()


def latest_day_per_id(ids: DataFrame, day_col: str = "event_day", label_fmt: str = "MMM-yyyy") -> DataFrame:
    """Latest event day per id. The real date is aggregated and only then
    formatted: MAX over a 'MON-YYYY' label would compare alphabetically."""
    g = ids.groupBy("pol_id").agg(F.max(day_col).alias(day_col))
    return g.withColumn("event_month", F.upper(F.date_format(day_col, label_fmt)))
