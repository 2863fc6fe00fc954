"""Banding rules -> one ``CASE WHEN`` column.

A rule is a dict with a ``label`` and any of:
  ``lo`` / ``hi``            numeric bounds (``lo_incl`` / ``hi_incl`` default True / False)
  ``isin``                   list of category values
  ``eq``                     a single value
  ``is_null``                True to match NULL input
  ``and_`` (list of rules on other columns given as ``(col, rule)``) for 2-D bands

SQL scripts bin first-match-wins; the pandas notebooks assign masks in
sequence, so the *last* matching mask wins. ``first_match`` selects which.
Unmatched rows get ``default`` (NULL unless given).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _predicate(col: Column, rule: dict) -> Column:
    conds: list[Column] = []
    if rule.get("is_null"):
        conds.append(col.isNull())
    if "lo" in rule and rule["lo"] is not None:
        conds.append(col >= rule["lo"] if rule.get("lo_incl", True) else col > rule["lo"])
    if "hi" in rule and rule["hi"] is not None:
        conds.append(col <= rule["hi"] if rule.get("hi_incl", False) else col < rule["hi"])
    if "isin" in rule:
        conds.append(col.isin(list(rule["isin"])))
    if "eq" in rule:
        conds.append(col == F.lit(rule["eq"]))
    for other_col, other_rule in rule.get("and_", []):
        conds.append(_predicate(F.col(other_col) if isinstance(other_col, str) else other_col, other_rule))
    if not conds:
        return F.lit(True)
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def band_expr(col: Column | str, rules: Sequence[dict], default=None, first_match: bool = True) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    ordered = list(rules) if first_match else list(reversed(rules))
    expr = None
    for rule in ordered:
        pred = _predicate(c, rule)
        expr = F.when(pred, F.lit(rule["label"])) if expr is None else expr.when(pred, F.lit(rule["label"]))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def band_sql(col: str, rules: Sequence[dict], default=None, first_match: bool = True) -> str:
    """The same rule list rendered as a SQL ``CASE`` (used by the SQL oracles)."""

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    def pred(c: str, rule: dict) -> str:
        conds = []
        if rule.get("is_null"):
            conds.append(f"{c} IS NULL")
        if rule.get("lo") is not None:
            conds.append(f"{c} {'>=' if rule.get('lo_incl', True) else '>'} {lit(rule['lo'])}")
        if rule.get("hi") is not None:
            conds.append(f"{c} {'<=' if rule.get('hi_incl', False) else '<'} {lit(rule['hi'])}")
        if "isin" in rule:
            conds.append(f"{c} IN ({', '.join(lit(v) for v in rule['isin'])})")
        if "eq" in rule:
            conds.append(f"{c} = {lit(rule['eq'])}")
        for oc, orule in rule.get("and_", []):
            conds.append(pred(oc, orule))
        return "(" + " AND ".join(conds) + ")" if conds else "TRUE"

    ordered = list(rules) if first_match else list(reversed(rules))
    parts = [f"WHEN {pred(col, r)} THEN {lit(r['label'])}" for r in ordered]
    return "CASE " + " ".join(parts) + f" ELSE {lit(default)} END"
