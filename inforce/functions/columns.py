"""Scalar helpers shared by the operators.

Every helper returns a ``Column`` made of built-in functions only, so the
expressions stay inside whole-stage codegen. Null and zero handling is
explicit because Spark runs with ANSI mode on (division by zero raises).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x: ColumnLike) -> Column:
    """Timestamp/string -> DATE (driver tables carry midnight timestamps)."""
    return F.to_date(_c(x))


def date_literal(text: str, fmt: str = "ddMMMyyyy") -> Column:
    """A date written as text in the worksheets (e.g. '01Jul2024'), parsed explicitly
    instead of relying on an implicit string-to-date conversion."""
    return F.to_date(F.lit(text), fmt)


def date_from_yyyymmdd(x: ColumnLike) -> Column:
    """Integer- or string-coded ``yyyymmdd`` -> DATE; 0, '' and NULL mean "none"."""
    s = _c(x).cast("string")
    return F.when(s.isNull() | s.isin("0", ""), F.lit(None).cast("date")).otherwise(
        F.to_date(s, "yyyyMMdd")
    )


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Day count ``later - earlier`` as INT (``date - date`` is an interval in Spark)."""
    return F.datediff(_c(later), _c(earlier))


def money(x: ColumnLike, scale: int = 2) -> Column:
    """Exact money column: plain amounts at 2 places, products of two amounts at 4."""
    return _c(x).cast(f"decimal(18,{scale})")


def ratio(num: ColumnLike, den: ColumnLike, digits: int | None = 6) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (SQL ``x / NULLIF(y, 0)``)."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    r = F.when(d == 0, F.lit(None).cast("double")).otherwise(n / d)
    return F.round(r, digits) if digits is not None else r


def round_half_up(x: ColumnLike, digits: int) -> Column:
    """Half-up rounding written out as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Built-in ``round`` implementations disagree on doubles that sit on (or one
    ulp beside) a decimal half; this form is the same IEEE arithmetic in every
    engine, so results are reproducible across engines."""
    v = _c(x).cast("double")
    scale = float(10 ** digits)
    return F.signum(v) * F.floor(F.abs(v) * scale + 0.5).cast("double") / scale


def div0(num: ColumnLike, den: ColumnLike) -> Column:
    """Warehouse ``DIV0``: 0 when den is 0, else num / den (NULL stays NULL)."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def no_negative_zero(x: ColumnLike) -> Column:
    """-0.0 -> 0.0 (rounding a tiny negative gives -0.0 in some engines, 0.0 in others)."""
    c = _c(x)
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def pct_diff_signed(base: ColumnLike, other: ColumnLike, digits: int = 4) -> Column:
    """(other - base) / base * 100; NULL when base is 0."""
    b = _c(base).cast("double")
    o = _c(other).cast("double")
    return no_negative_zero(F.round(F.when(b == 0, F.lit(None).cast("double")).otherwise((o - b) / b * 100.0), digits))


def pct_diff_symmetric(a: ColumnLike, b: ColumnLike, digits: int = 4) -> Column:
    """|a - b| / ((a + b) / 2) * 100; NULL when a + b is 0."""
    x = _c(a).cast("double")
    y = _c(b).cast("double")
    return F.round(
        F.when((x + y) == 0, F.lit(None).cast("double")).otherwise(F.abs(x - y) / ((x + y) / 2.0) * 100.0),
        digits,
    )


def month_key(d: ColumnLike) -> Column:
    """DATE/TIMESTAMP -> 'yyyyMM' text; lexical order equals time order."""
    return F.date_format(_c(d), "yyyyMM")


def month_start(yyyymm: ColumnLike) -> Column:
    """'yyyyMM' -> first day of that month as DATE."""
    return F.to_date(F.concat(_c(yyyymm), F.lit("01")), "yyyyMMdd")


def earned_exposure(yyyymm: ColumnLike) -> Column:
    """One policy-month of exposure: days in the month / days in that month's year."""
    d = month_start(yyyymm)
    days_in_month = F.dayofmonth(F.last_day(d)).cast("double")
    days_in_year = F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31))).cast("double")
    return days_in_month / days_in_year


def null_safe_parts(c: Column, dtype) -> tuple[Column, Column]:
    """(is-null flag, value with NULL replaced by a typed default): together an
    injective, never-NULL stand-in for ``c``, so NULL keys group and join like
    any other value in plain equi-joins."""
    from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

    if isinstance(dtype, StringType):
        default = F.lit("")
    elif isinstance(dtype, NumericType):
        default = F.lit(0).cast(dtype)
    elif isinstance(dtype, BooleanType):
        default = F.lit(False)
    elif isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        default = F.lit("1970-01-01").cast(dtype)
    else:
        default = F.lit(None).cast(dtype)
    return c.isNull(), F.coalesce(c, default)
