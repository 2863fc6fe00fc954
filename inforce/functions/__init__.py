"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from inforce.functions.columns import (  # noqa: F401
    as_date,
    date_literal,
    date_from_yyyymmdd,
    days_between,
    div0,
    earned_exposure,
    month_key,
    money,
    month_start,
    pct_diff_signed,
    pct_diff_symmetric,
    ratio,
    round_half_up,
)
from inforce.functions.bands import band_expr  # noqa: F401
