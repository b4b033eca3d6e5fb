"""Column-expression helpers (all JVM-side built-ins, no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mixed_date(c: str | Column) -> Column:
    """C-1: ``yyyy-MM-dd`` first, then ``dd/MM/yyyy``, else NULL."""
    s = F.trim(col(c))
    return F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(s, F.lit("dd/MM/yyyy")),
    ).cast("date")


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Safe division: by zero or NULL → NULL (a blank, never an error), as DOUBLE."""
    return F.try_divide(col(a).cast("double"), F.nullif(col(b).cast("double"), F.lit(0.0)))


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """C-20: clip to bounds."""
    x = col(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def usd_cents(local_c: str | Column, tc_x100: str | Column) -> Column:
    """C-9: local cents → USD cents at the month's rate (rate in local cents per USD x100)."""
    return F.round(F.abs(col(local_c)).cast("bigint").cast("double") * F.lit(100.0)
                   / col(tc_x100).cast("double")).cast("bigint")


def month_int(d: str | Column) -> Column:
    """yyyymm as INT."""
    return (F.year(col(d)) * 100 + F.month(col(d))).cast("int")


def month_index(yyyymm: str | Column) -> Column:
    """yyyymm → months since year 0 (dense month arithmetic)."""
    m = col(yyyymm)
    return (F.floor(m / 100) * 12 + (m % 100) - 1).cast("int")


def index_to_month(idx: str | Column) -> Column:
    i = col(idx)
    return (F.floor(i / 12) * 100 + (i % 12) + 1).cast("int")


def logit(p: str | Column) -> Column:
    x = col(p)
    return F.ln(x / (F.lit(1.0) - x))


def inv_logit(z: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def month_sin(m: str | Column) -> Column:
    """C-26 cyclical month encoding."""
    return F.sin(F.lit(2 * math.pi) * col(m).cast("double") / F.lit(12.0))


def month_cos(m: str | Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * col(m).cast("double") / F.lit(12.0))


def round_sig(c: str | Column, digits: int = 6) -> Column:
    """Round a double to ``digits`` decimals (for order-dependent double sums)."""
    return F.round(col(c), digits)


def selected_value(c: str | Column, default: str) -> Column:
    """SELECTEDVALUE / E-4 as an aggregate: the single value, else default.  One value is its own least and greatest; a
    distinct count would give every row once more for each such column."""
    x = col(c)
    return F.when(F.min(x) == F.max(x), F.max(x).cast("string")).otherwise(F.lit(default))
