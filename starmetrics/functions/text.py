"""Number-to-text helpers that give the same text in Spark and in SQL.

Rounding happens on integers (``round`` of an exact ratio, half away from
zero in both engines), formatting is plain concatenation, so labels do not
depend on a locale or on a float formatter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed1(tenths: Column) -> Column:
    """Integer tenths → 'd.d' text (sign kept)."""
    t = tenths.cast("bigint")
    a = F.abs(t)
    return F.concat(F.when(t < 0, F.lit("-")).otherwise(F.lit("")),
                    (a / 10).cast("bigint").cast("string"), F.lit("."), (a % 10).cast("string"))


def pct1(ratio: Column) -> Column:
    """Ratio → '12.3%' (FORMAT "0.0%")."""
    return F.concat(fixed1(F.round(ratio * 1000)), F.lit("%"))


def pct0(ratio: Column) -> Column:
    """Ratio → '12%' (FORMAT "0%")."""
    return F.concat(F.round(ratio * 100).cast("bigint").cast("string"), F.lit("%"))


def thousands(x: Column) -> Column:
    """Integer → '1,234,567' (FORMAT "#,0")."""
    return F.format_number(x.cast("bigint"), 0)


# SQL (DuckDB) twins of the helpers above -------------------------------------------------
def sql_fixed1(tenths: str) -> str:
    t = f"CAST({tenths} AS BIGINT)"
    return (f"(CASE WHEN {t} < 0 THEN '-' ELSE '' END || CAST(abs({t}) // 10 AS VARCHAR) || '.' || "
            f"CAST(abs({t}) % 10 AS VARCHAR))")


def sql_pct1(ratio: str) -> str:
    return f"({sql_fixed1(f'round(({ratio}) * 1000)')} || '%')"


def sql_pct0(ratio: str) -> str:
    return f"(CAST(CAST(round(({ratio}) * 100) AS BIGINT) AS VARCHAR) || '%')"


def sql_thousands(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def usd_label(net_c: Column) -> Column:
    """Ba-23: magnitude label of a USD amount given in cents."""
    a = F.abs(net_c)
    return (F.when(a >= 100_000_000_000, F.concat(fixed1(F.round(net_c / 1e10)), F.lit(" MM USD")))
            .when(a >= 100_000_000, F.concat(fixed1(F.round(net_c / 1e7)), F.lit(" M USD")))
            .when(a >= 100_000, F.concat(F.round(net_c / 1e5).cast("bigint").cast("string"), F.lit(" k USD")))
            .otherwise(F.concat(F.round(net_c / 1e2).cast("bigint").cast("string"), F.lit(" USD"))))


def sql_usd_label(c: str) -> str:
    return (f"CASE WHEN abs({c}) >= 100000000000 THEN {sql_fixed1(f'round({c} / 1e10)')} || ' MM USD' "
            f"WHEN abs({c}) >= 100000000 THEN {sql_fixed1(f'round({c} / 1e7)')} || ' M USD' "
            f"WHEN abs({c}) >= 100000 THEN CAST(CAST(round({c} / 1e5) AS BIGINT) AS VARCHAR) || ' k USD' "
            f"ELSE CAST(CAST(round({c} / 1e2) AS BIGINT) AS VARCHAR) || ' USD' END")
