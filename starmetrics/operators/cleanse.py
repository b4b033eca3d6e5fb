"""Cleansing operators C-1 … C-19 of the sell-in line table and its dimensions.

Every operator is a DataFrame → DataFrame transformation; counters for the
data-quality registry are computed separately in one pass (``quality.py``)
instead of one job per rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmetrics.functions.exprs import parse_mixed_date, safe_div, usd_cents

UNKNOWN_CARRIER = -1   # unknown-member key (the test tables use 0..N-1 for real carriers)
#: Why a line is left out of the clean lines.
REJECTED = ("cliente sin maestro", "sin tipo de cambio")
OUTLIER_FACTOR = 25


def with_parsed_date(df: DataFrame, text_col: str = "fecha_texto", out: str = "fecha") -> DataFrame:
    """C-1: mixed-format text date → DATE (NULL when neither format parses)."""
    return df.withColumn(out, parse_mixed_date(text_col))


def drop_unparsed(df: DataFrame, date_col: str = "fecha") -> DataFrame:
    """C-2: drop lines whose date did not resolve (counted by Q-1)."""
    return df.filter(F.col(date_col).isNotNull())


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """C-3: keep the first row per key under an explicit total order (D14).

    ``row_number() == 1`` lets Spark insert a partial *WindowGroupLimit* before
    the shuffle, so a hot key is cut to one row per map task before it moves.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def mark_first(df: DataFrame, keys: list[str], order: list[str | Column], date_col: str = "fecha", out: str = "_first") -> DataFrame:
    """C-2 and C-3 as a flag: true for the rows that ``dedup_first`` keeps of ``drop_unparsed``.  No row is lost, so one
    written table serves the raw and the deduplicated lines; rows already partitioned by some of ``keys`` don't move."""
    parsed = F.col(date_col).isNotNull()
    w = Window.partitionBy(*keys, parsed).orderBy(*order)
    return df.withColumn(out, parsed & (F.row_number().over(w) == 1))


def classify_credit_notes(df: DataFrame, amount_cols: list[str], units_col: str = "unidades",
                          money_col: str = "importe_local_c") -> DataFrame:
    """C-4 / C-5: negative amount or units → credit note ``NC`` (else ``FC``);
    the listed columns become absolute and ``signo`` carries the sign."""
    neg = (F.col(money_col) < 0) | (F.col(units_col) < 0)
    out = (df.withColumn("tipo_documento", F.when(neg, F.lit("NC")).otherwise(F.lit("FC")))
           .withColumn("signo", F.when(neg, F.lit(-1)).otherwise(F.lit(1))))
    return out.withColumns({c: F.abs(F.col(c)) for c in amount_cols})


def outlier_limits(df: DataFrame, key: str = "id_producto", value: str = "unidades", factor: int = OUTLIER_FACTOR) -> DataFrame:
    """(key, ``_limit``) of the keys with a value above factor × max(median of the key, 1): only these have outliers.

    The median is an exact ``percentile`` aggregate per key (partial aggregation
    keeps one value→count map per key and task, so a hot key does not sit in one
    task).
    """
    limit = F.lit(factor) * F.greatest(F.percentile(F.col(value), 0.5), F.lit(1.0))
    return (df.groupBy(key).agg(limit.alias("_limit"), F.max(value).alias("_top"))
            .filter((F.col("_top") > F.col("_limit")) & F.col(key).isNotNull()).select(key, "_limit"))


def flag_outliers(df: DataFrame, key: str = "id_producto", value: str = "unidades",
                  factor: int = OUTLIER_FACTOR, out: str = "flag_revision", limits: DataFrame | None = None) -> DataFrame:
    """C-6: value > factor × max(median of the key, 1) → flag 1 (flagged, never corrected); a row without a key counts
    against ``factor``.  ``limits``: a written table of ``outlier_limits``, whose size the planner then knows; its lowest
    limit then tells which rows can be over theirs, and only those meet the limits.
    """
    def flag(rows: DataFrame, over: Column) -> DataFrame:
        over = F.when(F.col(key).isNull(), F.col(value) > factor).otherwise(F.coalesce(over, F.lit(False)))
        return rows.withColumn(out, F.when(F.col(value).isNotNull(), over).cast("int"))

    if limits is None:
        return flag(df.join(outlier_limits(df, key, value, factor), key, "left"), F.col(value) > F.col("_limit")).drop("_limit")
    low = limits.agg(F.min("_limit")).first()[0]
    high = F.lit(False) if low is None else F.coalesce(F.col(key).isNotNull() & (F.col(value) > low), F.lit(False))
    met = flag(df.filter(high).join(limits, key, "left"), F.col(value) > F.col("_limit")).drop("_limit")
    return met.unionByName(flag(df.filter(~high), F.lit(False)))


def impute_unknown(df: DataFrame, c: str = "id_transportista", unknown: int = UNKNOWN_CARRIER) -> DataFrame:
    """C-7: NULL key → unknown member."""
    return df.withColumn(c, F.coalesce(F.col(c), F.lit(unknown)).cast("int"))


def with_month(df: DataFrame, date_col: str = "fecha", out: str = "fecha_mes") -> DataFrame:
    """C-8: first day of the month."""
    return df.withColumn(out, F.trunc(F.col(date_col), "MM"))


def convert_fx(df: DataFrame, rates: DataFrame, pairs: list[tuple[str, str]],
               keys: tuple[str, str] = ("anio_mes", "moneda"), rate_col: str = "tc_x100") -> DataFrame:
    """C-9: convert local cents to USD cents at the rate of the operation month.

    Inner join = lines without a rate are dropped (Q-6 counts them).  The rate
    table is months × currencies; AQE turns the join into a broadcast once the
    runtime size of that side is measured below the threshold.
    """
    out = df.join(rates.select(*keys, rate_col), list(keys), "inner")
    for local, usd in pairs:
        out = out.withColumn(usd, usd_cents(local, rate_col))
    return out


def normalise_key(df: DataFrame, c: str) -> DataFrame:
    """C-10: TRIM + UPPER of a business key."""
    return df.withColumn(c, F.upper(F.trim(F.col(c))))


def impute_median(df: DataFrame, value: str, group: str, flag: str) -> DataFrame:
    """C-11: NULL → median of its group → global median; ``flag`` marks imputed rows.

    Medians are aggregates (per group, and a one-row global) joined back.
    """
    g = df.groupBy(group).agg(F.percentile(F.col(value), 0.5).alias("_gmed"))
    glob = df.agg(F.percentile(F.col(value), 0.5).alias("_allmed"))
    return (df.join(g, group, "left").crossJoin(glob)
            .withColumn(flag, F.col(value).isNull().cast("int"))
            .withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("_gmed"), F.col("_allmed")))
            .drop("_gmed", "_allmed"))


def with_std_margin(df: DataFrame, cost: str = "costo_std_c", price: str = "precio_lista_c",
                    out: str = "margen_std_pct") -> DataFrame:
    """C-12: 1 − cost/price; zero price → NULL."""
    return df.withColumn(out, F.lit(1.0) - safe_div(cost, price))


def drop_latent(df: DataFrame) -> DataFrame:
    """C-16: drop latent / leaking columns (names starting with ``_``)."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def narrow_types(df: DataFrame) -> DataFrame:
    """C-18: cast each integral column to the smallest type holding its range.

    One aggregate pass over all integral columns returns (min, max) pairs; the
    cast plan is decided on the driver from those few numbers.
    """
    ints = [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("long", "integer", "short", "byte")]
    if not ints:
        return df
    aggs = []
    for c in ints:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    out = df
    for c in ints:
        lo, hi = row[f"{c}__min"], row[f"{c}__max"]
        if lo is None:
            continue
        for t, (a, b) in (("tinyint", (-128, 127)), ("smallint", (-32768, 32767)),
                          ("int", (-2**31, 2**31 - 1))):
            if a <= lo and hi <= b:
                out = out.withColumn(c, F.col(c).cast(t))
                break
    return out


def column_profile(df: DataFrame) -> DataFrame:
    """C-19: per column rows, distinct values and nulls, in one aggregate, stacked to rows."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        aggs += [F.count_distinct(F.col(c)).alias(f"{c}__nd"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}__nn")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', CAST(`{c}__nd` AS BIGINT), CAST(`{c}__nn` AS BIGINT)" for c in cols)
    return wide.selectExpr("CAST(__rows AS BIGINT) AS filas",
                           f"stack({len(cols)}, {stack}) AS (columna, distintos, nulos)")
