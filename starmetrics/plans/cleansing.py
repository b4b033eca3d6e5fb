"""Registered queries of the cleansing operators C-1 … C-27."""

from __future__ import annotations

import math


from pyspark.sql import functions as F

from starmetrics.functions import exprs as X
from starmetrics.operators import cleanse as C
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import sql
from starmetrics.sources import binding as B

# Descriptive labels of boolean attributes (C-13).
LABELS = {
    "conservacion": ("Cadena de frío", "Temperatura ambiente"),
    "origen_costo": ("Costo imputado", "Costo real"),
    "capacidad_frio": ("Con cámara de frío", "Sin cámara de frío"),
    "control_temperatura": ("Con control de frío", "Sin control de frío"),
    "evitabilidad": ("Evitable", "No evitable"),
    "confianza": ("Requiere test controlado", "Dentro de evidencia histórica"),
}

# Seasonal index by therapeutic class letter, months 1..12 (C-22).
SEASONAL_INDEX = {
    "R": [0.80, 0.82, 0.92, 1.05, 1.25, 1.45, 1.50, 1.35, 1.10, 0.92, 0.82, 0.78],
    "J": [0.85, 0.86, 0.95, 1.05, 1.20, 1.35, 1.38, 1.28, 1.08, 0.95, 0.88, 0.83],
    "N": [1.05, 0.95, 1.00, 1.02, 1.00, 0.98, 0.98, 1.00, 1.02, 1.04, 1.02, 0.95],
    "C": [1.00, 0.98, 1.02, 1.00, 1.01, 1.00, 1.00, 1.00, 1.01, 1.02, 1.00, 0.96],
    "A": [1.02, 0.96, 1.00, 1.00, 1.00, 0.99, 0.99, 1.00, 1.01, 1.03, 1.05, 1.10],
    "M": [0.95, 0.94, 1.00, 1.03, 1.05, 1.08, 1.08, 1.05, 1.02, 1.00, 0.97, 0.90],
    "L": [1.00, 1.00, 1.01, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 0.99],
}
IN_SEASON = 1.10                                # a month is in season above this index (C-21)
CLASS_LETTERS = sorted(SEASONAL_INDEX)          # binding: class = letters[p_partkey % 7]
CLASS_EXPR = "element_at(array(" + ", ".join(f"'{c}'" for c in CLASS_LETTERS) + "), CAST(id_producto % 7 AS INT) + 1)"
CLASS_EXPR_DUCK = "list_extract([" + ", ".join(f"'{c}'" for c in CLASS_LETTERS) + "], CAST(id_producto % 7 AS INT) + 1)"


def seasonal_table(spark):
    rows = [(k, i + 1, float(v)) for k, vs in SEASONAL_INDEX.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "clase string, mes_nro int, indice_estacional double")


SEASONAL_SQL = ("SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {i + 1}, CAST({v} AS DOUBLE))" for k, vs in SEASONAL_INDEX.items() for i, v in enumerate(vs))
    + ") t(clase, mes_nro, indice_estacional)")


# ---------------- C-1 / C-2 ----------------
@query("c01_parse_mixed_dates", sql(
    "SELECT id_linea, fecha_texto, CAST(fecha AS VARCHAR) AS fecha FROM parsed", "parsed"))
def c01(spark, sf_dir):
    return model(spark, sf_dir).parsed.select("id_linea", "fecha_texto", F.col("fecha").cast("string").alias("fecha"))


@query("c02_drop_unparsed_dates", sql(
    """SELECT CAST(count(*) AS BIGINT) AS filas_totales,
       CAST(count(*) FILTER (WHERE fecha IS NULL) AS BIGINT) AS sin_fecha,
       CAST(count(*) FILTER (WHERE fecha IS NOT NULL) AS BIGINT) AS filas_validas FROM parsed""", "parsed"))
def c02(spark, sf_dir):
    p = model(spark, sf_dir).parsed
    return p.agg(F.count(F.lit(1)).alias("filas_totales"),
                 F.count_if(F.col("fecha").isNull()).alias("sin_fecha"),
                 F.count_if(F.col("fecha").isNotNull()).alias("filas_validas"))


# ---------------- C-3 ----------------
@query("c03_dedup_first_by_line", sql(
    """SELECT id_linea, CAST(fecha AS VARCHAR) AS fecha, id_producto, unidades, importe_local_c, _l_quantity AS cantidad_original
       FROM dedup""", "dedup"))
def c03(spark, sf_dir):
    return model(spark, sf_dir).deduped.select("id_linea", F.col("fecha").cast("string").alias("fecha"), "id_producto", "unidades",
                                               "importe_local_c", F.col("_l_quantity").alias("cantidad_original"))


# ---------------- C-4 / C-5 ----------------
@query("c04_c05_credit_notes_and_sign", sql(
    """SELECT id_linea, tipo_documento, signo, unidades, importe_local_c, costo_local_c FROM classified""",
    "classified"))
def c04(spark, sf_dir):
    d = C.classify_credit_notes(model(spark, sf_dir).deduped, ["unidades", "importe_local_c", "costo_local_c"])
    return d.select("id_linea", "tipo_documento", "signo", "unidades", "importe_local_c", "costo_local_c")


# ---------------- C-6 ----------------
@query("c06_outlier_flag_vs_sku_median", sql(
    "SELECT id_linea, id_producto, unidades, flag_revision FROM sellin", "sellin"))
def c06(spark, sf_dir):
    return model(spark, sf_dir).sellin.select("id_linea", "id_producto", "unidades", "flag_revision")


# ---------------- C-7 ----------------
@query("c07_null_carrier_to_unknown", sql(
    "SELECT id_transportista, CAST(count(*) AS BIGINT) AS lineas FROM sellin GROUP BY 1", "sellin"))
def c07(spark, sf_dir):
    return model(spark, sf_dir).sellin.groupBy("id_transportista").agg(F.count(F.lit(1)).alias("lineas"))


# ---------------- C-8 ----------------
@query("c08_month_truncation", sql(
    "SELECT CAST(fecha_mes AS VARCHAR) AS fecha_mes, CAST(count(*) AS BIGINT) AS lineas FROM sellin GROUP BY 1", "sellin"))
def c08(spark, sf_dir):
    return model(spark, sf_dir).sellin.groupBy(F.col("fecha_mes").cast("string").alias("fecha_mes")).agg(F.count(F.lit(1)).alias("lineas"))


# ---------------- C-9 ----------------
@query("c09_fx_conversion", sql(
    "SELECT id_linea, anio_mes, moneda, tc_x100, importe_usd_c, costo_usd_c FROM sellin", "sellin"))
def c09(spark, sf_dir):
    return model(spark, sf_dir).sellin.select("id_linea", "anio_mes", "moneda", "tc_x100",
                                              "importe_usd_c", "costo_usd_c")


# ---------------- C-10 ----------------
@query("c10_business_key_normalisation", sql(
    """SELECT id_cliente, cod_cliente AS cod_original, upper(trim(cod_cliente)) AS cod_cliente,
       CAST(cod_cliente <> upper(trim(cod_cliente)) AS INT) AS sucio FROM raw_cliente""", "raw_cliente"))
def c10(spark, sf_dir):
    raw = B.raw_customers(spark, sf_dir).select("id_cliente", F.col("cod_cliente").alias("cod_original"))
    out = C.normalise_key(raw.withColumn("cod_cliente", F.col("cod_original")), "cod_cliente")
    return out.withColumn("sucio", (F.col("cod_original") != F.col("cod_cliente")).cast("int"))


# ---------------- C-11 / C-12 ----------------
@query("c11_hierarchical_median_imputation", sql(
    "SELECT id_producto, atc3, costo_std_c, costo_imputado FROM dim_producto", "dim_producto"))
def c11(spark, sf_dir):
    return model(spark, sf_dir).products.select("id_producto", "atc3", "costo_std_c", "costo_imputado")


@query("c12_standard_margin_pct", sql(
    """SELECT id_producto, 1.0 - CAST(costo_std_c AS DOUBLE) / nullif(CAST(precio_lista_c AS DOUBLE), 0)
       AS margen_std_pct FROM dim_producto""", "dim_producto"))
def c12(spark, sf_dir):
    return model(spark, sf_dir).products.select("id_producto", "margen_std_pct")


# ---------------- C-13 ----------------
def _label(c, key):
    yes, no = LABELS[key]
    return F.when(F.col(c) == 1, F.lit(yes)).otherwise(F.lit(no)).alias(key)


def _label_sql(c, key):
    yes, no = LABELS[key]
    return f"CASE WHEN {c} = 1 THEN '{yes}' ELSE '{no}' END AS {key}"


@query("c13_boolean_labels", sql(
    f"""SELECT 'producto' AS tabla, CAST(id_producto AS BIGINT) AS id, {_label_sql('cadena_frio', 'conservacion')},
       {_label_sql('costo_imputado', 'origen_costo')} FROM dim_producto
       UNION ALL SELECT 'deposito', CAST(id_deposito AS BIGINT), {_label_sql('tiene_camara_frio', 'capacidad_frio')},
       NULL FROM dim_deposito
       UNION ALL SELECT 'transportista', CAST(id_transportista AS BIGINT),
       {_label_sql('control_frio', 'control_temperatura')}, NULL FROM dim_transportista
       UNION ALL SELECT 'motivo', CAST(id_motivo AS BIGINT), {_label_sql('es_evitable', 'evitabilidad')}, NULL
       FROM dim_motivo""", "dim_producto", "dim_deposito", "dim_transportista", "dim_motivo"))
def c13(spark, sf_dir):
    m = model(spark, sf_dir)
    p = m.products.select(F.lit("producto").alias("tabla"), F.col("id_producto").cast("bigint").alias("id"),
                          _label("cadena_frio", "conservacion"), _label("costo_imputado", "origen_costo"))
    d = m.depots.select(F.lit("deposito"), F.col("id_deposito").cast("bigint"),
                        _label("tiene_camara_frio", "capacidad_frio"), F.lit(None).cast("string"))
    t = m.carriers.select(F.lit("transportista"), F.col("id_transportista").cast("bigint"),
                          _label("control_frio", "control_temperatura"), F.lit(None).cast("string"))
    r = m.reasons.select(F.lit("motivo"), F.col("id_motivo").cast("bigint"),
                         _label("es_evitable", "evitabilidad"), F.lit(None).cast("string"))
    return p.union(d).union(t).union(r)


# ---------------- C-14 ----------------
@query("c14_derived_additive_columns", sql(
    """SELECT anio_mes, id_deposito, id_producto, 1 AS filas,
       CAST(dias_cobertura * stock_unidades AS BIGINT) AS cobertura_x_stock FROM stock""", "stock"))
def c14(spark, sf_dir):
    s = model(spark, sf_dir).fact_stock
    return s.select("anio_mes", "id_deposito", "id_producto", F.lit(1).alias("filas"),
                    (F.col("dias_cobertura") * F.col("stock_unidades")).cast("bigint").alias("cobertura_x_stock"))


# ---------------- C-15 ----------------
SEMANTIC_SALES = [  # physical column → business name (contract of the sales view)
    ("fecha", "Fecha"), ("id_cliente", "Id cliente"), ("id_producto", "Id producto"),
    ("id_filial", "Id filial"), ("tipo_documento", "Tipo documento"), ("unidades", "Unidades"),
    ("importe_usd_c", "Importe USD cents"), ("costo_usd_c", "Costo USD cents"), ("lineas", "Líneas"),
    ("lineas_en_revision", "Líneas en revisión"), ("signo", "Signo"),
]


@query("c15_semantic_view_rename", sql(
    "SELECT " + ", ".join((f'CAST({p} AS VARCHAR) AS "{b}"' if p == "fecha" else f'{p} AS "{b}"') for p, b in SEMANTIC_SALES) + " FROM fv", "fv"))
def c15(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    return fv.select(*[(F.col(p).cast("string") if p == "fecha" else F.col(p)).alias(b) for p, b in SEMANTIC_SALES])


# ---------------- C-16 ----------------
STAGE_COLS = ["id_linea", "fecha", "anio_mes", "id_cliente", "id_producto", "id_filial", "id_deposito",
              "id_transportista", "tipo_oferta", "tipo_documento", "signo", "unidades", "flag_revision",
              "importe_usd_c", "costo_usd_c", "otif", "devuelta", "unidades_devueltas",
              "importe_devuelto_usd_c", "id_motivo"]


@query("c16_stage_sellin_without_latent_columns", sql(
    "SELECT " + ", ".join("CAST(fecha AS VARCHAR) AS fecha" if c == "fecha" else c for c in STAGE_COLS) + " FROM sellin", "sellin"))
def c16(spark, sf_dir):
    s = model(spark, sf_dir).sellin
    assert not any(c.startswith("_") for c in s.columns)
    return s.select(*[F.col(c).cast("string").alias(c) if c == "fecha" else c for c in STAGE_COLS])


# ---------------- C-17 ----------------
@query("c17_controlled_rounding", sql(
    """SELECT CAST(fecha AS VARCHAR) AS fecha, id_cliente, id_producto, tipo_documento, id_transportista, tipo_oferta, id_deposito,
       round(CAST(importe_usd_c AS DOUBLE) / 100.0, 2) AS importe_usd,
       round(CAST(costo_usd_c AS DOUBLE) / 100.0, 2) AS costo_usd FROM fv""", "fv"))
def c17(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    return fv.select(F.col("fecha").cast("string").alias("fecha"), "id_cliente", "id_producto", "tipo_documento", "id_transportista", "tipo_oferta",
                     "id_deposito",
                     F.round(F.col("importe_usd_c").cast("double") / 100.0, 2).alias("importe_usd"),
                     F.round(F.col("costo_usd_c").cast("double") / 100.0, 2).alias("costo_usd"))


# ---------------- C-18 ----------------
NARROW_COLS = ["unidades", "lineas", "lineas_otif", "lead_time_dias_x_linea", "id_filial", "importe_usd_c"]


def _type_case(lo, hi):
    return (F.when((lo >= -128) & (hi <= 127), "tinyint").when((lo >= -32768) & (hi <= 32767), "smallint")
            .when((lo >= -2147483648) & (hi <= 2147483647), "int").otherwise("bigint"))


@query("c18_narrow_integer_types", sql(
    "SELECT columna, minimo, maximo, CASE WHEN minimo >= -128 AND maximo <= 127 THEN 'tinyint' "
    "WHEN minimo >= -32768 AND maximo <= 32767 THEN 'smallint' "
    "WHEN minimo >= -2147483648 AND maximo <= 2147483647 THEN 'int' ELSE 'bigint' END AS tipo FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS columna, CAST(min({c}) AS BIGINT) AS minimo, "
                         f"CAST(max({c}) AS BIGINT) AS maximo FROM fv" for c in NARROW_COLS) + ") t", "fv"))
def c18(spark, sf_dir):
    fv = model(spark, sf_dir).fact_ventas
    aggs = []
    for c in NARROW_COLS:
        aggs += [F.min(c).cast("bigint").alias(f"{c}__lo"), F.max(c).cast("bigint").alias(f"{c}__hi")]
    stack = ", ".join(f"'{c}', {c}__lo, {c}__hi" for c in NARROW_COLS)
    t = fv.agg(*aggs).selectExpr(f"stack({len(NARROW_COLS)}, {stack}) AS (columna, minimo, maximo)")
    return t.withColumn("tipo", _type_case(F.col("minimo"), F.col("maximo")))


# ---------------- C-19 ----------------
PROFILE_COLS = ["id_cliente", "cod_cliente", "id_filial", "canal", "segmento", "nombre_rep"]


@query("c19_column_profile", sql(
    " UNION ALL ".join(
        f"SELECT CAST(count(*) AS BIGINT) AS filas, '{c}' AS columna, CAST(count(DISTINCT {c}) AS BIGINT) AS distintos, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulos FROM dim_cliente" for c in PROFILE_COLS),
    "dim_cliente"))
def c19(spark, sf_dir):
    return C.column_profile(model(spark, sf_dir).customers.select(*PROFILE_COLS))


# ---------------- C-20 ----------------
@query("c20_clip_return_rate", sql(
    """SELECT anio_mes, id_filial, least(greatest(CAST(sum(importe_devuelto_usd_c) AS DOUBLE)
       / nullif(CAST(sum(importe_usd_c) AS DOUBLE), 0), 0.0001), 0.6) AS tasa_dev_valor
       FROM sellin WHERE tipo_documento = 'FC' GROUP BY 1, 2""", "sellin"))
def c20(spark, sf_dir):
    s = model(spark, sf_dir).sellin.filter(F.col("tipo_documento") == "FC")
    g = s.groupBy("anio_mes", "id_filial").agg(F.sum("importe_devuelto_usd_c").alias("d"),
                                               F.sum("importe_usd_c").alias("v"))
    return g.select("anio_mes", "id_filial", X.clip(X.safe_div("d", "v"), 0.0001, 0.6).alias("tasa_dev_valor"))


# ---------------- C-21 … C-24 (return features on FC lines) ----------------
def _fc_features(m):
    s = m.sellin.filter(F.col("tipo_documento") == "FC")
    p = m.products.select("id_producto", "cadena_frio", "vida_util_meses")
    t = m.carriers.select("id_transportista", "control_frio", "confiabilidad")
    return s.join(p, "id_producto", "left").join(t, "id_transportista", "left")


@query("c21_boolean_features", sql(
    f"""SELECT s.id_linea, CAST(s.dias_a_vencer < 180 AS INT) AS lote_critico,
       CAST(s.tipo_oferta IN ('BON', 'COM') AS INT) AS oferta_de_carga,
       CAST(p.cadena_frio = 1 AND NOT coalesce(t.control_frio = 1, false) AS INT) AS frio_sin_control,
       CAST(month(s.fecha) IN (3, 6, 9, 12) AS INT) AS cierre_trimestre,
       CAST(e.indice_estacional > {IN_SEASON} AS INT) AS en_temporada,
       greatest(s.lead_time_dias - s.sla_dias, 0) AS exceso_lead_time
       FROM (SELECT *, {CLASS_EXPR_DUCK} AS clase, CAST(month(fecha) AS INT) AS mes_nro FROM sellin) s
       LEFT JOIN dim_producto p USING (id_producto) LEFT JOIN ({SEASONAL_SQL}) e USING (clase, mes_nro)
       LEFT JOIN dim_transportista t USING (id_transportista) WHERE s.tipo_documento = 'FC'""",
    "sellin", "dim_producto", "dim_transportista"))
def c21(spark, sf_dir):
    d = _fc_features(model(spark, sf_dir)).withColumns({"clase": F.expr(CLASS_EXPR), "mes_nro": F.month("fecha")})
    # 84-row fixed table
    d = d.join(F.broadcast(seasonal_table(spark)), ["clase", "mes_nro"], "left")
    return d.select(
        "id_linea",
        (F.col("dias_a_vencer") < 180).cast("int").alias("lote_critico"),
        F.col("tipo_oferta").isin("BON", "COM").cast("int").alias("oferta_de_carga"),
        ((F.col("cadena_frio") == 1) & ~F.coalesce(F.col("control_frio") == 1, F.lit(False)))
        .cast("int").alias("frio_sin_control"),
        F.month("fecha").isin(3, 6, 9, 12).cast("int").alias("cierre_trimestre"),
        (F.col("indice_estacional") > IN_SEASON).cast("int").alias("en_temporada"),
        F.greatest(F.col("lead_time_dias") - F.col("sla_dias"), F.lit(0)).alias("exceso_lead_time"))


@query("c22_seasonal_index_lookup", sql(
    f"""SELECT s.id_linea, s.clase, s.mes_nro, t.indice_estacional FROM
       (SELECT id_linea, {CLASS_EXPR_DUCK} AS clase, CAST(month(fecha) AS INT) AS mes_nro FROM sellin) s
       LEFT JOIN ({SEASONAL_SQL}) t USING (clase, mes_nro)""", "sellin"))
def c22(spark, sf_dir):
    s = model(spark, sf_dir).sellin.select("id_linea", F.expr(CLASS_EXPR).alias("clase"),
                                           F.month("fecha").alias("mes_nro"))
    # 84-row fixed table: broadcast has a proven size bound
    return s.join(F.broadcast(seasonal_table(spark)), ["clase", "mes_nro"], "left") \
        .select("id_linea", "clase", "mes_nro", "indice_estacional")


@query("c23_shelf_life_remaining_pct", sql(
    """SELECT s.id_linea, least(greatest(CAST(s.dias_a_vencer AS DOUBLE) / CAST(p.vida_util_meses * 30 AS DOUBLE),
       0.0), 1.0) AS vida_util_remanente_pct FROM sellin s LEFT JOIN dim_producto p USING (id_producto)
       WHERE s.tipo_documento = 'FC'""", "sellin", "dim_producto"))
def c23(spark, sf_dir):
    d = _fc_features(model(spark, sf_dir))
    return d.select("id_linea", X.clip(F.col("dias_a_vencer").cast("double")
                                       / (F.col("vida_util_meses") * 30).cast("double"), 0.0, 1.0)
                    .alias("vida_util_remanente_pct"))


@query("c24_missing_to_global_median", sql(
    """SELECT s.id_linea, coalesce(CAST(t.confiabilidad AS DOUBLE), (SELECT quantile_cont(t2.confiabilidad, 0.5)
       FROM sellin s2 LEFT JOIN dim_transportista t2 USING (id_transportista) WHERE s2.tipo_documento = 'FC'))
       AS confiabilidad FROM sellin s LEFT JOIN dim_transportista t USING (id_transportista)
       WHERE s.tipo_documento = 'FC'""", "sellin", "dim_transportista"))
def c24(spark, sf_dir):
    d = _fc_features(model(spark, sf_dir))
    med = d.agg(F.percentile("confiabilidad", 0.5).alias("_med"))
    return d.crossJoin(med).select("id_linea", F.coalesce(F.col("confiabilidad").cast("double"), F.col("_med"))
                                   .alias("confiabilidad"))


# ---------------- C-25 ----------------
@query("c25_offer_economics", sql(
    """SELECT id_oferta, valor_c, descuento_c,
       CAST(descuento_pct_int AS DOUBLE) / avg(CAST(descuento_pct_int AS DOUBLE)) OVER (PARTITION BY tipo_oferta)
       AS ratio_desc_vs_tipo FROM (SELECT o.*, CAST(o.unidades_ofertadas * p.precio_lista_c AS BIGINT) AS valor_c,
       CAST(o.unidades_ofertadas * p.precio_lista_c * o.descuento_pct_int AS BIGINT) AS descuento_c
       FROM ofertas o LEFT JOIN dim_producto p USING (id_producto)) x""", "ofertas", "dim_producto"))
def c25(spark, sf_dir):
    m = model(spark, sf_dir)
    o = m.fact_ofertas.join(m.products.select("id_producto", "precio_lista_c"), "id_producto", "left")
    # the per-type mean is a small aggregate joined back (a window over the
    # offer type would send every offer of a type to one task)
    mean = o.groupBy("tipo_oferta").agg(F.avg(F.col("descuento_pct_int").cast("double")).alias("_m"))
    return (o.join(mean, "tipo_oferta")
            .select("id_oferta",
                    (F.col("unidades_ofertadas") * F.col("precio_lista_c")).cast("bigint").alias("valor_c"),
                    (F.col("unidades_ofertadas") * F.col("precio_lista_c") * F.col("descuento_pct_int"))
                    .cast("bigint").alias("descuento_c"),
                    (F.col("descuento_pct_int").cast("double") / F.col("_m")).alias("ratio_desc_vs_tipo")))


# ---------------- C-26 / C-27 ----------------
@query("c26_c27_cyclical_and_link_transforms", sql(
    f"""SELECT anio_mes, id_filial, round(sin({2 * math.pi!r} * CAST(anio_mes % 100 AS DOUBLE) / 12.0), 9) AS mes_sin,
       round(cos({2 * math.pi!r} * CAST(anio_mes % 100 AS DOUBLE) / 12.0), 9) AS mes_cos,
       round(ln(t / (1.0 - t)), 9) AS logit_tasa, round(ln(1.0 + CAST(inv_c AS DOUBLE) / 100.0), 9) AS log1p_inversion
       FROM (SELECT anio_mes, id_filial, least(greatest(CAST(sum(importe_devuelto_usd_c) AS DOUBLE)
       / nullif(CAST(sum(importe_usd_c) AS DOUBLE), 0), 0.0001), 0.6) AS t,
       CAST(sum(importe_usd_c) AS BIGINT) AS inv_c FROM sellin WHERE tipo_documento = 'FC' GROUP BY 1, 2) x""",
    "sellin"))
def c26(spark, sf_dir):
    s = model(spark, sf_dir).sellin.filter(F.col("tipo_documento") == "FC")
    g = s.groupBy("anio_mes", "id_filial").agg(F.sum("importe_devuelto_usd_c").alias("d"),
                                               F.sum("importe_usd_c").cast("bigint").alias("inv_c"))
    g = g.withColumn("t", X.clip(X.safe_div("d", "inv_c"), 0.0001, 0.6))
    mes = F.col("anio_mes") % 100
    return g.select("anio_mes", "id_filial",
                    F.round(X.month_sin(mes), 9).alias("mes_sin"), F.round(X.month_cos(mes), 9).alias("mes_cos"),
                    F.round(X.logit("t"), 9).alias("logit_tasa"),
                    F.round(F.log1p(F.col("inv_c").cast("double") / 100.0), 9).alias("log1p_inversion"))



