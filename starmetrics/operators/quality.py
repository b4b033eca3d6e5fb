"""Data-quality registry Q-1 … Q-22 and the publication gate.

Each table is scanned once: all its counters are columns of a single
aggregate, and the wide one-row result is ``stack``-ed into control rows.
The registry is a DataFrame (dimension, control, tabla, filas_afectadas,
filas_totales, pct_afectado, accion, severidad, estado).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmetrics.operators import joins as J
from starmetrics.operators.cleanse import REJECTED

OK, ALERT, CRIT = "OK", "ALERTA", "CRÍTICO"

# Controls (id, dimension, description, table, action, severity).
CONTROLS = [
    ("Q01", "Validez", "Fechas parseables (2 formatos conviviendo)", "sellin", "Descartar fila sin fecha resoluble", "alta"),
    ("Q02", "Unicidad", "Líneas de factura duplicadas por reproceso", "sellin", "Deduplicar por id_linea conservando la primera", "alta"),
    ("Q03", "Validez", "Importes/unidades negativos (notas de crédito)", "sellin", "Reclasificar a tipo_documento='NC' y pasar a positivo", "media"),
    ("Q04", "Exactitud", "Unidades > 25x la mediana del SKU (dedazo de carga)", "sellin", "Marcar flag_revision=1; NO se corrige en silencio", "alta"),
    ("Q05", "Completitud", "Despachos sin transportista informado", "sellin", "Imputar a 'No informado' y reportar al origen", "media"),
    ("Q06", "Consistencia", "Líneas sin tipo de cambio del mes", "sellin", "Bloquear publicación: sin FX no hay cifra corporativa", "alta"),
    ("Q07", "Vigencia", "Antigüedad del último dato cargado", "sellin", "SLA de carga: 5 días", "media"),
    ("Q08", "Consistencia", "Código de cliente con espacios / minúsculas", "dim_cliente", "TRIM + UPPER — la clave de negocio se normaliza siempre", "media"),
    ("Q09", "Unicidad", "Código de cliente duplicado", "dim_cliente", "Clave de negocio única — bloquea la carga", "alta"),
    ("Q10", "Completitud", "SKU sin costo estándar cargado", "dim_producto", "Imputar con la mediana del ATC3 y marcar costo_imputado=1", "alta"),
    ("Q11", "Validez", "SKU con costo >= precio de lista (margen negativo)", "dim_producto", "Marcar para revisión de Finanzas", "alta"),
    ("Q12", "Completitud", "Filial-mes sin carga del panel de auditoría", "sellout", "Marcar el mes como 'sin dato' — NUNCA como cero", "alta"),
    ("Q13", "Consistencia", "Ventas con SKU inexistente en el maestro", "sellin", "Aparecerían agrupadas en una fila en blanco", "alta"),
    ("Q14", "Consistencia", "Ventas con cliente inexistente en el maestro", "sellin", "Bloquea la carga hasta dar de alta el cliente", "alta"),
    ("Q15", "Unicidad", "Grano declarado del hecho de ventas violado", "fact_ventas", "Revisar la agregación", "alta"),
    ("Q16", "Consistencia", "Filial-moneda-mes sin tipo de cambio", "tipo_cambio", "Cargar la tasa del mes", "alta"),
    ("Q17", "Validez", "Líneas con margen bruto negativo", "fact_ventas", "Revisar precio y costo", "media"),
    ("Q18", "Validez", "Unidades devueltas mayores que vendidas", "fact_ventas", "Revisar la devolución", "alta"),
    ("Q19", "Exactitud", "Conciliación de unidades hecho vs origen (tolerancia 0)", "fact_ventas", "Bloquear publicación", "alta"),
    ("Q20", "Vigencia", "Filiales sin datos hace más de 35 días", "sellin", "Revisar la interfaz de la filial", "alta"),
]


def control_rows(counters: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Stack a one-row counter frame into control rows.

    ``mapping``: (control id, affected column, total column).
    """
    stack = ", ".join(f"'{cid}', CAST(`{a}` AS BIGINT), CAST(`{t}` AS BIGINT)" for cid, a, t in mapping)
    rows = counters.selectExpr(f"stack({len(mapping)}, {stack}) AS (id_control, filas_afectadas, filas_totales)")
    spark = counters.sparkSession
    m = spark.createDataFrame([c for c in CONTROLS if c[0] in {x[0] for x in mapping}],
                              "id_control string, dimension string, control string, tabla string, accion string, "
                              "severidad string")
    out = rows.join(F.broadcast(m), "id_control")
    return out.select(
        "id_control", "dimension", "control", "tabla", "filas_afectadas", "filas_totales",
        F.when(F.col("filas_totales") > 0,
               F.col("filas_afectadas").cast("double") * 100.0 / F.col("filas_totales").cast("double"))
        .otherwise(F.lit(0.0)).alias("pct_afectado"),
        "accion", "severidad",
        F.when(F.col("filas_afectadas") == 0, F.lit(OK))
        .when(F.col("severidad") == "alta", F.lit(CRIT)).otherwise(F.lit(ALERT)).alias("estado"))


def registry(m, silent_days: int = 35) -> DataFrame:
    """All controls of one model, one aggregate per table."""
    # raw lines: Q-1 (parse) and Q-2 (duplicates among the parsed ones)
    raw = m.parsed.agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(F.col("fecha").isNull()).alias("sin_fecha"),
        F.count_if(F.col("fecha").isNotNull()).alias("validas"),
        F.count_distinct(F.when(F.col("fecha").isNotNull(), F.col("id_linea"))).alias("ids"))
    raw = raw.withColumn("dups", F.col("validas") - F.col("ids"))
    # deduplicated lines: Q-3, Q-5
    ded = m.deduped.agg(
        F.count(F.lit(1)).alias("n1"),
        F.count_if((F.col("importe_local_c") < 0) | (F.col("unidades") < 0)).alias("neg"),
        F.count_if(F.col("id_transportista").isNull()).alias("sin_tr"))
    # lines that the clean ones lose: without a rate (Q-6), without a customer (Q-14)
    why = F.col("motivo_rechazo")
    nofx = m.rejected.agg(F.count_if(why == REJECTED[1]).alias("sin_fx"), F.count_if(why == REJECTED[0]).alias("lost_c"))
    # clean lines: Q-4, Q-7, Q-13, and Q-14 for orphans that kept a currency
    clean = m.sellin.agg(
        F.count(F.lit(1)).alias("n2"),
        F.sum("flag_revision").alias("outl"),
        F.greatest(F.datediff(F.last_day(F.max("fecha")), F.max("fecha")), F.lit(0)).alias("atraso"))
    orph_p = J.orphans(m.sellin, m.keyed("products", "id_producto"), "id_producto").agg(F.count(F.lit(1)).alias("orph_p"))
    orph_c = J.orphans(m.sellin, m.keyed("customers", "id_cliente"), "id_cliente").agg(F.count(F.lit(1)).alias("orph_c"))
    # customers: Q-8, Q-9 (raw codes)
    from starmetrics.sources import binding as B
    rc = B.raw_customers(m.spark, m.sf_dir)
    cust = rc.agg(F.count(F.lit(1)).alias("nc"),
                  F.count_if(F.col("cod_cliente") != F.upper(F.trim("cod_cliente"))).alias("dirty"),
                  (F.count(F.lit(1)) - F.count_distinct(F.upper(F.trim("cod_cliente")))).alias("dupc"))
    # products: Q-10 (raw cost), Q-11 (after imputation)
    prod = m.products.agg(F.count(F.lit(1)).alias("np"), F.sum("costo_imputado").alias("sincosto"),
                          F.count_if(F.col("costo_std_c") >= F.col("precio_lista_c")).alias("costo_ge"))
    # sell-out completeness: Q-12
    from starmetrics.plans.joins_q import _months, missing_branch_months
    grid = _months(m).crossJoin(m.branches.select("id_filial")).agg(F.count(F.lit(1)).alias("ngrid"))
    miss = missing_branch_months(m).agg(F.count(F.lit(1)).alias("miss"))
    # fact checks: Q-15, Q-17, Q-18, Q-19
    fv = m.fact_ventas
    grain = ["fecha", "id_cliente", "id_producto", "id_filial", "id_deposito", "id_transportista",
             "id_tipo_oferta", "tipo_documento"]
    fchk = fv.agg(F.count(F.lit(1)).alias("nfv"),
                  (F.count(F.lit(1)) - F.count_distinct(F.struct(*grain))).alias("grain"),
                  F.count_if(F.col("costo_usd_c") > F.col("importe_usd_c")).alias("negm"),
                  F.count_if(F.col("unidades_devueltas") > F.col("unidades")).alias("devmas"),
                  F.sum(F.col("unidades") * F.col("signo")).alias("u_fact"))
    src = m.sellin.agg(F.sum(F.col("unidades") * F.col("signo")).alias("u_src"))
    recon = fchk.crossJoin(src).select("nfv", "grain", "negm", "devmas",
                                       F.when(F.col("u_fact") == F.col("u_src"), F.lit(0)).otherwise(F.lit(1))
                                       .alias("recon"), F.lit(1).alias("one"))
    # FX completeness: Q-16
    from starmetrics.plans.joins_q import _months as months
    fxgrid = months(m).crossJoin(m.branches.select("moneda"))
    fxgap = fxgrid.join(m.fx.select("anio_mes", "moneda"), ["anio_mes", "moneda"], "left_anti") \
        .agg(F.count(F.lit(1)).alias("fxgap"))
    fxn = fxgrid.agg(F.count(F.lit(1)).alias("nfxgrid"))
    # silent branches: Q-20
    last = m.sellin.agg(F.max("fecha").alias("_u"))
    silent = (m.sellin.groupBy("id_filial").agg(F.max("fecha").alias("_f")).crossJoin(last)
              .agg(F.count_if(F.datediff("_u", "_f") > silent_days).alias("silent"),
                   F.count(F.lit(1)).alias("nbr")))
    wide = reduce(lambda a, b: a.crossJoin(b),
                  [raw, ded, nofx, clean, orph_p, orph_c, cust, prod, grid, miss, recon, fxgap, fxn, silent])
    wide = wide.withColumn("orph_c", F.col("orph_c") + F.col("lost_c"))
    return control_rows(wide, [
        ("Q01", "sin_fecha", "n0"), ("Q02", "dups", "validas"), ("Q03", "neg", "n1"), ("Q04", "outl", "n2"),
        ("Q05", "sin_tr", "n1"), ("Q06", "sin_fx", "n1"), ("Q07", "atraso", "n2"), ("Q08", "dirty", "nc"),
        ("Q09", "dupc", "nc"), ("Q10", "sincosto", "np"), ("Q11", "costo_ge", "np"), ("Q12", "miss", "ngrid"),
        ("Q13", "orph_p", "n2"), ("Q14", "orph_c", "n1"), ("Q15", "grain", "nfv"), ("Q16", "fxgap", "nfxgrid"),
        ("Q17", "negm", "nfv"), ("Q18", "devmas", "nfv"), ("Q19", "recon", "one"), ("Q20", "silent", "nbr"),
    ])


def reconcile_rejected(m) -> DataFrame:
    """Lines in = clean lines + rejected lines, by reason, in one row."""
    why = F.col("motivo_rechazo")
    n1 = m.deduped.agg(F.count(F.lit(1)).alias("lineas_entrada"))
    n2 = m.sellin.agg(F.count(F.lit(1)).alias("lineas_limpias"))
    lost = m.rejected.agg(F.count_if(why == REJECTED[0]).alias("rechazadas_cliente"), F.count_if(why == REJECTED[1]).alias("rechazadas_cambio"))
    fits = F.col("lineas_entrada") == F.col("lineas_limpias") + F.col("rechazadas_cliente") + F.col("rechazadas_cambio")
    return n1.crossJoin(n2).crossJoin(lost).withColumn("cuadra", fits.cast("int"))


def summary(reg: DataFrame) -> DataFrame:
    """A-12: DQ summary by state, one row."""
    return reg.agg(F.count(F.lit(1)).alias("controles_ejecutados"),
                   F.count_if(F.col("estado") == OK).alias("controles_ok"),
                   F.count_if(F.col("estado") == ALERT).alias("controles_alerta"),
                   F.count_if(F.col("estado") == CRIT).alias("controles_criticos"))


def gate(reg: DataFrame) -> DataFrame:
    """Q-21: publication gate: any CRÍTICO blocks."""
    return reg.agg(F.count_if(F.col("estado") == CRIT).alias("criticos")) \
        .select((F.col("criticos") == 0).cast("int").alias("puede_publicar"), "criticos")


class PublicationBlocked(RuntimeError):
    pass


def publish(reg: DataFrame, df: DataFrame, path: str, **opts) -> None:
    """Write ``df`` only when the gate is open (driver reads one tiny row)."""
    g = gate(reg).first()
    if not g["puede_publicar"]:
        raise PublicationBlocked(f"{g['criticos']} critical control(s): not published")
    df.write.mode("overwrite").options(**opts).parquet(path)


def contract_check(tables: dict[str, DataFrame], contract: dict[str, list[str]],
                   relationships: list[tuple[str, str, str, str]], dated: set[str]) -> DataFrame:
    """Q-22: every contracted column and relationship key exists in the data; facts
    without a ``fecha`` column are warned.  Works on schemas only (no data scan)."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for t, cols in contract.items():
        have = set(tables[t].columns)
        for c in cols:
            rows.append((t, c, "columna", int(c in have)))
    for ft, fk, dt, dk in relationships:
        rows.append((ft, fk, f"relacion→{dt}", int(fk in tables[ft].columns and dk in tables[dt].columns)))
    for t in dated:
        rows.append((t, "fecha", "calendario", int("fecha" in tables[t].columns)))
    return spark.createDataFrame(rows, "tabla string, columna string, chequeo string, ok int")
