"""Registered data-quality queries: Q-1 … Q-21, A-12, B-10, O-1."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmetrics.operators import quality as Q
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.joins_q import _MONTHS_SQL
from starmetrics.plans.oracle import sql

_MAPPING = [
    ("Q01", "sin_fecha", "n0"), ("Q02", "dups", "validas"), ("Q03", "neg", "n1"), ("Q04", "outl", "n2"),
    ("Q05", "sin_tr", "n1"), ("Q06", "sin_fx", "n1"), ("Q07", "atraso", "n2"), ("Q08", "dirty", "nc"),
    ("Q09", "dupc", "nc"), ("Q10", "sincosto", "np"), ("Q11", "costo_ge", "np"), ("Q12", "miss", "ngrid"),
    ("Q13", "orph_p", "n2"), ("Q14", "orph_c", "n1"), ("Q15", "grain", "nfv"), ("Q16", "fxgap", "nfxgrid"),
    ("Q17", "negm", "nfv"), ("Q18", "devmas", "nfv"), ("Q19", "recon", "one"), ("Q20", "silent", "nbr"),
]

_WIDE = f"""SELECT * FROM
 (SELECT count(*) AS n0, count(*) FILTER (WHERE fecha IS NULL) AS sin_fecha,
   count(*) FILTER (WHERE fecha IS NOT NULL) AS validas,
   count(*) FILTER (WHERE fecha IS NOT NULL) - count(DISTINCT CASE WHEN fecha IS NOT NULL THEN id_linea END) AS dups
   FROM parsed) a,
 (SELECT count(*) AS n1, count(*) FILTER (WHERE importe_local_c < 0 OR unidades < 0) AS neg,
   count(*) FILTER (WHERE id_transportista IS NULL) AS sin_tr FROM dedup) b,
 (SELECT count(*) AS sin_fx FROM dedup d WHERE NOT EXISTS
   (SELECT 1 FROM fx f WHERE f.anio_mes = d.anio_mes AND f.moneda = d.moneda)
   AND EXISTS (SELECT 1 FROM dim_cliente k WHERE k.id_cliente = d.id_cliente)) c,
 (SELECT count(*) AS n2, sum(flag_revision) AS outl,
   greatest(datediff('day', max(fecha), last_day(max(fecha))), 0) AS atraso FROM sellin) d,
 (SELECT count(*) AS orph_p FROM sellin s WHERE NOT EXISTS (SELECT 1 FROM dim_producto p WHERE p.id_producto = s.id_producto)) e,
 (SELECT count(*) AS orph_c FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM dim_cliente c WHERE c.id_cliente = d.id_cliente)) f,
 (SELECT count(*) AS nc, count(*) FILTER (WHERE cod_cliente <> upper(trim(cod_cliente))) AS dirty,
   count(*) - count(DISTINCT upper(trim(cod_cliente))) AS dupc FROM raw_cliente) g,
 (SELECT count(*) AS np, sum(costo_imputado) AS sincosto,
   count(*) FILTER (WHERE costo_std_c >= precio_lista_c) AS costo_ge FROM dim_producto) h,
 (SELECT count(*) AS ngrid FROM ({_MONTHS_SQL}) m CROSS JOIN dim_filial) i,
 (SELECT count(*) AS miss FROM (SELECT m.anio_mes, b.id_filial FROM ({_MONTHS_SQL}) m
   CROSS JOIN (SELECT id_filial FROM dim_filial) b EXCEPT SELECT DISTINCT anio_mes, id_filial FROM sellout) x) j,
 (SELECT count(*) AS nfv, count(*) - (SELECT count(*) FROM (SELECT DISTINCT fecha, id_cliente, id_producto,
   id_filial, id_deposito, id_transportista, tipo_oferta, tipo_documento FROM fv) y) AS grain,
   count(*) FILTER (WHERE costo_usd_c > importe_usd_c) AS negm,
   count(*) FILTER (WHERE unidades_devueltas > unidades) AS devmas,
   CASE WHEN sum(unidades * signo) = (SELECT sum(unidades * signo) FROM sellin) THEN 0 ELSE 1 END AS recon,
   1 AS one FROM fv) k,
 (SELECT count(*) AS fxgap FROM (SELECT m.anio_mes, b.moneda FROM ({_MONTHS_SQL}) m
   CROSS JOIN (SELECT moneda FROM dim_filial) b EXCEPT SELECT anio_mes, moneda FROM fx) z) l,
 (SELECT count(*) AS nfxgrid FROM ({_MONTHS_SQL}) m CROSS JOIN dim_filial) n,
 (SELECT count(*) FILTER (WHERE datediff('day', f, u) > 35) AS silent, count(*) AS nbr FROM
   (SELECT id_filial, max(fecha) AS f FROM sellin GROUP BY 1) p CROSS JOIN (SELECT max(fecha) AS u FROM sellin) q) o"""

_META = {c[0]: c for c in Q.CONTROLS}


def _esc(s):
    return s.replace("'", "''")


_ROWS = " UNION ALL ".join(
    f"""SELECT '{cid}' AS id_control, '{_META[cid][1]}' AS dimension, '{_esc(_META[cid][2])}' AS control,
     '{_META[cid][3]}' AS tabla, CAST({a} AS BIGINT) AS filas_afectadas, CAST({t} AS BIGINT) AS filas_totales,
     CASE WHEN {t} > 0 THEN CAST({a} AS DOUBLE) * 100.0 / CAST({t} AS DOUBLE) ELSE 0.0 END AS pct_afectado,
     '{_esc(_META[cid][4])}' AS accion, '{_META[cid][5]}' AS severidad,
     CASE WHEN {a} = 0 THEN 'OK' WHEN '{_META[cid][5]}' = 'alta' THEN 'CRÍTICO' ELSE 'ALERTA' END AS estado FROM w"""
    for cid, a, t in _MAPPING)

_NEEDS = ("parsed", "dedup", "fx", "sellin", "dim_producto", "dim_cliente", "raw_cliente", "dim_filial", "sellout",
          "fv")
_EXTRA = {"w": (list(_NEEDS), _WIDE), "reg": (["w"], _ROWS)}


def _reg(spark, sf_dir):
    return Q.registry(model(spark, sf_dir))


@query("q01_q20_dq_control_registry", sql("SELECT * FROM reg", *_NEEDS, extra=_EXTRA))
def q_registry(spark, sf_dir):
    return _reg(spark, sf_dir)


@query("a12_dq_summary_by_state", sql(
    """SELECT CAST(count(*) AS BIGINT) AS controles_ejecutados,
       CAST(count(*) FILTER (WHERE estado = 'OK') AS BIGINT) AS controles_ok,
       CAST(count(*) FILTER (WHERE estado = 'ALERTA') AS BIGINT) AS controles_alerta,
       CAST(count(*) FILTER (WHERE estado = 'CRÍTICO') AS BIGINT) AS controles_criticos FROM reg""",
    *_NEEDS, extra=_EXTRA))
def a12(spark, sf_dir):
    return Q.summary(_reg(spark, sf_dir))


@query("q21_publication_gate", sql(
    """SELECT CAST(count(*) FILTER (WHERE estado = 'CRÍTICO') = 0 AS INT) AS puede_publicar,
       CAST(count(*) FILTER (WHERE estado = 'CRÍTICO') AS BIGINT) AS criticos FROM reg""", *_NEEDS, extra=_EXTRA))
def q21(spark, sf_dir):
    return Q.gate(_reg(spark, sf_dir))


@query("b10_data_status_table", sql(
    """SELECT (SELECT CAST(max(fecha) AS VARCHAR) FROM sellin) AS ultimo_dato,
       CAST(count(*) FILTER (WHERE estado = 'CRÍTICO') AS BIGINT) AS controles_criticos,
       CAST(count(*) FILTER (WHERE estado = 'ALERTA') AS BIGINT) AS controles_alerta,
       CAST(count(*) FILTER (WHERE estado = 'OK') AS BIGINT) AS controles_ok FROM reg""", *_NEEDS, extra=_EXTRA))
def b10(spark, sf_dir):
    m = model(spark, sf_dir)
    s = Q.summary(Q.registry(m))
    last = m.sellin.agg(F.max("fecha").cast("string").alias("ultimo_dato"))
    return last.crossJoin(s).select("ultimo_dato", "controles_criticos", "controles_alerta", "controles_ok")


@query("o01_controls_by_severity", sql(
    """SELECT id_control, estado, dimension, row_number() OVER (ORDER BY CASE estado WHEN 'CRÍTICO' THEN 1
       WHEN 'ALERTA' THEN 2 ELSE 3 END, dimension, id_control) AS orden FROM reg""", *_NEEDS, extra=_EXTRA))
def o01(spark, sf_dir):
    from pyspark.sql import Window
    reg = _reg(spark, sf_dir)
    sev = F.when(F.col("estado") == Q.CRIT, 1).when(F.col("estado") == Q.ALERT, 2).otherwise(3)
    # 20 control rows: a global order over them is bounded
    return reg.select("id_control", "estado", "dimension",
                      F.row_number().over(Window.orderBy(sev, "dimension", "id_control")).cast("bigint").alias("orden"))


@query("q06_q14_rejected_lines_reconciliation", sql(
    """SELECT n1 AS lineas_entrada, n2 AS lineas_limpias, rc AS rechazadas_cliente, rf AS rechazadas_cambio,
       CAST(n1 = n2 + rc + rf AS INT) AS cuadra FROM (SELECT CAST(count(*) AS BIGINT) AS n1 FROM dedup) a,
       (SELECT CAST(count(*) AS BIGINT) AS n2 FROM sellin) b,
       (SELECT CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dim_cliente c WHERE c.id_cliente = d.id_cliente)) AS BIGINT) AS rc,
          CAST(count(*) FILTER (WHERE EXISTS (SELECT 1 FROM dim_cliente c WHERE c.id_cliente = d.id_cliente)) AS BIGINT) AS rf
        FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM fx f WHERE f.anio_mes = d.anio_mes AND f.moneda = d.moneda)) e""",
    "dedup", "sellin", "fx", "dim_cliente"))
def q_rejected(spark, sf_dir):
    return Q.reconcile_rejected(model(spark, sf_dir))
