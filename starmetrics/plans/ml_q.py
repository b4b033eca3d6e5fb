"""Registered evaluation queries M-1, M-4 … M-10, M-14, M-19 … M-21 (oracle-checked)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmetrics import config as K
from starmetrics.operators import evaluate as E
from starmetrics.operators import windows as W
from starmetrics.operators.star import model
from starmetrics.plans.catalog import query
from starmetrics.plans.oracle import CTES, sql
from starmetrics.plans.windows_q import branch_month, line_risk

def HOLDOUT():
    return F.col("anio_mes") > K.CUT_VALID

CTES["ev"] = (["line_risk"], f"SELECT id_linea, prob, devuelta, anio_mes FROM line_risk WHERE anio_mes > {K.CUT_VALID}")
CTES["ev_h"] = (["ev"], "SELECT prob AS s, count(*) AS n, sum(devuelta) AS pos FROM ev GROUP BY 1")


CTES["val_h"] = (["line_risk"], f"""SELECT prob AS s, count(*) AS n, sum(devuelta) AS pos FROM line_risk
    WHERE anio_mes > {K.CUT_TRAIN} AND anio_mes <= {K.CUT_VALID} GROUP BY 1""")


def validation(spark, sf_dir):
    return line_risk(model(spark, sf_dir)).filter((F.col("anio_mes") > K.CUT_TRAIN) & (F.col("anio_mes") <= K.CUT_VALID))


def holdout(spark, sf_dir):
    return line_risk(model(spark, sf_dir)).filter(HOLDOUT()).select("id_linea", "prob", "devuelta", "anio_mes")


def split_col():
    return (F.when(F.col("anio_mes") <= K.CUT_TRAIN, "train").when(F.col("anio_mes") <= K.CUT_VALID, "valid")
            .otherwise("holdout"))


_SPLIT_SQL = (f"CASE WHEN anio_mes <= {K.CUT_TRAIN} THEN 'train' WHEN anio_mes <= {K.CUT_VALID} THEN 'valid' "
              f"ELSE 'holdout' END")


@query("m01_temporal_split", sql(
    f"""SELECT {_SPLIT_SQL} AS particion, CAST(count(*) AS BIGINT) AS n, CAST(sum(devuelta) AS BIGINT) AS positivos
       FROM fc GROUP BY 1""", "fc"))
def m01(spark, sf_dir):
    from starmetrics.plans.windows_q import fc_lines
    return fc_lines(model(spark, sf_dir)).groupBy(split_col().alias("particion")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("devuelta").cast("bigint").alias("positivos"))


@query("m04_decile_capture_and_lift", sql(
    """SELECT CAST(t10 AS DOUBLE) / CAST(greatest(p, 1) AS DOUBLE) AS captura_top10,
       (CAST(t10 AS DOUBLE) / CAST(k10 AS DOUBLE)) / greatest(CAST(p AS DOUBLE) / CAST(n AS DOUBLE), 1e-9) AS lift_top10,
       CAST(t20 AS DOUBLE) / CAST(greatest(p, 1) AS DOUBLE) AS captura_top20,
       (CAST(t20 AS DOUBLE) / CAST(k20 AS DOUBLE)) / greatest(CAST(p AS DOUBLE) / CAST(n AS DOUBLE), 1e-9) AS lift_top20,
       CAST(t30 AS DOUBLE) / CAST(greatest(p, 1) AS DOUBLE) AS captura_top30,
       (CAST(t30 AS DOUBLE) / CAST(k30 AS DOUBLE)) / greatest(CAST(p AS DOUBLE) / CAST(n AS DOUBLE), 1e-9) AS lift_top30
       FROM (SELECT n, p, k10, k20, k30, sum(CASE WHEN pos <= k10 THEN devuelta ELSE 0 END) AS t10,
         sum(CASE WHEN pos <= k20 THEN devuelta ELSE 0 END) AS t20, sum(CASE WHEN pos <= k30 THEN devuelta ELSE 0 END) AS t30
         FROM (SELECT devuelta, row_number() OVER (ORDER BY prob DESC, id_linea) AS pos FROM ev) r
         CROSS JOIN (SELECT count(*) AS n, sum(devuelta) AS p, greatest(floor(count(*) * 10 / 100), 1) AS k10,
           greatest(floor(count(*) * 20 / 100), 1) AS k20, greatest(floor(count(*) * 30 / 100), 1) AS k30 FROM ev) c
         GROUP BY 1, 2, 3, 4, 5) x""", "ev"))
def m04(spark, sf_dir):
    return E.decile_capture(holdout(spark, sf_dir), "prob", "devuelta", "id_linea")


_T = 0.25


@query("m05_confusion_matrix_metrics", sql(
    f"""SELECT tp, fp, fn, tn, CAST(tp + tn AS DOUBLE) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy,
       (CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0) + CAST(tn AS DOUBLE) / nullif(CAST(tn + fp AS DOUBLE), 0)) / 2.0
         AS balanced_accuracy, CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0) AS precision,
       CAST(tp AS DOUBLE) / nullif(CAST(tp + fn AS DOUBLE), 0) AS recall,
       CAST(2 * tp AS DOUBLE) / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0) AS f1,
       (CAST(tp AS DOUBLE) / nullif(CAST(tp + fp AS DOUBLE), 0)) / nullif(CAST(tp + fn AS DOUBLE) / CAST(tp + fp + fn + tn AS DOUBLE), 0)
         AS lift FROM (SELECT CAST(count(*) FILTER (WHERE prob >= {_T} AND devuelta = 1) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE prob >= {_T} AND devuelta = 0) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE prob < {_T} AND devuelta = 1) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE prob < {_T} AND devuelta = 0) AS BIGINT) AS tn FROM ev) t""", "ev"))
def m05(spark, sf_dir):
    return E.confusion(holdout(spark, sf_dir), "prob", "devuelta", _T)


_AUC_SQL = """SELECT (sum(pos * avg_rank) - CAST(sum(pos) AS DOUBLE) * (CAST(sum(pos) AS DOUBLE) + 1) / 2.0)
    / (CAST(sum(n - pos) AS DOUBLE) * CAST(sum(pos) AS DOUBLE)) AS roc_auc FROM
    (SELECT s, n, pos, CAST(sum(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n AS DOUBLE)
      + CAST(n + 1 AS DOUBLE) / 2.0 AS avg_rank FROM {h}) r"""


@query("m06_roc_auc_with_ties", sql(_AUC_SQL.format(h="ev_h"), "ev_h"))
def m06(spark, sf_dir):
    return E.roc_auc(holdout(spark, sf_dir), "prob", "devuelta")


@query("m07_pr_auc_average_precision", sql(
    """SELECT round(sum((CAST(pos AS DOUBLE) / CAST(pp AS DOUBLE)) * (CAST(tp AS DOUBLE) / CAST(nn AS DOUBLE))), 12) AS pr_auc
       FROM (SELECT s, n, pos, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
         sum(n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS nn, sum(pos) OVER () AS pp FROM ev_h) r""", "ev_h"))
def m07(spark, sf_dir):
    return E.average_precision(holdout(spark, sf_dir), "prob", "devuelta").select(F.round("pr_auc", 12).alias("pr_auc"))


@query("m08_brier_score", sql(
    "SELECT round(avg(pow(prob - CAST(devuelta AS DOUBLE), 2)), 12) AS brier FROM ev", "ev"))
def m08(spark, sf_dir):
    return E.brier(holdout(spark, sf_dir), "prob", "devuelta").select(F.round("brier", 12).alias("brier"))


@query("m09_threshold_selection_grid", sql(
    """WITH g AS (SELECT u, tp, fp, p - tp AS fn, coalesce(CAST(2 * tp AS DOUBLE) / nullif(CAST(2 * tp + fp + p - tp AS DOUBLE), 0), 0.0)
         AS f1, CAST(p - tp AS DOUBLE) * 4.0 + CAST(fp AS DOUBLE) * 1.0 AS costo FROM
       (SELECT u, sum(CASE WHEN s >= u THEN pos ELSE 0 END) AS tp, sum(CASE WHEN s >= u THEN n - pos ELSE 0 END) AS fp
        FROM val_h CROSS JOIN (SELECT round(i / 100.0, 2) AS u FROM range(2, 91) t(i)) grid GROUP BY u) a
       CROSS JOIN (SELECT sum(pos) AS p FROM val_h) b)
       SELECT (SELECT u FROM g ORDER BY f1 DESC, u LIMIT 1) AS umbral_f1, (SELECT max(f1) FROM g) AS f1,
         (SELECT u FROM g ORDER BY costo, u LIMIT 1) AS umbral_costo, (SELECT min(costo) FROM g) AS costo""".replace(
        "WITH g AS", ", g AS"), "val_h"))
def m09(spark, sf_dir):
    """Thresholds are chosen on the validation months; the holdout only measures them."""
    return E.threshold_grid(validation(spark, sf_dir), "prob", "devuelta")


def forecast_frame(m):
    """Return-rate series per branch-month with two forecasts: naive lag-1 (M-19 baseline)
    and the complete mean of the 3 previous months (W-5)."""
    b = branch_month(m).select("id_filial", "anio_mes", "tasa_dev_valor")
    b = W.mean_prev3_complete(b, ["id_filial"], "anio_mes", "tasa_dev_valor", "media_3m")
    return b.withColumn("naive_lag1", F.lag("tasa_dev_valor", 1).over(Window.partitionBy("id_filial").orderBy("anio_mes")))


CTES["fc_frame"] = (["branch_month"], """SELECT id_filial, anio_mes, tasa_dev_valor,
    CASE WHEN count(tasa_dev_valor) OVER w3 = 3 THEN avg(tasa_dev_valor) OVER w3 END AS media_3m,
    lag(tasa_dev_valor, 1) OVER w AS naive_lag1 FROM branch_month
    WINDOW w AS (PARTITION BY id_filial ORDER BY anio_mes),
    w3 AS (PARTITION BY id_filial ORDER BY anio_mes ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")


def _fm_sql(col):
    return f"""SELECT '{col}' AS modelo, CAST(count(*) AS BIGINT) AS n_periodos,
      round(sum(abs({col} - tasa_dev_valor)) / sum(abs(tasa_dev_valor)), 9) AS wmape,
      round(sum(abs({col} - tasa_dev_valor)) / count(*), 9) AS mae,
      round(sqrt(sum(({col} - tasa_dev_valor) * ({col} - tasa_dev_valor)) / count(*)), 9) AS rmse,
      round(sum({col} - tasa_dev_valor) / greatest(sum(abs(tasa_dev_valor)), 1e-9), 9) AS sesgo_pct
      FROM fc_frame WHERE anio_mes > {K.CUT_VALID} AND {col} IS NOT NULL AND tasa_dev_valor IS NOT NULL"""


@query("m10_m19_forecast_metrics_vs_naive", sql(
    f"""SELECT modelo, n_periodos, wmape, round(1.0 - wmape, 9) AS precision_forecast, mae, rmse, sesgo_pct,
       round((max(wmape) FILTER (WHERE modelo = 'naive_lag1') OVER () - wmape) * 100, 6) AS mejora_pp FROM
       ({_fm_sql('media_3m')} UNION ALL {_fm_sql('naive_lag1')}) t""", "fc_frame"))
def m10(spark, sf_dir):
    f = forecast_frame(model(spark, sf_dir)).filter(HOLDOUT())
    rows = []
    for col in ("media_3m", "naive_lag1"):
        mt = E.forecast_metrics(f, "tasa_dev_valor", col)
        rows.append(mt.select(F.lit(col).alias("modelo"), "*"))
    u = rows[0].unionByName(rows[1])
    u = u.select("modelo", "n_periodos", *[F.round(c, 9).alias(c) for c in
                                           ("wmape", "precision_forecast", "mae", "rmse", "sesgo_pct")])
    base = u.filter(F.col("modelo") == "naive_lag1").select(F.col("wmape").alias("_b"))
    return u.crossJoin(base).withColumn("mejora_pp", F.round((F.col("_b") - F.col("wmape")) * 100, 6)).drop("_b") \
        .withColumn("precision_forecast", F.round(F.lit(1.0) - F.col("wmape"), 9))


CTES["ev_real"] = (["ev", "fc", "dim_producto", "dim_transportista"], f"""SELECT f.id_linea, f.devuelta,
    (4.0 + 25.0 * CAST(p.cadena_frio = 1 AND t.control_frio = 0 AS INT)
     + 12.0 * CAST(f.dias_a_vencer < 180 AS INT)) / 100.0 AS p_real
    FROM fc f JOIN dim_producto p USING (id_producto) JOIN dim_transportista t USING (id_transportista)
    WHERE f.anio_mes > {K.CUT_VALID}""")


@query("m14_reference_score_auc_ceiling", sql(_AUC_SQL.format(
    h="(SELECT p_real AS s, count(*) AS n, sum(devuelta) AS pos FROM ev_real GROUP BY 1)"), "ev_real"))
def m14(spark, sf_dir):
    from starmetrics.plans.windows_q import fc_lines
    m = model(spark, sf_dir)
    d = (fc_lines(m).filter(HOLDOUT()).join(m.products.select("id_producto", "cadena_frio"), "id_producto")
         .join(m.carriers.select("id_transportista", "control_frio"), "id_transportista"))
    p_real = (F.lit(4.0) + F.lit(25.0) * ((F.col("cadena_frio") == 1) & (F.col("control_frio") == 0)).cast("int")
              + F.lit(12.0) * (F.col("dias_a_vencer") < 180).cast("int")) / 100.0
    return E.roc_auc(d.withColumn("p_real", p_real), "p_real", "devuelta")


@query("m20_cumulative_gains_curve", sql(
    """SELECT tramo, tramo * 10 AS pct_revisado, CAST(sum(pos) OVER (ORDER BY tramo) AS DOUBLE) / CAST(p AS DOUBLE)
       AS captura_acumulada FROM (SELECT CAST(ceil(pos_ * 10.0 / n) AS INT) AS tramo, sum(devuelta) AS pos, max(p) AS p
       FROM (SELECT devuelta, row_number() OVER (ORDER BY prob DESC, id_linea) AS pos_ FROM ev) r
       CROSS JOIN (SELECT count(*) AS n, sum(devuelta) AS p FROM ev) c GROUP BY 1) t""", "ev"))
def m20(spark, sf_dir):
    return E.gains_curve(holdout(spark, sf_dir), "prob", "devuelta", "id_linea")


@query("m21_calibration_check", sql(
    f"""SELECT {_SPLIT_SQL} AS particion, round(avg(prob), 12) AS prob_media, round(avg(devuelta), 12) AS tasa_observada
       FROM line_risk GROUP BY 1""", "line_risk"))
def m21(spark, sf_dir):
    lr = line_risk(model(spark, sf_dir))
    return lr.groupBy(split_col().alias("particion")).agg(F.round(F.avg("prob"), 12).alias("prob_media"),
                                                          F.round(F.avg("devuelta"), 12).alias("tasa_observada"))
