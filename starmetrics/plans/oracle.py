"""DuckDB oracle SQL for the registered queries.

The oracle re-derives the same model with plain SQL CTEs over the driver's
views (``lineitem``, ``orders`` …).  Binding expressions are shared text
(``sources.binding``), everything after that is written independently of the
Spark code so that the two sides check each other.

``sql(select, *needs)`` assembles a ``WITH`` chain holding the named CTEs and
their dependencies in order.
"""

from __future__ import annotations

from starmetrics.sources import binding as B


def _exprs(pairs):
    return ", ".join(f"{e} AS {n}" for n, e in pairs)


_ORDER = ", ".join(B.DEDUP_ORDER)

CTES: dict[str, tuple[list[str], str]] = {
    "base": ([], """SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "raw": (["base"], f"SELECT {_exprs(B.SELLIN_EXPRS)} FROM base"),
    "parsed": (["raw"], """SELECT *, CAST(coalesce(try_strptime(trim(fecha_texto), '%Y-%m-%d'),
        try_strptime(trim(fecha_texto), '%d/%m/%Y')) AS DATE) AS fecha FROM raw"""),
    "dedup": (["parsed"], f"""SELECT * FROM parsed WHERE fecha IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id_linea ORDER BY {_ORDER}) = 1"""),
    "classified": (["dedup"], """SELECT * EXCLUDE (unidades, importe_local_c, costo_local_c),
        CASE WHEN importe_local_c < 0 OR unidades < 0 THEN 'NC' ELSE 'FC' END AS tipo_documento,
        CASE WHEN importe_local_c < 0 OR unidades < 0 THEN -1 ELSE 1 END AS signo,
        abs(unidades) AS unidades, abs(importe_local_c) AS importe_local_c,
        abs(costo_local_c) AS costo_local_c FROM dedup"""),
    "med_sku": (["classified"], """SELECT id_producto, quantile_cont(unidades, 0.5) AS med
        FROM classified GROUP BY id_producto"""),
    "fx": (["raw"], "SELECT DISTINCT anio_mes, moneda, _tc_x100 AS tc_x100 FROM raw"),
    "sellin": (["classified", "med_sku", "fx"], """SELECT c.id_linea, c.fecha, c.anio_mes, c.mes_idx,
        c.id_cliente, c.fecha_pedido, c.id_producto, c.id_filial, c.id_deposito,
        CAST(coalesce(c.id_transportista, -1) AS INT) AS id_transportista,
        c.descuento_pct_int, c.tipo_oferta, c.unidades, c.moneda, c.tipo_documento, c.signo,
        CAST(c.unidades > 25 * greatest(m.med, 1.0) AS INT) AS flag_revision,
        CAST(date_trunc('month', c.fecha) AS DATE) AS fecha_mes,
        c.importe_local_c, c.costo_local_c, f.tc_x100,
        CAST(round(CAST(c.importe_local_c * 100 AS DOUBLE) / CAST(f.tc_x100 AS DOUBLE)) AS BIGINT) AS importe_usd_c,
        CAST(round(CAST(c.costo_local_c * 100 AS DOUBLE) / CAST(f.tc_x100 AS DOUBLE)) AS BIGINT) AS costo_usd_c,
        c.lead_time_dias, c.sla_dias, c.entrega_completa,
        CAST(c.entrega_completa = 1 AND c.lead_time_dias <= c.sla_dias AS INT) AS otif,
        c.dias_a_vencer, c.devuelta,
        CAST(CASE WHEN c.devuelta = 1 THEN c.unidades_devueltas_si ELSE 0 END AS BIGINT) AS unidades_devueltas,
        CAST(CASE WHEN c.devuelta = 1 THEN round(
            CAST(CAST(round(CAST(c.importe_local_c * 100 AS DOUBLE) / CAST(f.tc_x100 AS DOUBLE)) AS BIGINT) AS DOUBLE)
            * CAST(c.unidades_devueltas_si AS DOUBLE) / CAST(c.unidades AS DOUBLE)) ELSE 0 END AS BIGINT)
            AS importe_devuelto_usd_c,
        CASE WHEN c.devuelta = 1 THEN CAST(c.motivo_idx + 1 AS INT) END AS id_motivo,
        c.motivo_idx
        FROM classified c JOIN med_sku m USING (id_producto) JOIN fx f USING (anio_mes, moneda)"""),
    "fv": (["sellin"], """SELECT fecha, id_cliente, id_producto, id_filial, id_deposito, id_transportista,
        tipo_oferta, tipo_documento,
        CAST(sum(unidades) AS BIGINT) AS unidades, CAST(sum(importe_usd_c) AS BIGINT) AS importe_usd_c,
        CAST(sum(costo_usd_c) AS BIGINT) AS costo_usd_c, CAST(sum(importe_local_c) AS BIGINT) AS importe_local_c,
        CAST(count(*) AS BIGINT) AS lineas, CAST(sum(otif) AS BIGINT) AS lineas_otif,
        CAST(sum(entrega_completa) AS BIGINT) AS lineas_completas,
        CAST(sum(lead_time_dias) AS BIGINT) AS lead_time_dias_x_linea,
        CAST(sum(unidades_devueltas) AS BIGINT) AS unidades_devueltas,
        CAST(sum(importe_devuelto_usd_c) AS BIGINT) AS importe_devuelto_usd_c,
        CAST(sum(devuelta) AS BIGINT) AS lineas_devueltas,
        CAST(sum(flag_revision) AS BIGINT) AS lineas_en_revision,
        CAST(sum(dias_a_vencer) AS BIGINT) AS dias_a_vencer_x_linea,
        CASE WHEN tipo_documento = 'NC' THEN -1 ELSE 1 END AS signo,
        CAST(year(fecha) * 100 + month(fecha) AS INT) AS anio_mes
        FROM sellin GROUP BY ALL"""),
    "dim_filial": ([], f"""SELECT {_exprs(B.BRANCH_EXPRS)} FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "dim_deposito": ([], f"SELECT {_exprs(B.DEPOT_EXPRS)} FROM nation"),
    "raw_producto": ([], f"SELECT {_exprs(B.PRODUCT_EXPRS)} FROM part"),
    "dim_producto": (["raw_producto"], """SELECT p.* EXCLUDE (costo_std_c),
        CAST(round(coalesce(CAST(p.costo_std_c AS DOUBLE), g.gmed, a.amed)) AS BIGINT) AS costo_std_c,
        CAST(p.costo_std_c IS NULL AS INT) AS costo_imputado
        FROM raw_producto p
        LEFT JOIN (SELECT atc3, quantile_cont(costo_std_c, 0.5) AS gmed FROM raw_producto GROUP BY atc3) g
            USING (atc3)
        CROSS JOIN (SELECT quantile_cont(costo_std_c, 0.5) AS amed FROM raw_producto) a"""),
    "raw_cliente": ([], f"SELECT {_exprs(B.CUSTOMER_EXPRS)} FROM customer"),
    "dim_representante": ([], f"SELECT {_exprs(B.REP_EXPRS)} FROM supplier"),
    "dim_cliente": (["raw_cliente", "dim_representante"], """SELECT c.* EXCLUDE (cod_cliente),
        upper(trim(c.cod_cliente)) AS cod_cliente, r.nombre_rep, r.supervisor
        FROM raw_cliente c LEFT JOIN dim_representante r USING (id_representante)"""),
    "raw_transportista": ([], f"SELECT {_exprs(B.CARRIER_EXPRS)} FROM supplier"),
    "dim_transportista": (["raw_transportista"], """SELECT * FROM raw_transportista
        UNION ALL SELECT -1, 'No informado', NULL, 0"""),
    "dim_motivo": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"({i + 1}, '{c}', '{d}', {w}, '{a}', {1 if a in B.AVOIDABLE_AREAS else 0})"
        for i, (c, d, w, a) in enumerate(B.RETURN_REASONS))
        + ") t(id_motivo, cod_motivo, motivo, peso_base, area_responsable, es_evitable)"),
    "dim_tipo_oferta": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"('{c}', '{d}', CAST({m} AS DOUBLE), CAST({r} AS DOUBLE), {i + 1})"
        for i, (c, d, m, r) in enumerate(B.OFFER_TYPES + [B.NO_OFFER]))
        + ") t(cod_tipo_oferta, tipo_oferta_desc, descuento_medio, costo_relativo, id_tipo_oferta)"),
    "seguridad": ([], f"SELECT {_exprs(B.SECURITY_EXPRS)} FROM nation"),
    "ofertas": (["sellin", "dim_cliente", "dim_tipo_oferta"], """SELECT s.id_linea AS id_oferta, s.fecha,
        s.anio_mes, s.id_cliente, s.id_producto, s.tipo_oferta, s.descuento_pct_int,
        s.unidades AS unidades_ofertadas,
        CAST((s.id_producto * 13 + s.id_linea) % 220 AS INT) AS cobertura_cliente_dias,
        CASE WHEN (s.id_linea * 7 + s.id_producto * 3) % 100 < 30 + 4 * s.descuento_pct_int THEN 1 ELSE 0 END
            AS aceptada,
        c.id_filial, t.id_tipo_oferta
        FROM sellin s LEFT JOIN dim_cliente c USING (id_cliente)
        LEFT JOIN dim_tipo_oferta t ON t.cod_tipo_oferta = s.tipo_oferta
        WHERE s.id_linea % 10 <= 2"""),
    "mgrain_fp": (["sellin"], """SELECT anio_mes, id_filial, id_producto,
        CAST(sum(abs(unidades)) AS BIGINT) AS u, CAST(sum(importe_usd_c) AS BIGINT) AS imp
        FROM sellin GROUP BY ALL"""),
    "sellout": (["mgrain_fp"], """SELECT anio_mes, id_filial, id_producto, unidades_sellout, importe_sellout_c,
        CAST(unidades_sellout * (3 + id_filial % 5) AS BIGINT) AS unidades_mercado,
        CAST(importe_sellout_c * (3 + id_filial % 5) AS BIGINT) AS importe_mercado_c,
        make_date(CAST(anio_mes / 100 AS INT), CAST(anio_mes % 100 AS INT), 1) AS fecha
        FROM (SELECT anio_mes, id_filial, id_producto,
            CAST(floor(u * (80 + id_producto % 40) / 100) AS BIGINT) AS unidades_sellout,
            CAST(floor(imp * (80 + id_producto % 40) / 100) AS BIGINT) AS importe_sellout_c FROM mgrain_fp) x
        WHERE NOT (id_filial = 4 AND anio_mes = 199704)"""),
    "objetivos": (["mgrain_fp"], """SELECT anio_mes, id_filial, id_producto,
        CAST(floor(imp * (90 + id_producto % 30) / 100) AS BIGINT) AS objetivo_importe_c,
        CAST(floor(u * (90 + id_producto % 30) / 100) AS BIGINT) AS objetivo_unidades,
        make_date(CAST(anio_mes / 100 AS INT), CAST(anio_mes % 100 AS INT), 1) AS fecha FROM mgrain_fp"""),
    "stock": (["sellin", "dim_producto"], """SELECT g.anio_mes, g.id_deposito, g.id_producto, g.u AS unidades_mes,
        CAST(g.u * (1 + g.id_producto % 5) AS BIGINT) AS stock_unidades,
        CAST(10 + (g.id_producto * 7 + g.id_deposito * 3 + g.anio_mes) % 170 AS INT) AS dias_cobertura,
        CAST(CASE WHEN g.id_producto % 11 = 0 THEN g.u * (1 + g.id_producto % 5) ELSE 0 END AS BIGINT)
            AS unidades_por_vencer_180d,
        CAST(g.u * (1 + g.id_producto % 5) * p.costo_std_c AS BIGINT) AS valor_stock_c,
        make_date(CAST(g.anio_mes / 100 AS INT), CAST(g.anio_mes % 100 AS INT), 1) AS fecha
        FROM (SELECT anio_mes, id_deposito, id_producto, CAST(sum(abs(unidades)) AS BIGINT) AS u
              FROM sellin GROUP BY ALL) g LEFT JOIN dim_producto p USING (id_producto)"""),
    "fdev": (["sellin"], """SELECT fecha, id_cliente, id_producto, id_filial, id_transportista, id_motivo,
        CAST(sum(unidades_devueltas) AS BIGINT) AS unidades_devueltas,
        CAST(sum(importe_devuelto_usd_c) AS BIGINT) AS importe_devuelto_usd_c,
        CAST(count(*) AS BIGINT) AS lineas FROM sellin WHERE devuelta = 1 GROUP BY ALL"""),
    "sales_rec": ([], """SELECT event_id AS id, user_id AS email, CAST(round(value * 100) AS BIGINT) AS usd_c,
        ts AS cuando,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'perpetua' ELSE 'mensual' END
            AS plan FROM events WHERE event_type = 'purchase'"""),
}


def _collect(names, acc, seen):
    for n in names:
        if n in seen:
            continue
        deps, _ = CTES[n]
        _collect(deps, acc, seen)
        seen.add(n)
        acc.append(n)


def sql(select: str, *needs: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """WITH-chain of the CTEs ``needs`` (and dependencies) followed by ``select``.

    ``extra`` adds query-local CTEs (they may depend on the shared ones).
    """
    extra = extra or {}
    saved = {k: CTES.get(k) for k in extra}
    CTES.update(extra)
    try:
        order: list[str] = []
        _collect(list(needs) + list(extra), order, set())
        body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    finally:
        for k, v in saved.items():
            if v is None:
                CTES.pop(k, None)
            else:
                CTES[k] = v
    return (f"WITH {body}\n{select}" if body else select)
