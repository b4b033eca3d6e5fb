"""Benchmark: the whole analytics pipeline at one scale factor.

Runs the headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "pipeline_wall_time", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Every query is executed completely with the ``noop`` sink (all rows computed,
nothing collected).  The first step materialises the stage layer (clean lines
and the sales fact, partitioned by month) in the shared checkpoint folder, as
the pipeline does; the other steps read it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q01_q20_dq_control_registry",
    "b06_fact_ventas",
    "b07_fact_devoluciones",
    "ba01_08_base_measures_region_month",
    "ba09_19_time_intelligence",
    "va01_05_targets_drill_across",
    "va06_16_sellout_and_market_share",
    "va17_20_price_volume_mix",
    "of01_19_offer_measures_by_type",
    "lo01_10_service_level",
    "lo11_20_returns_measures",
    "lo21_27_stock_measures",
    "a14_hierarchy_subtotals_rollup",
    "w12_quantile_risk_bands",
    "w17_pareto_cumulative_with_ties",
    "m06_roc_auc_with_ties",
    "m09_threshold_selection_grid",
    "pr07_pr08_w09_w10_top5_recommendations",
    "v13_automatic_summary_pages",
    "t01_retry_safe_stream_ingestion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("STARMETRICS_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2)))
    from starmetrics.plans.catalog import load_all
    from starmetrics.operators.star import model
    from starmetrics.session import get_session, shared_dir

    spark = get_session(master=f"local[{cpus}]")
    reg = load_all()
    times: dict[str, float] = {}
    t_all = time.time()
    t0 = time.time()
    m = model(spark, sf_dir)
    m.materialize(shared_dir(spark, f"bench-stage-{int(t0)}"))
    times["stage_materialize"] = round(time.time() - t0, 3)
    for key in HEADLINE:
        fn, _ = reg[key]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    m_sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "pipeline_wall_time", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m_sf.group(1)) if m_sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
