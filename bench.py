"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. The landing
(raw events derived from the tables) is written first and reported apart;
every query then runs from raw events through all the layers it needs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loomledger.session import build_session, shared_folder  # noqa: E402
from loomledger.sources.tables import build  # noqa: E402
from loomledger.testbed import landing  # noqa: E402
from loomledger.testbed.catalog import load  # noqa: E402

HEADLINE = [
    "stg_payments__subscriptions", "stg_payments__invoices", "stg_lending__loan_applications",
    "stg_lending__credit_facilities", "stg_lending__drawdowns", "stg_lending__repayments",
    "stg_banking__fx_transactions", "stg_banking__account_balances", "stg_crm__company_metrics",
    "int_arr_per_customer", "int_facility_utilization", "int_fx_rates_normalized", "int_repayment_schedule",
    "dim_customers", "dim_credit_facilities", "fct_drawdowns", "fct_repayments", "fct_fx_transactions",
    "q01_top_customers_by_limit", "q03_drawdowns_per_month", "q04_repayment_lateness", "q05_fx_by_pair",
    "q12_orphan_census", "q13_repayment_watchlist", "q24_arr_by_month",
    "strict_staging", "parse_date", "gen_drawdowns",
]


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("count(*)").collect()

    catalog = load()
    landed = timed(lambda: landing.fully_landed(spark, sf_dir))
    queries = {name: timed(lambda: run(catalog[name].build(spark, sf_dir))) for name in HEADLINE}
    queries["warehouse_build"] = timed(
        lambda: build(landing.warehouse(spark, sf_dir), shared_folder(spark, "bench")))
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "landing": landed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
