"""Registered queries: sources and sinks, each written and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.plans.entities import ENTITIES
from loomledger.plans.marts import MART_NAMES
from loomledger.plans.staging import cleansed, parsed
from loomledger.session import shared_folder
from loomledger.sources import flat, tables
from loomledger.sources.envelope import read_raw_events, route, with_day, with_payload, write_raw_events
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register

# --- scans --------------------------------------------------------------------


def _scan(s, d: str) -> DataFrame:
    """Landed drawdowns plus rows without payload, which the scan must drop."""
    events = ld.raw_events(s, d, "drawdowns")
    hollow = events.filter(F.dayofmonth("_ingested_at") == 5).withColumn("data", F.lit(""))
    absent = events.filter(F.dayofmonth("_ingested_at") == 6).withColumn("data", F.lit(None).cast("string"))
    landed = with_payload(events.unionByName(hollow).unionByName(absent))
    return landed.groupBy("_source", "_entity", "_schema_version").agg(
        F.count("*").alias("events"), F.max("_ingested_at").alias("newest"))


register("raw_scan_filtered", _scan, "_source _entity _schema_version events newest",
         "SELECT 'lending' AS _source, 'drawdowns' AS _entity, CAST(1 AS BIGINT) AS _schema_version, count(*) AS events, "
         "max(_ingested_at) AS newest FROM f_drawdowns")


def _routed(s, d: str) -> DataFrame:
    mixed = ld.raw_events(s, d, "subscriptions").unionByName(ld.raw_events(s, d, "invoices"))
    return route(mixed, ENTITIES["invoices"]).groupBy("_source", "_entity").agg(F.count("*").alias("events"))


register("entity_routing", _routed, "_source _entity events",
         "SELECT 'payments' AS _source, 'invoices' AS _entity, count(*) AS events FROM orders")


def _pruned(s, d: str) -> DataFrame:
    days = ld.raw_events(s, d, "fx_transactions", date(2024, 1, 10), date(2024, 1, 12))
    return days.groupBy(F.to_date("_ingested_at").cast("timestamp_ntz").alias("month")).agg(F.count("*").alias("events"))


register("partition_pruned_scan", _pruned, "month events",
         "SELECT date_trunc('day', _ingested_at) AS month, count(*) AS events FROM f_fx_transactions "
         "WHERE _ingested_at >= TIMESTAMP '2024-01-10 00:00:00' AND _ingested_at < TIMESTAMP '2024-01-13 00:00:00' GROUP BY 1")


def _union_by_name(s, d: str) -> DataFrame:
    events = ld.Tables(s, d)("events")
    old = events.filter(F.col("event_id") % 2 == 0).select("event_id", "user_id")
    new = events.filter(F.col("event_id") % 2 == 1).select("event_type", "event_id")
    return old.unionByName(new, allowMissingColumns=True)


register("union_by_name", _union_by_name, "event_id user_id event_type",
         "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id END AS user_id, "
         "CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type FROM events")

# --- sinks --------------------------------------------------------------------


def _roundtrip(s, d: str) -> DataFrame:
    entity = ENTITIES["account_balances"]
    folder = shared_folder(s, "roundtrip")
    write_raw_events(ld.packed_events(s, d, entity.name, by_day=True), folder, entity)
    rows = cleansed(parsed(read_raw_events(s, folder, entity), entity), entity)
    return rows.select("snapshot_id", "customer_id", "balance", "_ingested_at")


register("raw_events_roundtrip", _roundtrip, "snapshot_id customer_id balance _ingested_at", "SELECT * FROM s_account_balances")


def _rerun(s, d: str) -> DataFrame:
    """The same batches landed twice."""
    entity, folder = ENTITIES["account_balances"], shared_folder(s, "rerun")
    for _ in range(2):
        write_raw_events(ld.packed_events(s, d, entity.name, by_day=True), folder, entity)
    return cleansed(parsed(read_raw_events(s, folder, entity), entity), entity).select("snapshot_id", "customer_id", "balance", "_ingested_at")


register("raw_events_rerun", _rerun, "snapshot_id customer_id balance _ingested_at", "SELECT * FROM s_account_balances")


def _lacking(s, d: str) -> DataFrame:
    """Older files lack an envelope column and are read together with newer ones."""
    entity, folder = ENTITIES["account_balances"], shared_folder(s, "lacking")
    events = ld.packed_events(s, d, entity.name)
    old = F.dayofmonth("_ingested_at") <= 15
    write_raw_events(events.filter(old).drop("_schema_version"), folder, entity)
    write_raw_events(events.filter(~old), folder, entity)
    return read_raw_events(s, folder, entity).groupBy("_schema_version").agg(
        F.count("*").alias("events"), F.max("_ingested_at").alias("newest"))


register("raw_events_missing_column", _lacking, "_schema_version events newest",
         "SELECT CASE WHEN day(_ingested_at) > 15 THEN CAST(1 AS BIGINT) END AS _schema_version, count(*) AS events, "
         "max(_ingested_at) AS newest FROM f_account_balances GROUP BY 1")


def _flat_batches(s, d: str) -> DataFrame:
    """Two batches of the same days with different names and types; the first is landed twice."""
    entity, folder = ENTITIES["company_metrics"], shared_folder(s, "flat-batches")
    rows = ld.BUILDERS[entity.name](ld.Tables(s, d)).select("metric_id", "customer_id", "arr_reported", "_ingested_at")
    first = F.crc32(F.col("metric_id").cast("binary")) % 2 == 0
    for _ in range(2):
        flat.write_flat(rows.filter(first), folder, entity)
    flat.write_flat(rows.filter(~first).withColumnRenamed("customer_id", "customerId")
                    .withColumn("arr_reported", F.col("arr_reported").cast("string")), folder, entity, replace=False)
    return flat.read_flat(s, folder, entity).select(
        "metric_id", F.coalesce("customer_id", "customerId").alias("customer_id"),
        c.to_money(c.to_number(F.col("arr_reported"))).alias("arr_reported"))


register("flat_batches_of_a_day", _flat_batches, "metric_id customer_id arr_reported",
         "SELECT 'M' || event_id AS metric_id, 'C' || user_id AS customer_id, "
         "CAST(round(value * 100) * 12 AS DECIMAL(18,2)) AS arr_reported FROM events")


def _flat_roundtrip(s, d: str) -> DataFrame:
    entity = ENTITIES["company_metrics"]
    folder = shared_folder(s, "flat")
    flat.write_flat(ld.BUILDERS[entity.name](ld.Tables(s, d)).drop("_batch_id"), folder, entity)
    return flat.read_flat(s, folder, entity).select("metric_id", "customer_id", c.to_money(c.to_number(
        F.col("arr_reported"))).alias("arr_reported"))


register("flat_roundtrip", _flat_roundtrip, "metric_id customer_id arr_reported",
         "SELECT 'M' || event_id AS metric_id, 'C' || user_id AS customer_id, "
         "CAST(round(value * 100) * 12 AS DECIMAL(18,2)) AS arr_reported FROM events")


def _flat_drift(s, d: str) -> DataFrame:
    """Three groups of days with different names and types for one entity."""
    entity = ENTITIES["invoices"]
    folder = shared_folder(s, "drift")
    rows = ld.BUILDERS[entity.name](ld.Tables(s, d)).select("invoice_id", "customer_id", "amount", "_ingested_at")
    group = F.dayofmonth("_ingested_at") % 3
    flat.write_flat(rows.filter(group == 0), folder, entity)
    flat.write_flat(rows.filter(group == 1).withColumn("amount", F.col("amount").cast("string"))
                    .withColumnRenamed("customer_id", "customerId"), folder, entity)
    flat.write_flat(rows.filter(group == 2).withColumn("amount", F.round(F.col("amount") * 100).cast("bigint"))
                    .withColumn("channel", F.lit("web")), folder, entity)
    united = flat.read_flat(s, folder, entity)
    return united.select("invoice_id", F.coalesce("customer_id", "customerId").alias("customer_id"),
                         c.to_money(c.to_number(F.col("amount"))).alias("amount"), "channel")


register("flat_type_drift_read", _flat_drift, "invoice_id customer_id amount channel",
         "SELECT CASE WHEN o_orderkey % 199 <> 1 THEN 'I' || o_orderkey END AS invoice_id, 'C' || o_custkey AS customer_id, "
         "CAST(CASE WHEN day(seen) % 3 = 2 THEN round(p * 100) ELSE p END AS DECIMAL(18,2)) AS amount, "
         "CASE WHEN day(seen) % 3 = 2 THEN 'web' END AS channel FROM ("
         "SELECT *, CASE WHEN o_orderkey % 61 = 0 THEN -o_totalprice ELSE o_totalprice END AS p, "
         "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(CASE WHEN o_orderkey % 20 = 3 THEN o_orderkey * 11 % 30 - 45 - o_orderkey % 15 "
         "ELSE o_orderkey * 11 % 30 END AS INTEGER)) AS seen FROM orders)")


def _export(s, d: str) -> DataFrame:
    counts = tables.export_marts(ld.staged_warehouse(s, d, *MART_NAMES), shared_folder(s, "export"))
    return s.createDataFrame(sorted(counts.items()), "mart string, exported bigint")


register("mart_export_rows", _export, "mart exported",
         " UNION ALL ".join(f"SELECT '{m}' AS mart, count(*) AS exported FROM {t}" for m, t in [
             ("dim_customers", "dim_c"), ("dim_credit_facilities", "dim_f"), ("fct_drawdowns", "fct_d"),
             ("fct_repayments", "fct_r"), ("fct_fx_transactions", "fct_x")]))


def _export_roundtrip(s, d: str) -> DataFrame:
    folder = shared_folder(s, "export")
    tables.export_mart(ld.built_models(s, d, "dim_customers").dim_customers(), "dim_customers", folder)
    return s.read.parquet(f"{folder}/dim_customers").select("customer_id", "lifetime_arr", "total_drawn_amount")


register("mart_export_roundtrip", _export_roundtrip, "customer_id lifetime_arr total_drawn_amount", "SELECT * FROM dim_c")


def _external(s, d: str) -> DataFrame:
    folder = shared_folder(s, "external")
    tables.export_mart(ld.built_models(s, d, "fct_repayments").fct_repayments(), "fct_repayments", folder)
    name = "fct_repayments_" + folder.rsplit("-", 1)[1]
    tables.register_external(s, "fct_repayments", f"{folder}/fct_repayments", name)
    return s.sql(f"SELECT status, count(*) AS repayments, sum(actual_amount) AS total_amount FROM {name} GROUP BY status")


register("external_table_read", _external, "status repayments total_amount",
         "SELECT status, count(*) AS repayments, sum(actual_amount) AS total_amount FROM fct_r GROUP BY 1")


def _external_again(s, d: str) -> DataFrame:
    """A table registered over a part of the rows, then over all of them elsewhere."""
    folder, fact = shared_folder(s, "external"), ld.built_models(s, d, "fct_repayments").fct_repayments()
    name = "fct_repayments_" + folder.rsplit("-", 1)[1]
    for part, rows in (("part", fact.filter(F.col("status") == "paid")), ("all", fact)):
        tables.export_mart(rows, "fct_repayments", f"{folder}/{part}")
        tables.register_external(s, "fct_repayments", f"{folder}/{part}/fct_repayments", name)
    return s.sql(f"SELECT status, count(*) AS repayments, sum(actual_amount) AS total_amount FROM {name} GROUP BY status")


register("external_table_replaced", _external_again, "status repayments total_amount",
         "SELECT status, count(*) AS repayments, sum(actual_amount) AS total_amount FROM fct_r GROUP BY 1")


def _by_day(s, d: str) -> DataFrame:
    path = shared_folder(s, "by-day")
    fact = ld.built_models(s, d, "fct_fx_transactions").fct_fx_transactions()
    tables.export_by_day(fact, path, "transaction_date")
    # A second export of one day replaces that day only.
    tables.export_by_day(fact.filter(F.to_date("transaction_date") == "2024-01-05"), path, "transaction_date")
    return s.read.parquet(path).groupBy("year", "month", "day").agg(F.count("*").alias("transactions"))


register("mart_export_by_day", _by_day, "year month day transactions",
         "SELECT year(transaction_date) AS year, month(transaction_date) AS month, day(transaction_date) AS day, "
         "count(*) AS transactions FROM fct_x GROUP BY ALL", {"month": "plain"})
register("day_columns", lambda s, d: with_day(ld.Tables(s, d)("events").select("event_id", "ts"), "ts").drop("ts"),
         "event_id year month day",
         "SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events", {"month": "plain"})


def _views(s, d: str) -> DataFrame:
    ld.built_warehouse(s, d).register_views()
    return s.sql("SELECT facility_status, count(*) AS facilities FROM dim_credit_facilities GROUP BY facility_status")


register("written_marts_as_views", _views, "facility_status facilities",
         "SELECT facility_status, count(*) AS facilities FROM dim_f GROUP BY 1")
