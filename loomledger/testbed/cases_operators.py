"""Registered queries: scans, joins, aggregates, windows and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.operators import keys, latest, shares
from loomledger.plans import intermediate, marts
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register


def wh(s, d: str):
    return ld.warehouse(s, d)


# --- filters ----------------------------------------------------------------

register("status_filter", lambda s, d: wh(s, d).staged("subscriptions").filter(F.col("status") == "active").select(
    "subscription_id", "customer_id"), "subscription_id customer_id",
    "SELECT * FROM s_subscriptions WHERE status = 'active'")


def _period_covers(s, d: str) -> DataFrame:
    w = wh(s, d)
    past = c.days_before(w.as_of, 30)
    return w.staged("subscriptions").filter(
        (F.col("billing_period_start") <= past) & (F.col("billing_period_end") > past)).select("subscription_id")


register("scalar_as_of_filter", _period_covers, "subscription_id",
         "SELECT subscription_id FROM mrr WHERE billing_period_start <= as_of - to_days(30) "
         "AND billing_period_end > as_of - to_days(30)")
register("between_and_in", lambda s, d: ld.Tables(s, d)("orders").filter(
    F.col("o_totalprice").between(50000, 150000) & F.col("o_orderstatus").isin("F", "O")).select("o_orderkey"),
    "o_orderkey", "SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 50000 AND 150000 AND o_orderstatus IN ('F', 'O')")

# --- windows ----------------------------------------------------------------

register("latest_by_key", lambda s, d: latest.first_by(
    ld.Tables(s, d)("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
    [F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey"),
    "o_custkey o_orderkey",
    "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
register("earliest_by_key", lambda s, d: wh(s, d).staged("subscriptions").groupBy("customer_id").agg(
    latest.earliest_value(F.col("subscription_id"), [
        F.col("billing_period_start"), F.col("created_at"), F.col("subscription_id")]).alias("subscription_id")),
    "customer_id subscription_id",
    "SELECT customer_id, subscription_id FROM s_subscriptions QUALIFY row_number() OVER (PARTITION BY customer_id "
    "ORDER BY billing_period_start ASC NULLS LAST, created_at ASC NULLS LAST, subscription_id) = 1")
register("latest_rate_per_base", lambda s, d: intermediate.eur_rates(wh(s, d).staged("fx_transactions")),
         "currency rate_to_eur", "SELECT base_currency AS currency, rate_to_eur FROM eur_rate")
register("latest_approved_application", lambda s, d: marts.latest_application(wh(s, d).staged("loan_applications")),
         "customer_id company_name country_code industry headcount_at_application valuation_at_application arr_at_application",
         "SELECT * FROM funded")
register("top_currency_by_avg", lambda s, d: marts.primary_currency(wh(s, d).staged("account_balances")),
         "customer_id primary_account_currency", "SELECT * FROM main_currency")
register("latest_and_prior", lambda s, d: marts.metric_snapshots(wh(s, d).staged("company_metrics")),
         "customer_id current_headcount current_valuation arr_reported prior_headcount prior_valuation",
         "SELECT * FROM metric_pair", {"prior_valuation": "money"})
register("share_of_total", lambda s, d: shares.with_share(
    ld.Tables(s, d)("customer").select("c_custkey", "c_acctbal"), "c_acctbal", "share").select("c_custkey", "share"),
    "c_custkey share", "SELECT c_custkey, c_acctbal / sum(c_acctbal) OVER () AS share FROM customer")

# --- joins ------------------------------------------------------------------

register("orphan_flag_one_parent", lambda s, d: keys.with_parent(
    wh(s, d).staged("fx_transactions").select("transaction_id", "customer_id"),
    wh(s, d).customer_keys(), "customer_id", "has_customer").select(
        "transaction_id", keys.missing_any("has_customer").alias("is_orphaned")),
    "transaction_id is_orphaned", "SELECT * FROM fct_x")
register("orphan_flag_two_parents", lambda s, d: wh(s, d).fct_repayments().select("repayment_id", "is_orphaned"),
         "repayment_id is_orphaned", "SELECT * FROM fct_r")


def _universe(s, d: str) -> DataFrame:
    w = wh(s, d)
    drawn = intermediate.completed_draws(w.staged("drawdowns"), "facility_id")
    return keys.merge_by_key(w.staged("credit_facilities").select("facility_id", "facility_limit"), drawn, "facility_id")


register("key_universe_join", _universe, "facility_id facility_limit total_drawn_amount",
         "SELECT facility_id, facility_limit, drawn AS total_drawn_amount FROM s_credit_facilities "
         "FULL JOIN drawn_facility USING (facility_id)")
register("lookup_join", lambda s, d: intermediate.with_eur_rate(
    wh(s, d).staged("invoices").select("invoice_id", "currency"),
    intermediate.eur_rates(wh(s, d).staged("fx_transactions"))),
    "currency invoice_id rate_to_eur",
    "SELECT currency, invoice_id, rate_to_eur FROM s_invoices LEFT JOIN eur_rate ON base_currency = currency")
register("inner_join_fact_dimension", lambda s, d: wh(s, d).fct_drawdowns().join(
    wh(s, d).dim_credit_facilities().select("facility_id", "facility_status"), "facility_id").groupBy("facility_status").agg(
        F.count("*").alias("drawdowns"), c.money_sum(F.col("amount")).alias("total_amount")),
    "facility_status drawdowns total_amount",
    "SELECT facility_status, count(*) AS drawdowns, sum(amount) AS total_amount FROM fct_d JOIN "
    "(SELECT facility_id, facility_status FROM dim_f) USING (facility_id) GROUP BY 1")
register("anti_join_relationships", lambda s, d: keys.broken_links(
    wh(s, d).staged("drawdowns"), "facility_id", wh(s, d).staged("credit_facilities"), "facility_id").select(
        "drawdown_id", "facility_id"), "drawdown_id facility_id",
    "SELECT drawdown_id, facility_id FROM s_drawdowns WHERE facility_id IS NOT NULL "
    "AND facility_id NOT IN (SELECT facility_id FROM s_credit_facilities)")

# --- aggregates, sets, top-k --------------------------------------------------

register("decimal_sum", lambda s, d: wh(s, d).staged("credit_facilities").groupBy("customer_id").agg(
    c.money_sum(F.col("facility_limit")).alias("total_limit")), "customer_id total_limit",
    "SELECT customer_id, sum(facility_limit) AS total_limit FROM s_credit_facilities GROUP BY 1")
register("average_with_null_group", lambda s, d: marts.balance_per_currency(wh(s, d).staged("account_balances")),
         "customer_id currency avg_balance",
         "SELECT customer_id, currency, avg(CAST(balance AS DOUBLE)) AS avg_balance FROM s_account_balances GROUP BY 1, 2")
register("filtered_counts", lambda s, d: wh(s, d).staged("repayments").groupBy("status").agg(
    F.count("*").alias("total"), F.count_if(F.col("actual_date").isNotNull()).alias("paid"),
    F.count_if(F.col("currency") == "EUR").alias("in_eur")), "status total paid in_eur",
    "SELECT status, count(*) AS total, count(*) FILTER (actual_date IS NOT NULL) AS paid, "
    "count(*) FILTER (currency = 'EUR') AS in_eur FROM s_repayments GROUP BY 1")
register("global_min_avg_max", lambda s, d: wh(s, d).staged("repayments").agg(
    F.min("due_date").alias("due_date"), F.max("_ingested_at").alias("newest"),
    F.avg(F.col("scheduled_amount").cast("double")).alias("avg_balance")), "due_date newest avg_balance",
    "SELECT min(due_date) AS due_date, max(_ingested_at) AS newest, avg(CAST(scheduled_amount AS DOUBLE)) AS avg_balance "
    "FROM s_repayments")
register("distinct_keys", lambda s, d: keys.distinct_keys(wh(s, d).staged("subscriptions"), "customer_id"),
         "customer_id", "SELECT DISTINCT customer_id FROM s_subscriptions")
register("having_filter", lambda s, d: ld.Tables(s, d)("orders").groupBy("o_custkey").agg(
    F.count("*").alias("orders")).filter(F.col("orders") > 5), "o_custkey orders",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 5")
register("order_by_hidden_aggregate", lambda s, d: ld.Tables(s, d)("lineitem").groupBy("l_suppkey").agg(
    F.count("*").alias("lines"), F.min("l_shipdate").alias("first_ship")).orderBy(
        F.asc("first_ship"), "l_suppkey").limit(10).drop("first_ship"), "l_suppkey lines",
    "SELECT l_suppkey, lines FROM (SELECT l_suppkey, count(*) AS lines, min(l_shipdate) AS f FROM lineitem GROUP BY 1) "
    "ORDER BY f, l_suppkey LIMIT 10")
register("top_k", lambda s, d: ld.Tables(s, d)("orders").orderBy(
    F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice"),
    "o_orderkey o_totalprice",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", {"o_totalprice": "double"})
register("union_distinct", lambda s, d: wh(s, d).staged("credit_facilities").select("facility_id").union(
    wh(s, d).staged("drawdowns").select("facility_id")).distinct(), "facility_id",
    "SELECT facility_id FROM s_credit_facilities UNION SELECT facility_id FROM s_drawdowns")
register("union_all", lambda s, d: wh(s, d).staged("invoices").select("customer_id", "amount").unionByName(
    wh(s, d).staged("drawdowns").select("amount", "customer_id")), "customer_id amount",
    "SELECT customer_id, amount FROM s_invoices UNION ALL SELECT customer_id, amount FROM s_drawdowns")
register("explode_schedule", lambda s, d: intermediate.repayment_schedule(
    wh(s, d).staged("credit_facilities"), strict=False).groupBy("facility_id").agg(
        F.count("*").alias("instalments"), F.sum("installment_amount").alias("total_amount")),
    "facility_id instalments total_amount",
    "SELECT facility_id, count(*) AS instalments, sum(installment_amount) AS total_amount FROM int_schedule GROUP BY 1")


def _sql_surface(s, d: str) -> DataFrame:
    wh(s, d).register_views()
    return s.sql(
        "SELECT country_code, count(*) AS customers, sum(total_facility_limit) AS total_limit "
        "FROM dim_customers GROUP BY country_code")


register("sql_over_models", _sql_surface, "country_code customers total_limit",
         "SELECT country_code, count(*) AS customers, sum(total_facility_limit) AS total_limit FROM dim_c GROUP BY 1")
