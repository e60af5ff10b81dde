"""Registered queries: scalar expressions over whole source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register
from loomledger.testbed.landing import e, pick

# Texts an oracle can judge with its own cast rules, by position.
DATE_TEXTS = [
    "2024-03-05T10:20:30", "2024-03-05 10:20:30.250", "2024-03-05", "2024-3-5", "2024/03/05", "2024",
    "2024-03", "12:30", " 2024-03-05 ", "2024-03-05T10:20:30+02:00", "2024-03-05T10:20:30Z", "2024-03-05 10",
    "1709634030", "170963403", "03/05/2024", "05-03-2024", "13/45/2024", "2024-02-30", "2024-03-05 trailing", "",
    "20240305", "2024-03-05T10:20", None,
]
NUMBER_TEXTS = ["12", "12.5", "-3.25", "1e3", " 7 ", "abc", "", "12d", "0.005", "99999999999999999999", "-0.125", None]
CURRENCY_TEXTS = ["eur", "EUR", "usd", "EURO", "Pounds", "", "SEKr", "gbp", None, "chf"]
COUNTRY_TEXTS = ["gb", "GB", "XX", "", "uk", "li", "US", None, "de"]


def sql_list(values: list[str | None]) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def rotating(table: str, key: str, values: list[str | None]):
    """Whole table, each row given one of the texts by its key."""
    def build(spark, sf_dir: str) -> DataFrame:
        rows = ld.Tables(spark, sf_dir)(table)
        return rows.select(F.col(key), pick(values, F.col(key) % len(values)).alias("raw"))
    return build


def rotating_sql(table: str, key: str, values: list[str | None]) -> str:
    return f"(SELECT {key}, ({sql_list(values)})[{key} % {len(values)} + 1] AS raw FROM {table})"


def scalar(name: str, table: str, key: str, values: list[str | None], out: str, column, body: str, kinds=None) -> None:
    rows = rotating(table, key, values)
    register(name, lambda s, d: rows(s, d).select(key, column(F.col("raw")).alias(out)), f"{key} {out}",
             f"SELECT {key}, {body} AS {out} FROM {rotating_sql(table, key, values)}", kinds)


# --- text in payloads -------------------------------------------------------

def _props(s, d: str) -> DataFrame:
    return ld.Tables(s, d)("events").select("event_id", "props")


register("json_string_default",
         lambda s, d: _props(s, d).select("event_id", c.json_text(F.col("props"), "k").alias("k"),
                                          c.json_text(F.col("props"), "absent", "unknown").alias("fallback")),
         "event_id k fallback",
         "SELECT event_id, json_extract_string(props, '$.k') AS k, "
         "coalesce(json_extract_string(props, '$.absent'), 'unknown') AS fallback FROM events")
register("json_number",
         lambda s, d: _props(s, d).select("event_id", c.json_number(F.col("props"), "k").alias("number"),
                                          c.json_number(F.col("props"), "absent").alias("rate")),
         "event_id number rate",
         "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS number, "
         "TRY_CAST(json_extract_string(props, '$.absent') AS DOUBLE) AS rate FROM events")
scalar("text_to_number", "lineitem", "l_orderkey", NUMBER_TEXTS, "number", c.to_number, "TRY_CAST(raw AS DOUBLE)")
scalar("clean_amount", "lineitem", "l_orderkey", NUMBER_TEXTS, "amount", lambda raw: c.to_money(c.to_number(raw)),
       "TRY_CAST(TRY_CAST(raw AS DOUBLE) AS DECIMAL(18,2))")
scalar("whole_number", "lineitem", "l_orderkey", ["300.5", "301.5", "12", "abc", None, "-2.5"], "quantity",
       lambda raw: c.or_default(c.to_whole(c.to_number(raw)), 1),
       "coalesce(TRY_CAST(TRY_CAST(raw AS DOUBLE) AS BIGINT), 1)")
scalar("clean_currency", "lineitem", "l_orderkey", CURRENCY_TEXTS, "currency", c.currency,
       "CASE WHEN upper(raw) IN ('GBP','EUR','CHF','SEK','NOK','DKK','ISK','USD','CAD') THEN upper(raw) END")
scalar("country_allowlist", "orders", "o_orderkey", COUNTRY_TEXTS, "country_code", c.country,
       "CASE WHEN upper(raw) IN ('GB','LI','US','DE') THEN upper(raw) END")
scalar("empty_to_null", "orders", "o_orderkey", ["", "x", " ", None], "raw_text", c.blank_to_null, "NULLIF(raw, '')")
scalar("lower_status", "orders", "o_orderkey", ["Active", "CLOSED", None, "paused"], "status", F.lower, "lower(raw)")
scalar("parse_date", "lineitem", "l_orderkey", DATE_TEXTS, "parsed", c.parse_date,
       "CASE WHEN TRY_CAST(raw AS TIMESTAMP) IS NOT NULL THEN TRY_CAST(raw AS TIMESTAMP) "
       "WHEN regexp_matches(raw, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(left(raw, 10) AS TIMESTAMP) "
       "WHEN regexp_matches(raw, '^[0-9]{10}$') THEN make_timestamp(CAST(raw AS BIGINT) * 1000000) END")
register("null_defaults",
         lambda s, d: ld.Tables(s, d)("events").select(
             "event_id",
             c.or_default(F.when(F.col("event_id") % 3 == 0, F.col("event_type")), "unknown").alias("plan_id"),
             c.null_label(F.when(F.col("event_id") % 5 == 0, F.lit("EUR"))).alias("currency")),
         "event_id plan_id currency",
         "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'unknown' END AS plan_id, "
         "CASE WHEN event_id % 5 = 0 THEN 'EUR' ELSE '(null)' END AS currency FROM events")

# --- numbers ----------------------------------------------------------------

register("negative_to_null",
         lambda s, d: ld.Tables(s, d)("customer").select(
             "c_custkey", c.not_negative(c.to_money(F.col("c_acctbal"))).alias("balance")),
         "c_custkey balance",
         "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance FROM customer")
register("score_range",
         lambda s, d: ld.Tables(s, d)("part").select(
             "p_partkey", c.credit_score((F.col("p_partkey") % 1200).cast("double")).alias("credit_score")),
         "p_partkey credit_score",
         "SELECT p_partkey, CASE WHEN p_partkey % 1200 BETWEEN 300 AND 850 THEN p_partkey % 1200 END AS credit_score FROM part")
register("safe_ratio",
         lambda s, d: ld.Tables(s, d)("lineitem").select(
             "l_orderkey", "l_linenumber", "l_partkey",
             c.ratio(F.col("l_extendedprice"), F.floor(F.col("l_discount") * 100), 100).alias("pct")),
         "l_orderkey l_linenumber l_partkey pct",
         "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE WHEN floor(l_discount * 100) <> 0 "
         "THEN l_extendedprice * 100 / floor(l_discount * 100) END AS pct FROM lineitem")
register("rounding",
         lambda s, d: ld.Tables(s, d)("events").select("event_id", F.round("value", 1).alias("pct")),
         "event_id pct", "SELECT event_id, round(value, 1) AS pct FROM events")

# --- rates and currencies ---------------------------------------------------

_FX = "transaction_id base_currency quote_currency"


def _fx(s, d: str) -> DataFrame:
    return ld.warehouse(s, d).staged("fx_transactions")


register("currency_pair",
         lambda s, d: _fx(s, d).select(
             "transaction_id",
             c.currency_pair(F.col("base_currency"), F.col("quote_currency")).alias("joined"),
             c.currency_pair(F.col("base_currency"), F.col("quote_currency"), "/").alias("slashed")),
         "transaction_id joined slashed",
         "SELECT transaction_id, base_currency || quote_currency AS joined, base_currency || '/' || quote_currency AS slashed "
         "FROM s_fx_transactions")
register("rate_harmonise",
         lambda s, d: _fx(s, d).select("transaction_id", c.harmonised_rate(F.col("rate")).alias("effective_rate")),
         "transaction_id effective_rate",
         "SELECT transaction_id, CASE WHEN rate > 10 THEN 1 / rate ELSE rate END AS effective_rate FROM s_fx_transactions")
register("quote_or_estimate",
         lambda s, d: _fx(s, d).select("transaction_id", c.quote_or_estimate(
             F.col("quote_amount"), F.col("base_amount"), F.col("rate")).alias("estimated_quote")),
         "transaction_id estimated_quote",
         "SELECT transaction_id, coalesce(CAST(quote_amount AS DOUBLE), CAST(base_amount AS DOUBLE) * rate) AS estimated_quote "
         "FROM s_fx_transactions")


def _eur_value(s, d: str) -> DataFrame:
    from loomledger.plans.intermediate import eur_rates, with_eur_rate

    w = ld.warehouse(s, d)
    rated = with_eur_rate(w.staged("subscriptions").select("subscription_id", "mrr_amount", "currency"),
                          eur_rates(w.staged("fx_transactions")))
    return rated.select("subscription_id", c.to_eur(
        F.col("mrr_amount"), F.col("currency"), F.col("rate_to_eur")).alias("eur_amount"))


register("fx_convert", _eur_value, "subscription_id eur_amount",
         "SELECT subscription_id, mrr_eur AS eur_amount FROM mrr")

# --- time -------------------------------------------------------------------

register("days_between",
         lambda s, d: ld.Tables(s, d)("events").select(
             "event_id", c.days_between(F.col("ts") - F.expr("interval 36 hours"), F.col("ts")).alias("days")),
         "event_id days",
         "SELECT event_id, date_diff('day', ts - INTERVAL 36 HOUR, ts) AS days FROM events")
register("month_bucket",
         lambda s, d: ld.Tables(s, d)("orders").groupBy(c.month_of(F.col("o_orderdate")).alias("month")).agg(
             F.count("*").alias("orders")),
         "month orders",
         "SELECT date_trunc('month', o_orderdate) AS month, count(*) AS orders FROM orders GROUP BY 1")
register("rolling_months",
         lambda s, d: ld.Tables(s, d)("orders").filter(
             F.col("o_orderdate") >= c.months_before(c.ntz("2001-08-01 00:00:00"), 6)).select("o_orderkey"),
         "o_orderkey",
         "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 6 MONTH")
register("interval_days_back",
         lambda s, d: ld.Tables(s, d)("events").select(
             "event_id", c.days_before(F.col("ts"), 30).alias("past_instant")),
         "event_id past_instant", "SELECT event_id, ts - INTERVAL 30 DAY AS past_instant FROM events")
register("lateness_bucket",
         lambda s, d: ld.Tables(s, d)("lineitem").select(
             "l_orderkey", "l_linenumber", "l_partkey",
             c.lateness_bucket(F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey") % 50 - 10)).alias("bucket")),
         "l_orderkey l_linenumber l_partkey bucket",
         "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE WHEN l_partkey % 9 = 0 THEN '30+ days late' "
         "WHEN l_partkey % 50 <= 10 THEN 'on time / early' WHEN l_partkey % 50 <= 17 THEN '1-7 days late' "
         "WHEN l_partkey % 50 <= 40 THEN '8-30 days late' ELSE '30+ days late' END AS bucket FROM lineitem")


def _as_of(s, d: str) -> DataFrame:
    w = ld.warehouse(s, d)
    rows = w.staged("subscriptions").select("subscription_id", w.as_of.alias("as_of"))
    return rows


register("as_of_instant", _as_of, "subscription_id as_of", "SELECT subscription_id, as_of FROM mrr")
