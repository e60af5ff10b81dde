"""Expected results in DuckDB SQL, stated from the source tables alone.

The testbed's defects are modulo rules on keys, so each staged value can be
written down directly; nothing here reads or parses the JSON envelopes.
Shared parts are named common table expressions; ``query`` strings together
the ones a statement needs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from loomledger.generate import rates


def sql_list(values: Sequence[object]) -> str:
    """A list literal of texts and whole numbers."""
    return "[" + ",".join(f"'{value}'" if isinstance(value, str) else str(value) for value in values) + "]"


NOW = "TIMESTAMP '2024-02-15 00:00:00'"
SHIFT = "to_days(9131)"

CURRENCY = "['GBP','EUR','CHF','SEK','NOK','DKK','ISK','USD','CAD','USD',NULL,NULL]"
COUNTRY = "['GB','DE','SE',NULL,NULL,'FR','US',NULL]"
PAIR_BASE = sql_list([base for base, _ in rates.FX_RATES])
PAIR_QUOTE = sql_list([quote for _, quote in rates.FX_RATES])
PAIR_MICRO = sql_list([round(rate * 1_000_000) for rate in rates.FX_RATES.values()])
PLAN = sql_list(rates.PLANS)
PURPOSE = sql_list(rates.PURPOSES).replace("None", "NULL")

# What a column holds decides how it is made comparable.
KINDS: dict[str, set[str]] = {
    "money": {
        "mrr_amount", "amount", "requested_amount", "valuation_at_application", "arr_at_application",
        "facility_limit", "scheduled_amount", "actual_amount", "base_amount", "balance", "valuation",
        "arr_reported", "total_drawn_amount", "installment_amount", "total_facility_limit", "current_valuation",
        "notional_base", "notional_quote", "total_limit", "total_amount", "total_notional_base", "total_drawn",
        "quote_amount",
    },
    "double": {
        "interest_rate", "rate", "current_arr", "arr_growth_pct", "current_utilization_pct", "effective_rate",
        "lifetime_arr", "team_growth_pct", "valuation_increase_multiple", "arr_variance_pct", "avg_util_pct",
        "avg_days", "avg_lag_days", "pct_of_total", "orphan_pct", "arr_to_limit", "invoiced_eur", "rate_to_eur",
        "avg_balance", "utilisation_pct", "growth_pct", "arr", "previous_arr", "lag_avg", "eur_amount", "pct",
        "estimated_quote", "number", "share", "arr_gap_pct",
    },
    "ts": {
        "billing_period_start", "billing_period_end", "created_at", "_ingested_at", "invoice_date", "due_date",
        "paid_at", "application_date", "approval_date", "maturity_date", "drawdown_date", "actual_date",
        "transaction_date", "snapshot_date", "metric_date", "month", "as_of", "parsed", "newest", "past_instant",
        "last_loaded_at",
    },
    "date": {"installment_due_date"},
}
_KIND_OF = {name: kind for kind, names in KINDS.items() for name in names}


def comparable(column: str, kind: str | None = None) -> str:
    """Money as DOUBLE, doubles to ten significant digits, times as text to the microsecond."""
    kind = kind or _KIND_OF.get(column)
    quoted = f'"{column}"'
    if kind == "money":
        return f"CAST({quoted} AS DOUBLE) AS {quoted}"
    if kind == "double":
        value = f"CAST({quoted} AS DOUBLE)"
        rounded = f"CAST(printf('%.9e', {value}) AS DOUBLE)"
        return f"CASE WHEN isfinite({value}) THEN {rounded} ELSE {value} END AS {quoted}"
    if kind == "ts":
        return f"strftime({quoted}, '%Y-%m-%d %H:%M:%S.%f') AS {quoted}"
    if kind == "date":
        return f"strftime({quoted}, '%Y-%m-%d') AS {quoted}"
    return quoted


# --- defects ---------------------------------------------------------------

def ing(day: str, second: str, stale: str, extra: str) -> str:
    return (f"TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(CASE WHEN {stale} THEN {day} - 45 - {extra} "
            f"ELSE {day} END AS INTEGER)) + to_seconds({second})")


def dated(value: str, form: str) -> str:
    return (f"CASE WHEN ({form}) IN (1, 2, 4) THEN NULL WHEN ({form}) = 3 THEN date_trunc('day', {value}) "
            f"ELSE {value} END")


def cust(value: str) -> str:
    return f"CASE WHEN day(_ingested_at) NOT IN (8, 20) THEN {value} END"


def amt(value: str) -> str:
    return f"CAST(CASE WHEN day(_ingested_at) IN (12, 14) THEN round(({value}) * 100) ELSE {value} END AS DECIMAL(18,2))"


def plus(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN {value} END"


def nth(values: str, index: str) -> str:
    return f"({values})[({index}) + 1]"


# --- common table expressions ------------------------------------------------

CTES: dict[str, str] = {}

CTES["s_subscriptions"] = f"""
SELECT * EXCLUDE (k) FROM (
  SELECT event_id AS k, 'S' || event_id AS subscription_id,
    {cust("CASE WHEN event_id % 101 <> 0 THEN 'C' || user_id END")} AS customer_id,
    CASE WHEN event_id % 9 = 0 THEN 'unknown' ELSE 'plan_' || (event_id % 20) END AS plan_id,
    {nth(PLAN, 'event_id % 6')} AS plan_name,
    {amt('value + copy')} AS mrr_amount,
    {nth(CURRENCY, 'event_id % 12')} AS currency,
    CASE event_type WHEN 'signup' THEN 'cancelled' WHEN 'error' THEN 'paused' ELSE 'active' END AS status,
    {dated('t0', 'event_id % 10')} AS billing_period_start,
    {dated('t0 + to_days(30)', '(event_id + 5) % 10')} AS billing_period_end,
    CAST(CASE event_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 12
         WHEN 2 THEN round_even(event_id % 49 + 1.5, 0) ELSE event_id % 49 + 1 END AS BIGINT) AS quantity,
    t0 - to_days(CAST(event_id % 365 AS INTEGER)) AS created_at,
    _ingested_at, CAST(1 AS BIGINT) AS _schema_version
  FROM (
    SELECT *, {ing('event_id * 7 % 30', '(event_id % 86400) + copy', 'event_id % 20 = 7', 'event_id % 15')} AS _ingested_at,
      date_trunc('day', ts) - to_days(CAST(event_id % 4 * 15 AS INTEGER)) AS t0
    FROM (SELECT *, unnest(CASE WHEN event_id % 40 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events)
  ) WHERE event_id % 211 <> 5
) QUALIFY row_number() OVER (PARTITION BY subscription_id ORDER BY _ingested_at DESC) = 1
"""

CTES["s_invoices"] = f"""
SELECT 'I' || o_orderkey AS invoice_id, {cust("'C' || o_custkey")} AS customer_id,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'S' || (o_orderkey % 10000) END AS subscription_id,
  {amt('CASE WHEN o_orderkey % 61 = 0 THEN -o_totalprice ELSE o_totalprice END')} AS amount,
  {nth(CURRENCY, 'o_orderkey % 12')} AS currency,
  {dated('d', 'o_orderkey % 10')} AS invoice_date,
  {dated('d + to_days(14)', '(o_orderkey + 3) % 10')} AS due_date,
  CASE WHEN o_orderstatus <> 'O' THEN
    {dated('d + to_days(CAST(o_orderkey % 19 + 1 AS INTEGER))', '(o_orderkey + 6) % 10')} END AS paid_at,
  CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'void' END AS status,
  '[{{"description":"order ' || o_orderkey || '","amount":' || o_orderkey || ',"currency":"EUR"}}]' AS line_items_json,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (SELECT *, o_orderdate + {SHIFT} AS d,
        {ing('o_orderkey * 11 % 30', 'o_orderkey % 86400', 'o_orderkey % 20 = 3', 'o_orderkey % 15')} AS _ingested_at
      FROM orders)
WHERE o_orderkey % 199 <> 1
"""

CTES["s_loan_applications"] = f"""
SELECT 'A' || c_custkey || '-' || n AS application_id, {cust("'C' || c_custkey")} AS customer_id,
  c_name AS company_name, CASE WHEN c_custkey % 5 <> 0 THEN 'R' || c_custkey END AS company_registration_number,
  {nth(COUNTRY, 'c_nationkey % 8')} AS country_code, c_mktsegment AS industry,
  {amt('c_acctbal')} AS requested_amount, {nth(CURRENCY, 'k % 12')} AS currency,
  {dated("TIMESTAMP '2022-01-01 00:00:00' + to_days(CAST((c_custkey * 7 + n * 100) % 700 AS INTEGER))", 'k % 10')}
    AS application_date,
  CASE WHEN c_custkey % 4 = 0 THEN (['rejected', 'pending', 'cancelled'])[n + 1]
       ELSE (['approved', 'approved', 'rejected'])[n + 1] END AS status,
  CASE WHEN score BETWEEN 300 AND 850 THEN score END AS credit_score,
  (['low', 'medium', 'high', 'N/A'])[k % 4 + 1] AS risk_rating,
  CASE WHEN k % 8 <> 0 THEN c_custkey % 195 + 5 ELSE 0 END AS headcount_at_application,
  CAST(c_custkey * 1000 + 500000 AS DECIMAL(18,2)) AS valuation_at_application,
  CAST(c_custkey * 100 + 200000 AS DECIMAL(18,2)) AS arr_at_application,
  CASE WHEN day(_ingested_at) % 4 = 1 THEN 'ref' || (k % 5) END AS referral_source,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (
  SELECT *, {ing('k * 13 % 30', 'k % 86400', 'k % 20 = 11', 'k % 15')} AS _ingested_at,
    CAST(CASE WHEN c_custkey % 31 = 0 THEN -50
         WHEN c_custkey % 7 = 0 THEN round_even(250.5 + c_custkey % 650, 0) ELSE 250 + c_custkey % 650 END AS BIGINT) AS score
  FROM (SELECT *, c_custkey * 3 + n AS k FROM (SELECT *, unnest(range(0, c_custkey % 3 + 1)) AS n FROM customer))
) WHERE (c_custkey + n) % 97 <> 96
"""

CTES["s_credit_facilities"] = f"""
SELECT 'F' || o_orderkey AS facility_id, {cust("'C' || o_custkey")} AS customer_id,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'A' || o_custkey || '-0' END AS application_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 0.00::DECIMAL(18,2)
       ELSE {amt('o_totalprice + copy')} END AS facility_limit,
  {nth(CURRENCY, 'o_orderkey % 12')} AS currency,
  {dated('d', 'o_orderkey % 10')} AS approval_date,
  {dated('d + to_days(730)', '(o_orderkey + 4) % 10')} AS maturity_date,
  CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'closed' ELSE 'suspended' END AS status,
  (o_orderkey % 100 + 80) / 1000.0::DOUBLE AS interest_rate,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN '[]'
    ELSE '[' || array_to_string(list_transform(range(1, instalments + 1), lambda i:
      '{{"due_date":"' || strftime(d + to_days(CAST(30 * i AS INTEGER)), '%Y-%m-%d') || '","amount":'
      || CAST((o_orderkey % 1000 + 0.25::DOUBLE * i) AS VARCHAR) || '}}'), ',') || ']' END AS repayment_schedule_json,
  CASE WHEN day(_ingested_at) % 4 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END END
    AS collateral_required,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (
  SELECT *, o_orderdate + {SHIFT} AS d, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 3 END AS instalments,
    {ing('o_orderkey * 17 % 30', '(o_orderkey % 86400) + copy', 'o_orderkey % 20 = 13', 'o_orderkey % 15')} AS _ingested_at
  FROM (SELECT *, unnest(CASE WHEN o_orderkey % 25 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM orders)
)
WHERE o_orderkey % 211 <> 0
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY _ingested_at DESC) = 1
"""

_LINE = "(l_orderkey * 7 + l_linenumber)"

CTES["s_drawdowns"] = f"""
SELECT drawdown_id, facility_id, customer_id, amount, currency, drawdown_date, purpose, status,
       _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (
  SELECT *, CASE WHEN l_orderkey % 53 <> 0 THEN 'D' || l_orderkey || '-' || l_linenumber END AS drawdown_id,
    CASE WHEN l_partkey % 103 = 7 THEN NULL WHEN l_partkey % 20 = 3 THEN 'X' || l_orderkey
         ELSE 'F' || l_orderkey END AS facility_id,
    {cust("'C' || l_partkey")} AS customer_id,
    CASE WHEN m % 33 <> 0 THEN {amt('l_extendedprice')} END AS amount,
    {nth(CURRENCY, 'm % 12')} AS currency,
    {dated('d', 'm % 10')} AS drawdown_date,
    ({PURPOSE})[l_linenumber % 5 + 1] AS purpose,
    CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'N' THEN 'pending' ELSE 'failed' END AS status
  FROM (SELECT *, {_LINE} AS m, l_shipdate + {SHIFT} AS d,
          {ing(f'({_LINE} + l_partkey) % 30', '(l_suppkey * 101 + l_partkey) % 86400', 'l_partkey % 20 = 9', 'l_partkey % 15')}
            AS _ingested_at
        FROM lineitem)
) QUALIFY row_number() OVER (PARTITION BY drawdown_id
    ORDER BY _ingested_at DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
"""

CTES["s_repayments"] = f"""
SELECT repayment_id, drawdown_id, facility_id, customer_id, scheduled_amount, actual_amount, currency, due_date,
       actual_date, status, _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (
  SELECT *, 'R' || l_orderkey || '-' || l_linenumber AS repayment_id,
    CASE WHEN l_orderkey % 53 <> 0 THEN 'D' || l_orderkey || '-' || l_linenumber END AS drawdown_id,
    CASE WHEN l_partkey % 50 = 7 THEN 'X' ELSE 'F' END || l_orderkey AS facility_id,
    {cust("'C' || l_partkey")} AS customer_id,
    {amt('l_extendedprice')} AS scheduled_amount,
    CASE WHEN NOT unpaid THEN {amt('l_extendedprice - l_quantity')} END AS actual_amount,
    {nth(CURRENCY, 'm % 12')} AS currency,
    {dated('d - to_days(CAST(m * 5 % 45 - 10 AS INTEGER))', '(m + 2) % 10')} AS due_date,
    CASE WHEN NOT unpaid THEN {dated('d', 'm % 10')} END AS actual_date,
    CASE WHEN m % 40 = 0 THEN 'forgiven' WHEN l_returnflag = 'A' THEN 'paid' WHEN l_returnflag = 'N' THEN 'scheduled'
         ELSE 'overdue' END AS status
  FROM (SELECT *, {_LINE} AS m, l_shipdate + {SHIFT} AS d, (l_linestatus = 'O' AND {_LINE} % 4 = 0) AS unpaid,
          {ing(f'({_LINE} * 3 + l_partkey) % 30', '(l_suppkey * 103 + l_partkey) % 86400', 'l_partkey % 20 = 17', 'l_partkey % 15')}
            AS _ingested_at
        FROM lineitem)
  WHERE l_orderkey % 211 <> 9
) QUALIFY row_number() OVER (PARTITION BY repayment_id
    ORDER BY _ingested_at DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
"""

CTES["s_fx_transactions"] = f"""
SELECT 'T' || event_id AS transaction_id, {cust("'C' || user_id")} AS customer_id,
  CASE WHEN event_id % 70 <> 0 THEN {nth(PAIR_BASE, 'pair')} END AS base_currency,
  {nth(PAIR_QUOTE, 'pair')} AS quote_currency,
  {amt('base_major')} AS base_amount,
  CASE WHEN event_id % 3 <> 0 THEN {amt('floor(base_major * micro / 10000.0::DOUBLE) / 100.0::DOUBLE')} END AS quote_amount,
  CASE WHEN event_id % 90 = 0 THEN NULL WHEN event_id % 95 = 0 THEN -1.0::DOUBLE
       WHEN event_id % 20 = 0 THEN 1000000.0::DOUBLE / micro ELSE micro / 1000000.0::DOUBLE END AS rate,
  CASE WHEN event_id % 10 <> 0 THEN (['spot', 'forward'])[event_id % 2 + 1] END AS rate_type,
  {dated("date_trunc('second', ts)", 'event_id % 10')} AS transaction_date,
  CASE WHEN day(_ingested_at) % 5 <> 0 THEN 'BANKGB2L' END AS counterparty_bank_bic,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (SELECT *, CAST({nth(PAIR_MICRO, 'pair')} AS BIGINT) + (event_id % 7 - 3) * 1000 AS micro,
        CAST(1000 + event_id % 500 * 100 AS DOUBLE) AS base_major,
        {ing('event_id * 19 % 30', 'event_id % 86400', 'event_id % 20 = 1', 'event_id % 15')} AS _ingested_at
      FROM (SELECT *, event_id * 5 % 16 AS pair FROM events))
WHERE event_id % 211 <> 50
"""

CTES["s_account_balances"] = f"""
SELECT 'B' || event_id AS snapshot_id,
  {cust("CASE WHEN event_id % 50 = 3 THEN 'X' ELSE 'C' END || user_id")} AS customer_id,
  'acct_' || user_id || '_' || (event_id % 3 + 1) AS account_id,
  {nth(CURRENCY, 'CASE WHEN event_id % 4 = 0 THEN event_id % 12 ELSE user_id % 12 END')} AS currency,
  CASE WHEN event_id % 41 <> 0 OR value = 0 THEN {amt('round(value * 100)')} END AS balance,
  {dated("date_trunc('day', ts)", 'event_id % 10')} AS snapshot_date,
  (['operating', 'reserve', 'fx'])[event_id % 3 + 1] AS account_type,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (SELECT *, {ing('event_id * 23 % 30', 'event_id % 86400', 'event_id % 20 = 15', 'event_id % 15')} AS _ingested_at
      FROM events)
"""

CTES["s_company_metrics"] = f"""
SELECT 'M' || event_id AS metric_id, {cust("'C' || user_id")} AS customer_id,
  {dated("date_trunc('day', ts)", 'event_id % 10')} AS metric_date,
  CAST(CASE WHEN event_id % 12 = 0 OR event_id % 23 = 0 THEN 0
       WHEN event_id % 5 = 0 THEN round_even(10.5 + event_id % 90, 0) ELSE 10 + event_id % 90 END AS BIGINT) AS headcount,
  {amt('CASE WHEN event_id % 37 = 0 THEN 0 ELSE event_id % 1000 * 500 + 1000000 END')} AS valuation,
  {amt('round(value * 100) * 12')} AS arr_reported,
  _ingested_at, CAST(1 AS BIGINT) AS _schema_version
FROM (SELECT *, {ing('event_id * 29 % 30', 'event_id % 86400', 'event_id % 20 = 19', 'event_id % 15')} AS _ingested_at
      FROM events)
"""

CTES["eur_rate"] = """
SELECT base_currency, rate AS rate_to_eur FROM s_fx_transactions
WHERE quote_currency = 'EUR' AND rate > 0 AND base_currency IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY base_currency
  ORDER BY transaction_date DESC NULLS LAST, transaction_id DESC) = 1
"""

CTES["mrr"] = f"""
SELECT s.*, (SELECT least({NOW}, max(_ingested_at)) FROM s_subscriptions) AS as_of,
  CASE WHEN currency = 'EUR' THEN CAST(mrr_amount AS DOUBLE) ELSE CAST(mrr_amount AS DOUBLE) * r.rate_to_eur END AS mrr_eur
FROM s_subscriptions s LEFT JOIN eur_rate r ON r.base_currency = s.currency
"""

CTES["int_arr"] = """
SELECT customer_id, coalesce(now_mrr * 12, 0) AS current_arr, coalesce(now_n, 0) AS subscription_count,
  CASE WHEN baseline <> 0 THEN (coalesce(now_mrr * 12, 0) - baseline) / baseline * 100 END AS arr_growth_pct
FROM (
  SELECT c.customer_id, n.now_mrr, n.now_n, coalesce(p.past_mrr, f.first_mrr) * 12 AS baseline
  FROM (SELECT DISTINCT customer_id FROM s_subscriptions) c
  LEFT JOIN (SELECT customer_id, coalesce(sum(mrr_eur), 0) AS now_mrr, count(*) AS now_n FROM mrr
             WHERE status = 'active' AND billing_period_end > as_of GROUP BY 1) n USING (customer_id)
  LEFT JOIN (SELECT customer_id, coalesce(sum(mrr_eur), 0) AS past_mrr FROM mrr
             WHERE status = 'active' AND billing_period_start <= as_of - to_days(30)
               AND billing_period_end > as_of - to_days(30) GROUP BY 1) p USING (customer_id)
  LEFT JOIN (SELECT customer_id, mrr_eur AS first_mrr FROM mrr WHERE status = 'active'
             QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY billing_period_start ASC NULLS LAST,
               created_at ASC NULLS LAST, subscription_id) = 1) f USING (customer_id)
)
"""

CTES["drawn_facility"] = """
SELECT facility_id, sum(amount) AS drawn FROM s_drawdowns WHERE status = 'completed' GROUP BY facility_id
"""

CTES["int_util"] = """
SELECT k.facility_id, f.customer_id, f.facility_limit, f.currency, f.status AS facility_status,
  coalesce(d.drawn, 0) AS total_drawn_amount,
  CASE WHEN f.facility_limit <> 0 THEN CAST(coalesce(d.drawn, 0) AS DOUBLE) / CAST(f.facility_limit AS DOUBLE) * 100 END
    AS current_utilization_pct,
  f.facility_id IS NULL AS is_orphaned
FROM (SELECT facility_id FROM s_credit_facilities UNION SELECT facility_id FROM drawn_facility) k
LEFT JOIN s_credit_facilities f USING (facility_id) LEFT JOIN drawn_facility d USING (facility_id)
"""

CTES["int_fx"] = """
SELECT transaction_id, customer_id, base_currency, quote_currency, base_currency || quote_currency AS currency_pair,
  base_amount, coalesce(CAST(quote_amount AS DOUBLE), CAST(base_amount AS DOUBLE) * eff) AS quote_amount,
  eff AS effective_rate, rate_type, transaction_date, FALSE AS is_orphaned
FROM (SELECT *, CASE WHEN rate > 10 THEN 1 / rate ELSE rate END AS eff FROM s_fx_transactions)
"""

CTES["int_schedule"] = f"""
SELECT facility_id, customer_id, currency,
  CAST(d + to_days(CAST(30 * i AS INTEGER)) AS DATE) AS installment_due_date,
  CAST(k % 1000 + 0.25::DOUBLE * i AS DECIMAL(18,3)) AS installment_amount
FROM (SELECT f.*, o_orderkey AS k, o_orderdate + {SHIFT} AS d,
        unnest(range(1, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 4 END)) AS i
      FROM s_credit_facilities f JOIN orders ON 'F' || o_orderkey = f.facility_id
      WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0)
"""

CTES["metric_pair"] = """
SELECT customer_id, max(headcount) FILTER (rn = 1) AS current_headcount, max(valuation) FILTER (rn = 1) AS current_valuation,
  max(arr_reported) FILTER (rn = 1) AS arr_reported, max(headcount) FILTER (rn = 2) AS prior_headcount,
  max(valuation) FILTER (rn = 2) AS prior_valuation
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY metric_date DESC NULLS LAST, metric_id DESC) AS rn
      FROM s_company_metrics) GROUP BY customer_id
"""

CTES["main_currency"] = """
SELECT customer_id, currency AS primary_account_currency
FROM (SELECT customer_id, currency, avg(CAST(balance AS DOUBLE)) AS b FROM s_account_balances GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY b DESC NULLS LAST, currency ASC NULLS LAST) = 1
"""

CTES["funded"] = """
SELECT * FROM s_loan_applications WHERE status = 'approved'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY application_date DESC NULLS LAST, application_id DESC) = 1
"""

CTES["dim_c"] = """
SELECT a.customer_id, company_name, country_code, industry, headcount_at_application, valuation_at_application,
  arr_at_application, coalesce(current_arr, 0) AS lifetime_arr, arr_growth_pct,
  coalesce(lim, 0) AS total_facility_limit, coalesce(drawn, 0) AS total_drawn_amount, primary_account_currency,
  current_headcount, current_valuation,
  CASE WHEN prior_headcount <> 0 THEN (current_headcount - prior_headcount) * 100.0::DOUBLE / prior_headcount END AS team_growth_pct,
  CASE WHEN prior_valuation <> 0 THEN CAST(current_valuation AS DOUBLE) / CAST(prior_valuation AS DOUBLE) END
    AS valuation_increase_multiple,
  CASE WHEN current_arr <> 0 THEN (CAST(arr_reported AS DOUBLE) - current_arr) * 100 / current_arr END AS arr_variance_pct,
  FALSE AS is_orphaned
FROM funded a
LEFT JOIN int_arr USING (customer_id)
LEFT JOIN (SELECT customer_id, sum(facility_limit) AS lim FROM s_credit_facilities WHERE status = 'active' GROUP BY 1)
  USING (customer_id)
LEFT JOIN (SELECT customer_id, sum(amount) AS drawn FROM s_drawdowns WHERE status = 'completed' GROUP BY 1)
  USING (customer_id)
LEFT JOIN main_currency USING (customer_id)
LEFT JOIN metric_pair USING (customer_id)
"""

CTES["dim_f"] = """
SELECT f.facility_id, f.application_id, f.customer_id, f.facility_limit, f.currency, f.approval_date, f.maturity_date,
  f.status AS facility_status, f.interest_rate, u.current_utilization_pct,
  f.customer_id IS NULL OR f.customer_id NOT IN (SELECT customer_id FROM funded WHERE customer_id IS NOT NULL) AS is_orphaned
FROM s_credit_facilities f LEFT JOIN int_util u USING (facility_id)
"""


def _orphan(parents: tuple[str, ...]) -> str:
    tests = {
        "facility": "coalesce(facility_id NOT IN (SELECT facility_id FROM s_credit_facilities), TRUE)",
        "customer": "coalesce(customer_id NOT IN (SELECT customer_id FROM funded WHERE customer_id IS NOT NULL), TRUE)",
    }
    return "(" + " OR ".join(tests[p] for p in parents) + ") AS is_orphaned"


CTES["fct_d"] = f"""
SELECT drawdown_id, d.facility_id, d.customer_id, amount, d.currency, drawdown_date, purpose, d.status,
  date_diff('day', f.approval_date, drawdown_date) AS days_since_facility_approval,
  {_orphan(("facility", "customer")).replace("(facility_id", "(d.facility_id").replace("(customer_id NOT", "(d.customer_id NOT")}
FROM s_drawdowns d LEFT JOIN (SELECT facility_id, approval_date FROM s_credit_facilities) f ON f.facility_id = d.facility_id
"""

CTES["fct_r"] = f"""
SELECT repayment_id, drawdown_id, facility_id, customer_id, scheduled_amount, actual_amount, currency, due_date,
  actual_date, date_diff('day', due_date, actual_date) AS scheduled_vs_actual_lag_days, status,
  {_orphan(("facility", "customer"))}
FROM s_repayments
"""

CTES["fct_x"] = f"""
SELECT transaction_id, customer_id, base_currency, quote_currency, base_currency || '/' || quote_currency AS currency_pair,
  base_amount AS notional_base, quote_amount AS notional_quote, rate AS effective_rate, rate_type, transaction_date,
  {_orphan(("customer",))}
FROM s_fx_transactions
"""


CTES["monthly_arr"] = """
SELECT customer_id, date_trunc('month', billing_period_start) AS month, coalesce(sum(mrr_eur), 0) * 12 AS arr
FROM mrr WHERE status = 'active' AND customer_id IS NOT NULL AND billing_period_start IS NOT NULL GROUP BY 1, 2
"""


# Ingestion times of all landed rows, with or without a key.
CTES["f_subscriptions"] = f"SELECT {ing('event_id * 7 % 30', 'event_id % 86400 + CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END', 'event_id % 20 = 7', 'event_id % 15')} AS _ingested_at FROM events"
CTES["f_invoices"] = f"SELECT {ing('o_orderkey * 11 % 30', 'o_orderkey % 86400', 'o_orderkey % 20 = 3', 'o_orderkey % 15')} AS _ingested_at FROM orders"
CTES["f_loan_applications"] = f"SELECT {ing('k * 13 % 30', 'k % 86400', 'k % 20 = 11', 'k % 15')} AS _ingested_at FROM (SELECT c_custkey * 3 + unnest(range(0, c_custkey % 3 + 1)) AS k FROM customer)"
CTES["f_credit_facilities"] = f"SELECT {ing('o_orderkey * 17 % 30', 'o_orderkey % 86400 + CASE WHEN o_orderkey % 25 = 0 THEN 1 ELSE 0 END', 'o_orderkey % 20 = 13', 'o_orderkey % 15')} AS _ingested_at FROM orders"
CTES["f_drawdowns"] = f"SELECT {ing(f'({_LINE} + l_partkey) % 30', '(l_suppkey * 101 + l_partkey) % 86400', 'l_partkey % 20 = 9', 'l_partkey % 15')} AS _ingested_at FROM lineitem"
CTES["f_repayments"] = f"SELECT {ing(f'({_LINE} * 3 + l_partkey) % 30', '(l_suppkey * 103 + l_partkey) % 86400', 'l_partkey % 20 = 17', 'l_partkey % 15')} AS _ingested_at FROM lineitem"
CTES["f_fx_transactions"] = f"SELECT {ing('event_id * 19 % 30', 'event_id % 86400', 'event_id % 20 = 1', 'event_id % 15')} AS _ingested_at FROM events"
CTES["f_account_balances"] = "SELECT _ingested_at FROM s_account_balances"
CTES["f_company_metrics"] = "SELECT _ingested_at FROM s_company_metrics"


def _needed(sql: str) -> list[str]:
    """Names of the common parts a statement uses, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, body in CTES.items():
            if name not in found and re.search(rf"\b{name}\b", text):
                found.add(name)
                pending.append(body)
    return [name for name in CTES if name in found]


def query(columns: list[str], body: str, kinds: dict[str, str] | None = None) -> str:
    """A complete statement with comparable output columns."""
    kinds = kinds or {}
    parts = ", ".join(f"{name} AS ({CTES[name].strip()})" for name in _needed(body))
    outputs = ", ".join(comparable(name, kinds.get(name)) for name in columns)
    lead = f"WITH {parts} " if parts else ""
    return f"{lead}SELECT {outputs} FROM ({body.strip()})"
