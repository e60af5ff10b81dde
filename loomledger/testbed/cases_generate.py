"""Registered queries: generated data, one customer per row of ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.generate import entities as g
from loomledger.generate import rates
from loomledger.generate.dirt import drift_key, generate
from loomledger.plans.entities import ENTITIES
from loomledger.plans.staging import stage
from loomledger.session import shared_folder
from loomledger.sources.envelope import read_raw_events, write_raw_events
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register
from loomledger.testbed.oracle import CTES, PAIR_BASE, PAIR_QUOTE, sql_list

PLAN = g.Plan()


def master(s, d: str) -> DataFrame:
    return g.customers(ld.Tables(s, d)("customer"), "c_custkey", PLAN)


def rows(name: str):
    return lambda s, d: g.GENERATORS[name](master(s, d), PLAN)


# --- expected draws -------------------------------------------------------------

def digest(kind: str, purpose: str, *key: str) -> str:
    return f"md5(concat_ws('|', '42|{kind}|{purpose}', {', '.join(key)}))"


def u(kind: str, purpose: str, *key: str) -> str:
    return f"(CAST('0x' || substr({digest(kind, purpose, *key)}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def whole(kind: str, purpose: str, low: str | int, high: str | int, *key: str) -> str:
    return f"(({low}) + CAST(floor({u(kind, purpose, *key)} * (({high}) - ({low}) + 1)) AS BIGINT))"


def uuid(kind: str, purpose: str, *key: str) -> str:
    return f"regexp_replace({digest(kind, purpose, *key)}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _cu(purpose: str) -> str:
    return u("customer", purpose, "k")


def _range(values: tuple[object, object, object]) -> str:
    return f"CASE segment WHEN 'seed' THEN {values[0]} WHEN 'growth' THEN {values[1]} ELSE {values[2]} END"


CTES["gen_master"] = f"""
SELECT k, {uuid('customer', 'id', 'k')} AS customer_id, 'Company ' || substr({digest('customer', 'name', 'k')}, 1, 16) AS company_name,
  ({sql_list([country for country, _ in rates.MARKETS])})[market + 1] AS country_code,
  ({sql_list([currency for _, currency in rates.MARKETS])})[market + 1] AS home_currency,
  segment, arr AS target_arr,
  CAST(floor_limit + floor({_cu('limit')} * (floor(least(top_limit, arr * 0.7::DOUBLE)) - floor_limit + 1)) AS DOUBLE) AS target_limit,
  floor((low_growth + {_cu('growth')} * (high_growth - low_growth)) * 100) / 100.0::DOUBLE AS arr_growth,
  low_draws + CAST(floor({_cu('drawdowns')} * (high_draws - low_draws + 1)) AS BIGINT) AS drawdown_count,
  CASE WHEN {_cu('facilities')} < 0.75 THEN 1 WHEN {_cu('facilities')} < 0.95 THEN 2 ELSE 3 END::BIGINT AS facility_count,
  {whole('customer', 'subscriptions', 15, 44, 'k')} AS subscription_count,
  {whole('customer', 'headcount', 5, 199, 'k')} AS headcount_at_application,
  {whole('customer', 'valuation', 500000, 49999999, 'k')} AS valuation_at_application
FROM (
  SELECT *, CAST({_range((200000, 1000000, 20000000))} + floor({_cu('arr')} * (
      {_range((1000000, 20000000, 80000000))} - {_range((200000, 1000000, 20000000))} + 1)) AS DOUBLE) AS arr,
    CAST({_range((50000, 500000, 5000000))} AS DOUBLE) AS floor_limit, CAST({_range((500000, 5000000, 20000000))} AS DOUBLE) AS top_limit,
    CAST({_range((0.8, 1.5, 0.4))} AS DOUBLE) AS low_growth, CAST({_range((1.5, 3.0, 1.0))} AS DOUBLE) AS high_growth,
    {_range((1, 3, 5))} AS low_draws, {_range((3, 7, 12))} AS high_draws
  FROM (SELECT c_custkey AS k,
          CASE WHEN {u('customer', 'segment', 'c_custkey')} < 0.25 THEN 'seed'
               WHEN {u('customer', 'segment', 'c_custkey')} < 0.8 THEN 'growth' ELSE 'scale' END AS segment,
          CASE WHEN c_custkey < 30 THEN c_custkey % 15 ELSE {whole('customer', 'market', 0, 14, 'c_custkey')} END AS market
        FROM customer)
)
"""

_M = ("k customer_id company_name country_code home_currency segment target_arr target_limit arr_growth drawdown_count "
      "facility_count subscription_count headcount_at_application valuation_at_application")
register("gen_customers", lambda s, d: master(s, d).drop("arr_at_application"), _M, "SELECT * FROM gen_master",
         {"target_arr": "double", "target_limit": "double", "arr_growth": "double", "valuation_at_application": "plain"})


def each(count: str, alias: str = "i") -> str:
    return f"(SELECT *, unnest(range(1, {count} + 1)) AS {alias} FROM gen_master)"


# --- full rows -----------------------------------------------------------------------

def between(kind: str, purpose: str, low: float, high: float, *key: str) -> str:
    return f"({low}::DOUBLE + {u(kind, purpose, *key)} * ({high}::DOUBLE - {low}::DOUBLE))"


def pick(kind: str, purpose: str, values: list[object], *key: str) -> str:
    listed = sql_list(values).replace("None", "NULL")
    return f"({listed})[CAST(floor({u(kind, purpose, *key)} * {len(values)}) AS BIGINT) + 1]"


def chance(kind: str, purpose: str, p: float, then: str, other: str, *key: str) -> str:
    return f"CASE WHEN {u(kind, purpose, *key)} < {p} THEN {then} ELSE {other} END"


def days_on(start: str, days: str) -> str:
    return f"({start} + to_days(CAST({days} AS INTEGER)))"


def from_first_day(days: str) -> str:
    return days_on(f"TIMESTAMP '{PLAN.start} 00:00:00'", days)


def window_day(kind: str, purpose: str, *key: str) -> str:
    return from_first_day(whole(kind, purpose, 0, PLAN.days - 1, *key))


def currency(kind: str, *key: str) -> str:
    wrong = pick(kind, "which currency", rates.BAD_CURRENCIES, *key)
    return chance(kind, "bad currency", rates.BAD_CURRENCY_RATE, wrong, "home_currency", *key)


def to_cents(value: str) -> str:
    return f"(floor(({value}) * 100) / 100.0::DOUBLE)"


def half_up(value: str, digits: int) -> str:
    """Rounds what the double prints as."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(30,15)), {digits}) AS DOUBLE)"


def ingested(kind: str, *key: str) -> str:
    return f"{window_day(kind, 'ingested', *key)} AS _ingested_at"


_KI, _KIN, _S, _N, _A, _X, _F, _D, _R, _FX, _B, _C = (
    ("k", "i"), ("k", "i", "n"), "subscription", "invoice", "application", "extra application", "facility", "drawdown",
    "repayment", "fx", "balance", "metric")

CTES["gen_draws"] = f"""
SELECT k, i, customer_id, home_currency, CASE WHEN {u(_D, 'null id', *_KI)} >= 0.02 THEN {uuid(_D, 'id', *_KI)} END AS drawdown_id,
  {chance(_D, 'orphan', 0.05, uuid(_D, 'no facility', *_KI),
          uuid(_F, 'id', 'k', whole(_D, 'facility', 1, 'facility_count', *_KI)), *_KI)} AS facility_id,
  {to_cents('target_limit * ' + between(_D, 'amount', 0.1, 0.4, *_KI))} AS positive,
  {from_first_day(whole(_D, 'drawn', 0, PLAN.days - 2, *_KI))} AS drawdown_date,
  {pick(_D, 'status', ['completed', 'completed', 'completed', 'pending', 'failed'], *_KI)} AS status
FROM {each('drawdown_count')}
"""
CTES["gen_paid_back"] = f"""
SELECT *, {days_on('drawdown_date', 'n * 30')} AS due, {u(_R, 'paid', *_KIN)} < 0.85 AS is_paid,
  {to_cents('positive / c * ' + between(_R, 'share', 0.9, 1.1, *_KIN))} AS scheduled
FROM (SELECT *, unnest(range(1, c + 1)) AS n FROM (
  SELECT *, {whole(_D, 'repayments', 4, 7, *_KI)} AS c FROM gen_draws WHERE status = 'completed'))
"""

CTES["gen_registered"] = f"""
SELECT *, {chance(_A, 'no registration', 0.05, "''",
                  f"substr(CAST(CAST('0x' || substr({digest(_A, 'registration', 'k')}, 1, 12) AS BIGINT) AS VARCHAR), 1, 8)", 'k')}
  AS registration FROM gen_master
"""
_SNAPSHOT = (f"{currency(_B, *_KI)} AS currency, {whole(_B, 'balance', 10000, 1999999, *_KI)} AS balance, "
             f"{from_first_day('i')} AS snapshot_date, {pick(_B, 'type', ['operating', 'reserve', 'fx'], *_KI)} AS account_type, "
             f"{from_first_day('i')} AS created_at, {ingested(_B, *_KI)}")
_DAYS = f"(SELECT *, unnest(range(0, {PLAN.days})) AS i FROM gen_master)"

#: Per entity: columns with their kinds where these differ from the models', expected rows.
FULL: dict[str, tuple[str, str]] = {
    "subscriptions": (
        "subscription_id customer_id plan_id plan_name mrr_amount:double currency status billing_period_start "
        "billing_period_end quantity created_at _ingested_at",
        f"""SELECT *, {days_on('billing_period_start', '30')} AS billing_period_end FROM (
        SELECT {uuid(_S, 'id', *_KI)} AS subscription_id, customer_id, 'plan_' || {whole(_S, 'plan', 1, 20, *_KI)} AS plan_id,
          {pick(_S, 'plan name', rates.PLANS, *_KI)} AS plan_name,
          {to_cents('target_arr / 12 / subscription_count * ' + between(_S, 'mrr', 0.5, 1.5, *_KI))} AS mrr_amount,
          {currency(_S, *_KI)} AS currency,
          {chance(_S, 'cancelled', 0.05, "'cancelled'", chance(_S, 'paused', 0.03, "'paused'", "'active'", *_KI), *_KI)} AS status,
          {window_day(_S, 'start', *_KI)} AS billing_period_start, {whole(_S, 'quantity', 1, 49, *_KI)} AS quantity,
          {from_first_day('-' + whole(_S, 'created', 1, 364, *_KI))} AS created_at, {ingested(_S, *_KI)}
        FROM {each('subscription_count')})"""),
    "invoices": (
        "invoice_id customer_id subscription_id amount:double currency invoice_date due_date paid_at status line_items_json "
        "created_at _ingested_at",
        f"""SELECT {uuid(_N, 'id', *_KI)} AS invoice_id, customer_id,
          {chance(_N, 'has subscription', 0.80, uuid(_S, 'id', 'k', whole(_N, 'linked', 1, 'subscription_count', *_KI)), 'NULL', *_KI)}
            AS subscription_id,
          {to_cents('part * ' + between(_N, 'amount', 0.8, 1.2, *_KI))} AS amount, {currency(_N, *_KI)} AS currency,
          issued AS invoice_date, {days_on('issued', '14')} AS due_date,
          CASE WHEN is_paid THEN {days_on('issued', whole(_N, 'paid after', 1, 19, *_KI))} END AS paid_at,
          CASE WHEN is_paid THEN 'paid' ELSE {chance(_N, 'void', 0.05, "'void'", pick(_N, 'unpaid', ['open', 'uncollectible'], *_KI), *_KI)}
            END AS status,
          '[{{"description":"service ' || substr({digest(_N, 'item', *_KI)}, 1, 6) || '","amount":'
            || {to_cents('part * ' + between(_N, 'item amount', 0.8, 1.2, *_KI))} || ',"currency":"' || home_currency || '"}}]'
            AS line_items_json, issued AS created_at, {ingested(_N, *_KI)}
        FROM (SELECT *, target_arr / 12 / count AS part, {window_day(_N, 'issued', *_KI)} AS issued, {u(_N, 'paid', *_KI)} < 0.85 AS is_paid
          FROM (SELECT *, unnest(range(1, count + 1)) AS i FROM (
            SELECT *, {whole('customer', 'invoices', 30, 89, 'k')} AS count FROM gen_master)))"""),
    "loan_applications": (
        "application_id customer_id company_name company_registration_number country_code industry requested_amount:double currency "
        "application_date status credit_score risk_rating headcount_at_application valuation_at_application:plain "
        "arr_at_application:plain created_at _ingested_at",
        f"""SELECT *, application_date AS created_at, 'SaaS' AS industry FROM (
        SELECT {uuid(_A, 'id', 'k')} AS application_id, customer_id, company_name, registration AS company_registration_number,
          {chance(_A, 'no country', 0.05, "''", 'country_code', 'k')} AS country_code, target_limit AS requested_amount,
          {currency(_A, 'k')} AS currency, {from_first_day('-' + whole(_A, 'applied', 30, 364, 'k'))} AS application_date,
          'approved' AS status,
          {chance(_A, 'good score', 0.98, whole(_A, 'score', 300, 849, 'k'), pick(_A, 'bad score', rates.BAD_SCORES, 'k'), 'k')}
            AS credit_score, {pick(_A, 'risk', ['low', 'medium', 'high'], 'k')} AS risk_rating, headcount_at_application,
          valuation_at_application, CAST(floor(target_arr / (arr_growth + 1)) AS BIGINT) AS arr_at_application, {ingested(_A, 'k')}
        FROM gen_registered
        UNION ALL
        SELECT {uuid(_X, 'id', 'k')}, {uuid(_X, 'customer', 'k')}, 'Company ' || substr({digest(_X, 'name', 'k')}, 1, 16), registration,
          country_code, CAST({whole(_X, 'amount', 50000, 1999999, 'k')} AS DOUBLE), home_currency,
          {from_first_day('-' + whole(_X, 'applied', 30, 179, 'k'))}, {pick(_X, 'status', ['rejected', 'pending', 'cancelled'], 'k')},
          {whole(_X, 'score', 300, 849, 'k')}, {pick(_X, 'risk', ['low', 'medium', 'high', 'N/A'], 'k')},
          {whole(_X, 'headcount', 5, 99, 'k')}, {whole(_X, 'valuation', 500000, 9999999, 'k')},
          {whole(_X, 'arr', 200000, 4999999, 'k')}, {window_day(_X, 'ingested', 'k')}
        FROM gen_registered WHERE {u(_X, 'extra', 'k')} < 0.25)"""),
    "credit_facilities": (
        "facility_id application_id customer_id facility_limit:double currency approval_date maturity_date status interest_rate "
        "repayment_schedule_json created_at _ingested_at",
        f"""SELECT {uuid(_F, 'id', *_KI)} AS facility_id,
          {chance(_F, 'has application', 0.80, uuid(_A, 'id', 'k'), 'NULL', *_KI)} AS application_id, customer_id,
          {chance(_F, 'negative', 0.01, '-full_limit', 'full_limit', *_KI)} AS facility_limit, {currency(_F, *_KI)} AS currency,
          approved_on AS approval_date, {days_on('approved_on', '730')} AS maturity_date,
          CASE WHEN i = facility_count THEN 'active' ELSE 'closed' END AS status,
          {half_up(between(_F, 'interest', 0.08, 0.18, *_KI), 4)} AS interest_rate,
          '[' || array_to_string(['{{"due_date":"' || strftime({days_on('approved_on', 'm * 30')}, '%Y-%m-%d') || '","amount":'
            || {to_cents('full_limit * 0.05::DOUBLE')} || '}}' FOR m IN range(1, 13)], ',') || ']' AS repayment_schedule_json,
          approved_on AS created_at, {ingested(_F, *_KI)}
        FROM (SELECT *, {from_first_day('-' + whole(_F, 'approved', 30, 729, *_KI))} AS approved_on,
          {to_cents('target_limit * CASE WHEN i > 1 THEN 0.6::DOUBLE ELSE 1.0::DOUBLE END')} AS full_limit
          FROM {each('facility_count')})"""),
    "drawdowns": (
        "drawdown_id facility_id customer_id amount:double currency drawdown_date purpose status created_at _ingested_at",
        f"""SELECT * EXCLUDE (landed), landed + to_seconds(unnest(
          {chance(_D, 'duplicate', rates.DUPLICATE_RATE, '[0, 1]', '[0]', *_KI)})) AS _ingested_at FROM (
        SELECT k, i, drawdown_id, facility_id, customer_id, {chance(_D, 'negative', 0.03, '-positive', 'positive', *_KI)} AS amount,
          {currency(_D, *_KI)} AS currency, drawdown_date, {pick(_D, 'purpose', rates.PURPOSES, *_KI)} AS purpose, status,
          drawdown_date AS created_at, {window_day(_D, 'ingested', *_KI)} AS landed FROM gen_draws)"""),
    "repayments": (
        "repayment_id drawdown_id facility_id customer_id scheduled_amount:double actual_amount:double currency due_date actual_date "
        "status created_at _ingested_at",
        f"""SELECT *, due_date AS created_at FROM (
        SELECT {uuid(_R, 'id', *_KIN)} AS repayment_id, drawdown_id, facility_id, customer_id, scheduled AS scheduled_amount,
          CASE WHEN is_paid THEN scheduled END AS actual_amount, {currency(_R, *_KIN)} AS currency, due AS due_date,
          CASE WHEN is_paid THEN {days_on('due', whole(_R, 'lag', -5, 9, *_KIN))} END AS actual_date,
          CASE WHEN is_paid THEN 'paid' ELSE {pick(_R, 'unpaid', ['scheduled', 'overdue'], *_KIN)} END AS status, {ingested(_R, *_KIN)}
        FROM gen_paid_back
        UNION ALL
        SELECT {uuid(_R, 'lost', *_KIN)}, {uuid(_R, 'lost drawdown', *_KIN)}, {uuid(_R, 'lost facility', *_KIN)},
          {uuid(_R, 'lost customer', *_KIN)}, CAST({whole(_R, 'lost amount', 1000, 49999, *_KIN)} AS DOUBLE), NULL,
          {currency(_R, *_KIN)}, {window_day(_R, 'lost due', *_KIN)}, NULL, 'scheduled', {window_day(_R, 'ingested', *_KIN)}
        FROM gen_paid_back WHERE {u(_R, 'orphan', *_KIN)} < {rates.ORPHAN_RATE})"""),
    "fx_transactions": (
        "transaction_id customer_id base_currency quote_currency base_amount:plain quote_amount:double rate rate_type transaction_date "
        "counterparty_bank_bic created_at _ingested_at",
        f"""SELECT *, CASE WHEN {u(_FX, 'has quote', *_KI)} < 0.70 THEN {half_up('base_amount * rate', 2)} END AS quote_amount FROM (
        SELECT k, i, {uuid(_FX, 'id', *_KI)} AS transaction_id, customer_id, ({PAIR_BASE})[p] AS base_currency,
          ({PAIR_QUOTE})[p] AS quote_currency, {whole(_FX, 'amount', 1000, 499999, *_KI)} AS base_amount,
          {half_up(chance(_FX, 'inverse', 0.05, '1.0::DOUBLE / direct', 'direct', *_KI), 6)} AS rate,
          {chance(_FX, 'has type', 0.90, pick(_FX, 'type', ['spot', 'forward'], *_KI), 'NULL', *_KI)} AS rate_type,
          {window_day(_FX, 'booked', *_KI)} AS transaction_date,
          {chance(_FX, 'has bic', 0.80, f"upper(substr({digest(_FX, 'bic', *_KI)}, 1, 4)) || 'GB2L'", 'NULL', *_KI)}
            AS counterparty_bank_bic, {window_day(_FX, 'booked', *_KI)} AS created_at, {ingested(_FX, *_KI)}
        FROM (SELECT *, greatest({rates.FX_FLOOR}::DOUBLE, {half_up(f"({sql_list(list(rates.FX_RATES.values()))}::DOUBLE[])[p] + "
              f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {u(_FX, 'noise/r', *_KI)})) * cos({u(_FX, 'noise/a', *_KI)} * "
              f"6.283185307179586::DOUBLE) * {rates.FX_DEVIATION}::DOUBLE", 6)}) AS direct
          FROM (SELECT *, {whole(_FX, 'pair', 0, len(rates.FX_RATES) - 1, *_KI)} + 1 AS p
                FROM {each(whole('customer', 'fx', 8, 24, 'k'))})))"""),
    "account_balances": (
        "snapshot_id customer_id account_id currency balance:plain snapshot_date account_type created_at _ingested_at",
        f"""SELECT {uuid(_B, 'id', *_KI)} AS snapshot_id, customer_id,
          'acct_' || customer_id || '_' || {whole(_B, 'account', 1, 3, *_KI)} AS account_id, {_SNAPSHOT} FROM {_DAYS}
        UNION ALL
        SELECT {uuid(_B, 'lost', *_KI)}, {uuid(_B, 'lost customer', *_KI)}, 'acct_orphan_' || {whole(_B, 'lost account', 1, 999, *_KI)},
          {_SNAPSHOT} FROM {_DAYS} WHERE {u(_B, 'orphan', *_KI)} < {rates.ORPHAN_RATE}"""),
    "company_metrics": (
        "metric_id customer_id metric_date headcount valuation:plain arr_reported:plain created_at _ingested_at",
        f"""SELECT *, metric_date AS created_at FROM (
        SELECT {uuid(_C, 'id', *_KI)} AS metric_id, customer_id, {from_first_day(whole(_C, 'measured', 0, PLAN.days - 2, *_KI))} AS metric_date,
          CAST(floor(headcount_at_application * ({u(_C, 'team', *_KI)} * arr_growth + 1)) AS BIGINT) AS headcount,
          CAST(floor(valuation_at_application * ({u(_C, 'worth', *_KI)} * arr_growth + 1)) AS BIGINT) AS valuation,
          CAST(floor(target_arr * ({chance(_C, 'misreported', 0.30, between(_C, 'variance', -0.15, 0.15, *_KI), '0.0::DOUBLE', *_KI)} + 1))
            AS BIGINT) AS arr_reported, {ingested(_C, *_KI)}
        FROM {each(whole('customer', 'metrics', 2, 4, 'k'))})"""),
}
for _name, (_columns, _body) in FULL.items():
    _parts = [column.split(":") for column in _columns.split()]
    register(f"gen_{_name}", rows(_name), " ".join(part[0] for part in _parts), _body, {n: kind for n, *rest in _parts for kind in rest})

# --- profiles with expected counts ------------------------------------------------------

register("gen_subscriptions_profile", lambda s, d: rows("subscriptions")(s, d).groupBy("status").agg(
    F.count("*").alias("rows"), F.countDistinct("subscription_id").alias("ids")), "status rows ids",
    f"SELECT CASE WHEN {u('subscription', 'cancelled', 'k', 'i')} < 0.05 THEN 'cancelled' "
    f"WHEN {u('subscription', 'paused', 'k', 'i')} < 0.03 THEN 'paused' ELSE 'active' END AS status, "
    f"count(*) AS rows, count(*) AS ids FROM {each('subscription_count')} GROUP BY 1")
register("gen_invoices_profile", lambda s, d: rows("invoices")(s, d).agg(
    F.count("*").alias("rows"), F.count_if(F.col("status") == "paid").alias("paid"),
    F.count("subscription_id").alias("linked")), "rows paid linked",
    f"SELECT count(*) AS rows, count(*) FILTER ({u('invoice', 'paid', 'k', 'i')} < 0.85) AS paid, "
    f"count(*) FILTER ({u('invoice', 'has subscription', 'k', 'i')} < 0.8) AS linked "
    f"FROM {each(whole('customer', 'invoices', 30, 89, 'k'))}")
register("gen_loan_applications_profile", lambda s, d: rows("loan_applications")(s, d).groupBy(
    (F.col("status") == "approved").alias("approved")).agg(F.count("*").alias("rows")), "approved rows",
    "SELECT TRUE AS approved, count(*) AS rows FROM gen_master UNION ALL "
    f"SELECT FALSE, count(*) FROM gen_master WHERE {u('extra application', 'extra', 'k')} < 0.25")
register("gen_credit_facilities_profile", lambda s, d: rows("credit_facilities")(s, d).groupBy("status").agg(
    F.count("*").alias("rows"), F.count_if(F.col("facility_limit") < 0).alias("negative")), "status rows negative",
    "SELECT CASE WHEN i = facility_count THEN 'active' ELSE 'closed' END AS status, count(*) AS rows, "
    f"count(*) FILTER ({u('facility', 'negative', 'k', 'i')} < 0.01) AS negative FROM {each('facility_count')} GROUP BY 1")
_DUP = f"CASE WHEN {u('drawdown', 'duplicate', 'k', 'i')} < 0.04 THEN 2 ELSE 1 END"
register("gen_drawdowns_profile", lambda s, d: rows("drawdowns")(s, d).agg(
    F.count("*").alias("rows"), F.count("drawdown_id").alias("with_id"), F.count_if(F.col("amount") < 0).alias("negative")),
    "rows with_id negative",
    f"SELECT CAST(sum({_DUP}) AS BIGINT) AS rows, CAST(sum({_DUP}) FILTER ({u('drawdown', 'null id', 'k', 'i')} >= 0.02) AS BIGINT) "
    f"AS with_id, CAST(coalesce(sum({_DUP}) FILTER ({u('drawdown', 'negative', 'k', 'i')} < 0.03), 0) AS BIGINT) AS negative "
    f"FROM {each('drawdown_count')}")
_DONE = f"(SELECT *, {whole('drawdown', 'repayments', 4, 7, 'k', 'i')} AS c FROM {each('drawdown_count')} WHERE floor({u('drawdown', 'status', 'k', 'i')} * 5) < 3)"
register("gen_repayments_profile", lambda s, d: rows("repayments")(s, d).agg(
    F.count_if(F.col("status") == "paid").alias("paid"), F.count("*").alias("rows")), "paid rows",
    f"SELECT count(*) FILTER ({u('repayment', 'paid', 'k', 'i', 'n')} < 0.85) AS paid, "
    f"count(*) + count(*) FILTER ({u('repayment', 'orphan', 'k', 'i', 'n')} < 0.02) AS rows "
    f"FROM (SELECT *, unnest(range(1, c + 1)) AS n FROM {_DONE})")
register("gen_fx_transactions_profile", lambda s, d: rows("fx_transactions")(s, d).groupBy("base_currency", "quote_currency").agg(
    F.count("*").alias("rows"), F.count("quote_amount").alias("quoted")), "base_currency quote_currency rows quoted",
    f"SELECT ({PAIR_BASE})[p + 1] AS base_currency, ({PAIR_QUOTE})[p + 1] AS quote_currency, "
    f"count(*) AS rows, count(*) FILTER (q < 0.7) AS quoted FROM (SELECT {whole('fx', 'pair', 0, 15, 'k', 'i')} AS p, "
    f"{u('fx', 'has quote', 'k', 'i')} AS q FROM {each(whole('customer', 'fx', 8, 24, 'k'))}) GROUP BY 1, 2")
register("gen_account_balances_profile", lambda s, d: rows("account_balances")(s, d).groupBy(
    F.col("account_id").startswith("acct_orphan").alias("orphan")).agg(F.count("*").alias("rows")), "orphan rows",
    f"SELECT FALSE AS orphan, count(*) * 30 AS rows FROM gen_master UNION ALL SELECT TRUE, count(*) FROM "
    f"(SELECT k, unnest(range(0, 30)) AS i FROM gen_master) WHERE {u('balance', 'orphan', 'k', 'i')} < 0.02")
register("gen_company_metrics_profile", lambda s, d: rows("company_metrics")(s, d).agg(
    F.count("*").alias("rows"), F.min("metric_date").alias("due_date"), F.max("metric_date").alias("newest")),
    "rows due_date newest",
    f"SELECT count(*) AS rows, TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(min(m) AS INTEGER)) AS due_date, "
    f"TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(max(m) AS INTEGER)) AS newest FROM "
    f"(SELECT {whole('metric', 'measured', 0, 28, 'k', 'i')} AS m FROM {each(whole('customer', 'metrics', 2, 4, 'k'))})")


# --- the dirt --------------------------------------------------------------------------

_NOT_NEGATIVE = {"facility_limit", "amount of drawdowns", "balance"}
_CODES = "'GBP','EUR','CHF','SEK','NOK','DKK','ISK','USD','CAD'"


def part(draw: str, low: float, high: float, count: int) -> str:
    return f"least(floor(({draw} - {low!r}::DOUBLE) / {high - low!r}::DOUBLE * {count}), {count - 1})"


def staged_dirt_sql(name: str) -> str:
    """Clean rows -> what default staging keeps of them once they have been made dirty, landed and read back."""
    entity = ENTITIES[name]
    drift = drift_key(entity)

    def row(purpose: str) -> str:
        return u(f"row {name}", purpose, "row_key")

    def batch(purpose: str) -> str:
        return u(f"batch {name}", purpose, "batch_key")

    def date(column: str) -> str:
        draw, low = row(f"{column}/form"), rates.IMPOSSIBLE_DATE_RATE
        dirty = low + (1 - low) * rates.DIRTY_DATE_RATE
        epoch = dirty + (1 - dirty) * rates.EPOCH_DATE_RATE
        us = epoch + (1 - epoch) * rates.US_DATE_RATE
        iso = rates.DIRTY_DATE_FORMATS.index("yyyy-MM-dd")
        # Of the other formats staging reads only the day of an ISO date; all dates here are whole days.
        return (f"CASE WHEN {draw} < {low!r} THEN NULL WHEN {draw} < {dirty!r} THEN "
                f"CASE WHEN {part(draw, low, dirty, len(rates.DIRTY_DATE_FORMATS))} = {iso} THEN {column} END "
                f"WHEN {draw} < {epoch!r} THEN {column} WHEN {draw} < {us!r} THEN NULL ELSE {column} END")

    def amount(column: str) -> str:
        draw, value = batch(f"{column}/type"), f"CAST({column} AS DOUBLE)"
        minor = f"floor(abs({value}) * 100) * sign({value})"
        return (f"CASE WHEN {draw} < {rates.TYPE_DRIFT_RATE} AND {part(draw, 0.0, rates.TYPE_DRIFT_RATE, 3)} <> 1 "
                f"THEN {minor} ELSE {value} END")

    def expected(column: str) -> str:
        if column == drift:
            draw = batch("drift")
            if column == "collateral_required":
                return f"CASE WHEN {draw} < {rates.COLLATERAL_RATE} THEN CASE WHEN {draw} < {rates.COLLATERAL_RATE / 2} THEN 'true' ELSE 'false' END END"
            if column == "referral_source":
                return (f"CASE WHEN {draw} < {rates.REFERRAL_RATE} THEN (['partner', 'web', 'event', 'broker'])"
                        f"[CAST({part(draw, 0.0, rates.REFERRAL_RATE, 4)} AS BIGINT) + 1] END")
            return f"CASE WHEN {draw} >= {rates.BIC_DROP_RATE} THEN {column} END"
        value = column
        if column in entity.dates:
            value = date(column)
        elif column in entity.amounts:
            value = amount(column)
            if column in _NOT_NEGATIVE or f"{column} of {name}" in _NOT_NEGATIVE:
                value = f"CASE WHEN {value} >= 0 THEN {value} END"
        elif column in ("currency", "base_currency", "quote_currency"):
            value = f"CASE WHEN upper({column}) IN ({_CODES}) THEN upper({column}) END"
        elif column in ("country_code", "company_registration_number"):
            value = f"nullif({column}, '')"
        elif column == "credit_score":
            value = f"CASE WHEN {column} BETWEEN 300 AND 850 THEN {column} END"
        if column in rates.KEY_VARIANTS:
            value = f"CASE WHEN {batch(f'{column}/key')} >= {rates.RENAME_RATE} THEN {value} END"
        if column == "plan_id":
            value = f"coalesce({value}, 'unknown')"
        return value

    late = row("late")
    days = f"CASE WHEN {late} < {rates.STALE_RATE} THEN {part(late, 0.0, rates.STALE_RATE, rates.STALE_JITTER + 1)} + {rates.STALE_DAYS} ELSE 0 END"
    outputs = ", ".join(f"{expected(column)} AS {column}" for column in entity.columns)
    named = "" if not entity.key_required else f"WHERE {entity.key} IS NOT NULL"
    return f"""
        SELECT *, CAST(1 AS BIGINT) AS _schema_version FROM (
          SELECT {outputs}, _ingested_at - to_days(CAST({days} AS INTEGER)) AS _ingested_at,
            strftime(_ingested_at - to_days(CAST({days} AS INTEGER)), '%Y-%m-%d') || substr({digest(f'row {name}', 'tag', 'row_key')}, 1, 16) AS tag
          FROM (
            SELECT *, CAST(CAST(_ingested_at AS DATE) AS VARCHAR) AS batch_key,
              concat_ws('|', {entity.key}, CAST(_ingested_at AS VARCHAR), CAST(created_at AS VARCHAR)) AS row_key
            FROM ({FULL[name][1]}))) {named}
        QUALIFY row_number() OVER (PARTITION BY {entity.key} ORDER BY _ingested_at DESC, tag DESC) = 1"""


def _staged_dirt(name: str):
    """Generated events landed, read back and staged: what the dirt leaves."""
    def build(s, d: str) -> DataFrame:
        entity = ENTITIES[name]
        landing = shared_folder(s, "generated")
        write_raw_events(generate(master(s, d), name, PLAN, by_day=True), landing, entity)
        return stage(read_raw_events(s, landing, entity), entity)
    return build


for _name, _entity in ENTITIES.items():
    register(f"gen_landed_{_name}", _staged_dirt(_name), " ".join([*_entity.columns, "_ingested_at", "_schema_version"]),
             staged_dirt_sql(_name))
