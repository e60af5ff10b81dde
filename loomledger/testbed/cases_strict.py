"""Registered queries: the strict reading of the specification."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import strict as st
from loomledger.plans import strict, units
from loomledger.plans.entities import ENTITIES
from loomledger.sources.tables import MART_SCHEMAS
from loomledger.testbed import landing as ld
from loomledger.testbed.cases_columns import scalar
from loomledger.testbed.catalog import register
from loomledger.testbed.oracle import CTES, PURPOSE, ing

_LATEST_LINE = ("QUALIFY row_number() OVER (PARTITION BY drawdown_id ORDER BY _ingested_at DESC, l_partkey DESC, "
                "l_suppkey DESC, l_extendedprice DESC) = 1")


def _recovered_dates(value: str, form: str) -> str:
    """Only the impossible date stays NULL; day-only forms lose the time."""
    return (f"CASE WHEN ({form}) = 2 THEN NULL WHEN ({form}) IN (1, 3, 4) THEN date_trunc('day', {value}) ELSE {value} END")


# Expected strict drawdowns: the rows of s_drawdowns without the losses.
CTES["strict_drawdowns"] = f"""
SELECT * FROM (
  SELECT *, CASE WHEN l_orderkey % 53 <> 0 THEN 'D' || l_orderkey || '-' || l_linenumber END AS drawdown_id,
    CASE WHEN l_partkey % 103 = 7 THEN NULL WHEN l_partkey % 20 = 3 THEN 'X' || l_orderkey
         ELSE 'F' || l_orderkey END AS facility_id,
    'C' || l_partkey AS customer_id,
    CASE WHEN m % 33 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
    (['GBP','EUR','CHF','SEK','NOK','DKK','ISK','USD','CAD','USD',NULL,NULL])[m % 12 + 1] AS currency,
    {_recovered_dates('d', 'm % 10')} AS drawdown_date,
    ({PURPOSE})[l_linenumber % 5 + 1] AS purpose,
    CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'N' THEN 'pending' ELSE 'failed' END AS status
  FROM (SELECT *, l_orderkey * 7 + l_linenumber AS m, l_shipdate + to_days(9131) AS d,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(CASE WHEN l_partkey % 20 = 9
      THEN (l_orderkey * 7 + l_linenumber + l_partkey) % 30 - 45 - l_partkey % 15
      ELSE (l_orderkey * 7 + l_linenumber + l_partkey) % 30 END AS INTEGER))
      + to_seconds((l_suppkey * 101 + l_partkey) % 86400) AS _ingested_at FROM lineitem)
) {_LATEST_LINE}
"""


def _raw(s, d: str) -> DataFrame:
    return ld.raw_events(s, d, "drawdowns")


_D = ENTITIES["drawdowns"]

register("strict_staging",
         lambda s, d: strict.stage_strict(_raw(s, d), _D),
         "drawdown_id facility_id customer_id amount currency drawdown_date purpose status _ingested_at _schema_version",
         "SELECT *, CAST(1 AS BIGINT) AS _schema_version FROM strict_drawdowns")
register("normalise_keys",
         lambda s, d: strict.parsed_any_case(_raw(s, d), _D).groupBy("customer_id").agg(F.count("*").alias("drawdowns")),
         "customer_id drawdowns", "SELECT 'C' || l_partkey AS customer_id, count(*) AS drawdowns FROM lineitem GROUP BY 1")


def _major(s, d: str) -> DataFrame:
    rows = strict.to_major_units(strict.parsed_any_case(_raw(s, d), _D), _D)
    return rows.groupBy("customer_id").agg(
        c.money_sum(c.to_money(c.to_number(F.col("amount")))).alias("total_amount"))


register("cents_to_major", _major, "customer_id total_amount",
         "SELECT 'C' || l_partkey AS customer_id, sum(CAST(CASE WHEN (l_orderkey * 7 + l_linenumber) % 33 = 0 "
         "THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2))) AS total_amount FROM lineitem GROUP BY 1")
register("minor_unit_days",
         lambda s, d: strict.minor_unit_days(strict.parsed_any_case(_raw(s, d), _D), _D).filter("_minor_amount").select(
             F.col("_day").cast(c.NTZ).alias("month")),
         "month", "SELECT DISTINCT date_trunc('day', _ingested_at) AS month FROM f_drawdowns WHERE day(_ingested_at) IN (12, 14)")
scalar("multi_format_dates", "lineitem", "l_orderkey",
       ["2024-03-05", "03/05/2024", "25-12-2024", "25/12/2024", "13/45/2024", "1709634030", "05-13-2024", "2024-03-05T01:02:03", "", None],
       "parsed", st.parse_any_date,
       "CASE WHEN TRY_CAST(raw AS TIMESTAMP) IS NOT NULL THEN TRY_CAST(raw AS TIMESTAMP) "
       "WHEN regexp_matches(raw, '^[0-9]{10}$') THEN make_timestamp(CAST(raw AS BIGINT) * 1000000) "
       "ELSE coalesce(TRY_STRPTIME(raw, '%m/%d/%Y'), TRY_STRPTIME(raw, '%d-%m-%Y'), TRY_STRPTIME(raw, '%d/%m/%Y')) END")
scalar("pair_text_normalise", "orders", "o_orderkey",
       ["EURUSD", "eur/usd", "USD_EUR", "EUR", "GBP-USD", "", None, "EURUSDX"], "currency_pair", st.pair_text,
       "CASE WHEN length(regexp_replace(upper(raw), '[^A-Z]', '', 'g')) = 6 "
       "THEN regexp_replace(upper(raw), '[^A-Z]', '', 'g') END")
register("empty_to_null_all",
         lambda s, d: strict.blanks_to_null(strict.parsed_any_case(
             ld.raw_events(s, d, "loan_applications"), ENTITIES["loan_applications"]), ENTITIES["loan_applications"]).agg(
                 F.count_if(F.col("currency").isNull()).alias("no_currency"),
                 F.count_if(F.col("country_code").isNull()).alias("no_country"),
                 F.count("*").alias("rows")),
         "no_currency no_country rows",
         "SELECT count(*) FILTER (k % 12 = 11) AS no_currency, count(*) FILTER (c_nationkey % 8 = 3) AS no_country, "
         "count(*) AS rows FROM (SELECT *, c_custkey * 3 + unnest(range(0, c_custkey % 3 + 1)) AS k FROM customer)")
register("inverse_rate_by_median",
         lambda s, d: strict.direct_rates(ld.warehouse(s, d).staged("fx_transactions")).select(
             "transaction_id", "effective_rate"),
         "transaction_id effective_rate",
         "SELECT transaction_id, CASE WHEN rate > 0 AND typical > 0 AND abs(ln(1 / rate / typical)) < abs(ln(rate / typical)) "
         "THEN 1 / rate ELSE rate END AS effective_rate FROM s_fx_transactions LEFT JOIN ("
         "SELECT base_currency, quote_currency, quantile_disc(rate, 0.5) AS typical FROM s_fx_transactions WHERE rate > 0 "
         "GROUP BY 1, 2) USING (base_currency, quote_currency)")
register("growth_vs_application", lambda s, d: strict.growth_since_application(ld.warehouse(s, d).dim_customers()),
         "customer_id team_growth_pct valuation_increase_multiple",
         "SELECT customer_id, CASE WHEN headcount_at_application <> 0 THEN (current_headcount - headcount_at_application) "
         "* 100.0::DOUBLE / headcount_at_application END AS team_growth_pct, CASE WHEN valuation_at_application <> 0 THEN "
         "CAST(current_valuation AS DOUBLE) / CAST(valuation_at_application AS DOUBLE) END AS valuation_increase_multiple FROM dim_c")
register("customer_utilisation",
         lambda s, d: (lambda w: strict.customer_utilisation(w.staged("credit_facilities"), w.staged("drawdowns")))(
             ld.warehouse(s, d)),
         "customer_id total_drawn_amount total_facility_limit utilisation_pct",
         "SELECT *, CASE WHEN total_facility_limit <> 0 THEN CAST(total_drawn_amount AS DOUBLE) / "
         "CAST(total_facility_limit AS DOUBLE) * 100 END AS utilisation_pct FROM (SELECT customer_id, "
         "sum(coalesce(drawn, 0)) AS total_drawn_amount, sum(facility_limit) AS total_facility_limit FROM s_credit_facilities "
         "LEFT JOIN drawn_facility USING (facility_id) WHERE status = 'active' GROUP BY 1)")
register("risk_rating_allowlist",
         lambda s, d: ld.warehouse(s, d).staged("loan_applications").select(
             "application_id", st.risk_rating(F.col("risk_rating")).alias("risk_rating")),
         "application_id risk_rating",
         "SELECT application_id, CASE WHEN risk_rating <> 'N/A' THEN risk_rating END AS risk_rating FROM s_loan_applications")


# --- the strict warehouse -------------------------------------------------------

# Expected strict staging: the default one without its losses. Days whose events are too few to tell
# the unit of their amounts keep them as they came.
_COPIES = {"subscriptions": "SELECT {0} AS _ingested_at FROM (SELECT *, unnest(CASE WHEN event_id % 40 = 0 THEN [0, 1] "
                            "ELSE [0] END) AS copy FROM events)",
           "credit_facilities": "SELECT {0} AS _ingested_at FROM (SELECT *, unnest(CASE WHEN o_orderkey % 25 = 0 THEN [0, 1] "
                                "ELSE [0] END) AS copy FROM orders)"}
_COPY_TIMES = {"subscriptions": ing("event_id * 7 % 30", "(event_id % 86400) + copy", "event_id % 20 = 7", "event_id % 15"),
               "credit_facilities": ing("o_orderkey * 17 % 30", "(o_orderkey % 86400) + copy", "o_orderkey % 20 = 13", "o_orderkey % 15")}
_MODELS = [f"s_{name}" for name in ENTITIES] + [
    "eur_rate", "mrr", "int_arr", "drawn_facility", "int_util", "metric_pair", "main_currency", "funded", "dim_c", "dim_f",
    "fct_d", "fct_r", "fct_x"]


def _without_losses(entity: str, sql: str) -> str:
    for loss, recovered in [
        ("CASE WHEN day(_ingested_at) NOT IN (8, 20) THEN", "CASE WHEN TRUE THEN"),
        ("WHEN day(_ingested_at) IN (12, 14) THEN", f"WHEN day(_ingested_at) IN (12, 14) AND CAST(_ingested_at AS DATE) "
                                                    f"NOT IN (SELECT day FROM told_{entity}) THEN"),
        (") IN (1, 2, 4) THEN NULL", ") = 2 THEN NULL"), (") = 3 THEN date_trunc", ") IN (1, 3, 4) THEN date_trunc"),
        ("% 13 = 0 THEN ''", "% 13 = 0 THEN NULL"), ("'high', 'N/A'", "'high', NULL")]:
        sql = sql.replace(loss, recovered)
    return sql


for _name in ENTITIES:
    _times = _COPIES[_name].format(_COPY_TIMES[_name]) if _name in _COPIES else f"SELECT _ingested_at FROM f_{_name}"
    CTES[f"told_{_name}"] = (f"SELECT CAST(_ingested_at AS DATE) AS day, count(*) AS events FROM ({_times}) "
                             f"GROUP BY 1 HAVING count(*) >= {units.MIN_ROWS}")
for _model in _MODELS:
    _sql = re.sub(rf"\b({'|'.join(_MODELS)})\b", r"strict_\1", CTES[_model])
    if _model == "s_fx_transactions":
        CTES["untold_fx"] = _without_losses("fx_transactions", _sql)
        _sql = """
        SELECT f.* EXCLUDE (typical) REPLACE (CASE WHEN rate > 0 AND typical > 0
            AND abs(ln(1 / rate / typical)) < abs(ln(rate / typical)) THEN 1 / rate ELSE rate END AS rate)
        FROM (SELECT * FROM untold_fx LEFT JOIN (
            SELECT base_currency, quote_currency, quantile_disc(rate, 0.5) AS typical FROM untold_fx WHERE rate > 0
            GROUP BY 1, 2) USING (base_currency, quote_currency)) f"""
    elif _model.startswith("s_"):
        _sql = _without_losses(_model[2:], _sql)
    CTES[f"strict_{_model}"] = _sql

_METADATA = ["_ingested_at", "_schema_version"]
for _entity in ENTITIES.values():
    register(f"strict_stg_{_entity.name}", lambda s, d, name=_entity.name: ld.strict_warehouse(s, d).staged(name),
             " ".join([*_entity.columns, *_METADATA]), f"SELECT * FROM strict_s_{_entity.name}")
for _mart, _sql in [("dim_customers", "dim_c"), ("dim_credit_facilities", "dim_f"), ("fct_drawdowns", "fct_d"),
                    ("fct_repayments", "fct_r"), ("fct_fx_transactions", "fct_x")]:
    register(f"strict_{_mart}", lambda s, d, name=_mart: ld.strict_warehouse(s, d).model(name),
             " ".join(field.split()[0] for field in re.split(r", (?=[a-z_]+ [a-z])", MART_SCHEMAS[_mart])),
             f"SELECT * FROM strict_{_sql}")


def _decisions(s, d: str) -> DataFrame:
    found = units.unit_decisions(strict.parsed_once(_raw(s, d), _D), _D)
    return found.select(F.col("_day").cast(c.NTZ).alias("month"), "column", "rows", "decision")


register("unit_decisions", _decisions, "month column rows decision",
         "SELECT date_trunc('day', _ingested_at) AS month, 'amount' AS \"column\", count(*) AS rows, "
         f"CASE WHEN count(*) < {units.MIN_ROWS} THEN 'undecided' WHEN day(date_trunc('day', _ingested_at)) IN (12, 14) THEN 'minor' "
         "ELSE 'major' END AS decision FROM f_drawdowns GROUP BY date_trunc('day', _ingested_at)")
