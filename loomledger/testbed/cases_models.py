"""Registered queries: the eighteen models and the report pack."""

from __future__ import annotations

from loomledger.functions import columns as c
from loomledger.plans import reports as r
from loomledger.plans.colocated import BucketedStar
from loomledger.plans.entities import ENTITIES
from loomledger.plans.units import written
from loomledger.session import shared_folder
from loomledger.sources.tables import MART_SCHEMAS
from loomledger.testbed.catalog import register
from loomledger.testbed.landing import built_models
from loomledger.testbed.landing import warehouse as wh

# A customer with rows in every fact, and the reporting clock.
CUSTOMER = "C22"
AS_OF = "2026-10-01 00:00:00"
FX_AS_OF = "2024-02-01 00:00:00"
INVOICE_AS_OF = "2025-06-30 00:00:00"

# --- models -----------------------------------------------------------------

for _entity in ENTITIES.values():
    register(
        _entity.table,
        lambda spark, d, name=_entity.name: wh(spark, d).staged(name),
        " ".join([*_entity.columns, "_ingested_at", "_schema_version"]),
        f"SELECT * FROM s_{_entity.name}",
    )

register("int_arr_per_customer", lambda s, d: wh(s, d).arr_per_customer(),
         "customer_id current_arr subscription_count arr_growth_pct", "SELECT * FROM int_arr")
register("int_facility_utilization", lambda s, d: wh(s, d).facility_utilization(),
         "facility_id customer_id facility_limit currency facility_status total_drawn_amount "
         "current_utilization_pct is_orphaned", "SELECT * FROM int_util")
register("int_fx_rates_normalized", lambda s, d: wh(s, d).fx_rates_normalized(),
         "transaction_id customer_id base_currency quote_currency currency_pair base_amount quote_amount "
         "effective_rate rate_type transaction_date is_orphaned", "SELECT * FROM int_fx", {"quote_amount": "double"})
register("int_repayment_schedule", lambda s, d: wh(s, d).repayment_schedule(),
         "facility_id customer_id currency installment_due_date installment_amount", "SELECT * FROM int_schedule")
register("dim_customers", lambda s, d: wh(s, d).dim_customers(),
         "customer_id company_name country_code industry headcount_at_application valuation_at_application "
         "arr_at_application lifetime_arr arr_growth_pct total_facility_limit total_drawn_amount "
         "primary_account_currency current_headcount current_valuation team_growth_pct "
         "valuation_increase_multiple arr_variance_pct is_orphaned", "SELECT * FROM dim_c")
register("dim_credit_facilities", lambda s, d: wh(s, d).dim_credit_facilities(),
         "facility_id application_id customer_id facility_limit currency approval_date maturity_date "
         "facility_status interest_rate current_utilization_pct is_orphaned", "SELECT * FROM dim_f")
register("fct_drawdowns", lambda s, d: wh(s, d).fct_drawdowns(),
         "drawdown_id facility_id customer_id amount currency drawdown_date purpose status "
         "days_since_facility_approval is_orphaned", "SELECT * FROM fct_d")
register("fct_repayments", lambda s, d: wh(s, d).fct_repayments(),
         "repayment_id drawdown_id facility_id customer_id scheduled_amount actual_amount currency due_date "
         "actual_date scheduled_vs_actual_lag_days status is_orphaned", "SELECT * FROM fct_r")
register("fct_fx_transactions", lambda s, d: wh(s, d).fct_fx_transactions(),
         "transaction_id customer_id base_currency quote_currency currency_pair notional_base notional_quote "
         "effective_rate rate_type transaction_date is_orphaned", "SELECT * FROM fct_x")


def _star(s, d: str, fact: str) -> BucketedStar:
    staged = ENTITIES[fact.removeprefix("fct_")].table
    return BucketedStar(built_models(s, d, staged), shared_folder(s, "star"), 16)


for _fact, _table in {"fct_drawdowns": "fct_d", "fct_repayments": "fct_r", "fct_fx_transactions": "fct_x"}.items():
    register(f"bucketed_{_fact}", lambda s, d, fact=_fact: getattr(_star(s, d, fact), fact)(),
             " ".join(field.split()[0] for field in MART_SCHEMAS[_fact].split(", ")), f"SELECT * FROM {_table}")

# --- report pack ------------------------------------------------------------

_TOP = "company_name lifetime_arr total_facility_limit total_drawn_amount"


def _top_sql(by: str, k: int) -> str:
    return f"SELECT * FROM dim_c ORDER BY {by} DESC NULLS LAST, customer_id LIMIT {k}"


register("q01_top_customers_by_limit", lambda s, d: r.top_customers(wh(s, d).dim_customers(), "total_facility_limit", 5),
         _TOP, _top_sql("total_facility_limit", 5))
register("q02_portfolio_by_status", lambda s, d: r.portfolio_by_status(wh(s, d).dim_credit_facilities()),
         "facility_status facilities total_limit avg_util_pct",
         "SELECT facility_status, count(*) AS facilities, sum(facility_limit) AS total_limit, "
         "avg(current_utilization_pct) AS avg_util_pct FROM dim_f GROUP BY 1")
register("q03_drawdowns_per_month", lambda s, d: r.drawdowns_per_month(wh(s, d).fct_drawdowns()),
         "month drawdowns total_amount",
         "SELECT date_trunc('month', drawdown_date) AS month, count(*) AS drawdowns, sum(amount) AS total_amount "
         "FROM fct_d WHERE NOT is_orphaned GROUP BY 1")
register("q04_repayment_lateness", lambda s, d: r.repayment_lateness(wh(s, d).fct_repayments()),
         "bucket repayments total_amount",
         "SELECT CASE WHEN scheduled_vs_actual_lag_days <= 0 THEN 'on time / early' "
         "WHEN scheduled_vs_actual_lag_days <= 7 THEN '1-7 days late' "
         "WHEN scheduled_vs_actual_lag_days <= 30 THEN '8-30 days late' ELSE '30+ days late' END AS bucket, "
         "count(*) AS repayments, sum(actual_amount) AS total_amount FROM fct_r "
         "WHERE NOT is_orphaned AND actual_date IS NOT NULL GROUP BY 1")
register("q05_fx_by_pair", lambda s, d: r.fx_by_pair(wh(s, d).fct_fx_transactions()),
         "currency_pair transactions total_notional_base",
         "SELECT currency_pair, count(*) AS transactions, sum(notional_base) AS total_notional_base FROM fct_x "
         "WHERE NOT is_orphaned GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 6")
register("q06_limit_concentration", lambda s, d: r.concentration(wh(s, d).dim_customers()),
         "customer_id total_facility_limit pct_of_total",
         "SELECT customer_id, total_facility_limit, round(CAST(total_facility_limit AS DOUBLE) / "
         "CAST(sum(total_facility_limit) OVER () AS DOUBLE) * 100, 2) AS pct_of_total FROM dim_c "
         "WHERE total_facility_limit > 0 ORDER BY total_facility_limit DESC, customer_id NULLS LAST LIMIT 5")
register("q07_currency_mix", lambda s, d: r.currency_mix(wh(s, d).dim_credit_facilities()),
         "currency facilities total_limit",
         "SELECT coalesce(currency, '(null)') AS currency, count(*) AS facilities, sum(facility_limit) AS total_limit "
         "FROM dim_f GROUP BY 1")
register("q08_customer_profile", lambda s, d: r.customer_profile(wh(s, d).dim_customers(), CUSTOMER),
         "customer_id company_name country_code industry headcount_at_application valuation_at_application "
         "arr_at_application lifetime_arr arr_growth_pct total_facility_limit total_drawn_amount "
         "primary_account_currency current_headcount current_valuation team_growth_pct "
         "valuation_increase_multiple arr_variance_pct is_orphaned",
         f"SELECT * FROM dim_c WHERE customer_id = '{CUSTOMER}'")
register("q09_customer_drawdowns", lambda s, d: r.drawdown_history(wh(s, d).fct_drawdowns(), CUSTOMER),
         "drawdown_date amount currency status",
         f"SELECT * FROM fct_d WHERE NOT is_orphaned AND customer_id = '{CUSTOMER}'")
register("q10_customer_repayments", lambda s, d: r.repayment_health(wh(s, d).fct_repayments(), CUSTOMER),
         "scheduled_repayments paid_repayments avg_lag_days",
         "SELECT count(*) AS scheduled_repayments, count(actual_date) AS paid_repayments, "
         f"avg(scheduled_vs_actual_lag_days) AS avg_lag_days FROM fct_r WHERE NOT is_orphaned AND customer_id = '{CUSTOMER}'")
register("q11_days_to_drawdown", lambda s, d: r.days_to_drawdown(wh(s, d).fct_drawdowns()),
         "min_days avg_days max_days",
         "SELECT min(days_since_facility_approval) AS min_days, avg(days_since_facility_approval) AS avg_days, "
         "max(days_since_facility_approval) AS max_days FROM fct_d WHERE NOT is_orphaned")
def _census(w):
    return r.orphan_census(*[w.orphan_flags(name) for name in ("drawdowns", "repayments", "fx_transactions")])


register("q12_orphan_census",
         lambda s, d: _census(wh(s, d).prepared(lambda rows, name: written(rows, name), _census)),
         "entity orphans total orphan_pct",
         " UNION ALL ".join(
             f"SELECT '{name}' AS entity, count(*) FILTER (is_orphaned) AS orphans, count(*) AS total, "
             f"round(100.0::DOUBLE * count(*) FILTER (is_orphaned) / count(*), 1) AS orphan_pct FROM {table}"
             for name, table in [("drawdowns", "fct_d"), ("repayments", "fct_r"), ("fx_transactions", "fct_x")]))
register("q13_repayment_watchlist",
         lambda s, d: (lambda w: r.repayment_watchlist_staged(
             w.staged("repayments", "facility_id", "customer_id", "due_date", "actual_date"), w.facility_keys(), w.dim_customers()))(wh(s, d)),
         "company_name scheduled paid avg_lag_days",
         "SELECT company_name, count(repayment_id) AS scheduled, count(actual_date) AS paid, "
         "round(avg(scheduled_vs_actual_lag_days), 1) AS avg_lag_days FROM fct_r JOIN dim_c USING (customer_id) "
         "WHERE NOT fct_r.is_orphaned GROUP BY 1 HAVING count(repayment_id) > 5 ORDER BY 4 DESC NULLS LAST, 1 LIMIT 10")
register("q14_drawn_per_company",
         lambda s, d: (lambda w: r.drawn_per_company_staged(
             w.staged("drawdowns", "facility_id", "customer_id", "amount"), w.facility_keys(), w.dim_customers()))(wh(s, d)),
         "company_name total_drawn",
         "SELECT company_name, sum(amount) AS total_drawn FROM fct_d JOIN dim_c USING (customer_id) "
         "WHERE NOT fct_d.is_orphaned GROUP BY 1")
register("q15_drawdown_status_counts", lambda s, d: r.drawdown_status_counts(wh(s, d).fct_drawdowns()),
         "completed pending",
         "SELECT count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending FROM fct_d")
register("q16_active_facilities", lambda s, d: r.active_facilities(wh(s, d).dim_credit_facilities()),
         "facilities total_limit",
         "SELECT count(*) AS facilities, sum(facility_limit) AS total_limit FROM dim_f WHERE facility_status = 'active'")
register("q17_recent_drawdowns_per_month",
         lambda s, d: r.drawdowns_per_month(wh(s, d).fct_drawdowns(), c.ntz(AS_OF), 6),
         "month drawdowns total_amount",
         "SELECT date_trunc('month', drawdown_date) AS month, count(*) AS drawdowns, sum(amount) AS total_amount "
         f"FROM fct_d WHERE NOT is_orphaned AND drawdown_date >= TIMESTAMP '{AS_OF}' - INTERVAL 6 MONTH GROUP BY 1")
register("q18_overdrawn_customers", lambda s, d: r.overdrawn_customers(wh(s, d).dim_customers()),
         "customer_id company_name total_facility_limit total_drawn_amount",
         "SELECT * FROM dim_c WHERE total_drawn_amount > total_facility_limit")
register("q19_over_utilised_facilities", lambda s, d: r.over_utilised(wh(s, d).dim_credit_facilities()),
         "facility_id customer_id facility_limit current_utilization_pct",
         "SELECT * FROM dim_f WHERE facility_status = 'active' AND current_utilization_pct > 100")
register("q20a_top_customers_by_drawn", lambda s, d: r.top_customers(wh(s, d).dim_customers(), "total_drawn_amount", 10),
         _TOP, _top_sql("total_drawn_amount", 10))
register("q20b_top_customers_by_arr", lambda s, d: r.top_customers(wh(s, d).dim_customers(), "lifetime_arr", 10),
         _TOP, _top_sql("lifetime_arr", 10))
register("q21_busiest_pair_last_quarter", lambda s, d: r.busiest_pair(wh(s, d).fct_fx_transactions(), c.ntz(FX_AS_OF)),
         "currency_pair transactions total_notional_base",
         "SELECT currency_pair, count(*) AS transactions, sum(notional_base) AS total_notional_base FROM fct_x "
         f"WHERE NOT is_orphaned AND transaction_date >= TIMESTAMP '{FX_AS_OF}' - INTERVAL 3 MONTH "
         "GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 1")
register("q22_arr_to_limit", lambda s, d: r.arr_to_limit(wh(s, d).dim_customers()),
         "customer_id lifetime_arr total_facility_limit arr_to_limit",
         "SELECT *, CASE WHEN total_facility_limit <> 0 THEN lifetime_arr / CAST(total_facility_limit AS DOUBLE) END "
         "AS arr_to_limit FROM dim_c")
register("q23_invoiced_revenue",
         lambda s, d: (lambda w: r.invoiced_revenue(
             w.staged("invoices"), w.staged("fx_transactions"), w.arr_per_customer(), c.ntz(INVOICE_AS_OF)))(wh(s, d)),
         "customer_id invoices invoiced_eur current_arr",
         "SELECT customer_id, invoices, invoiced_eur, current_arr FROM ("
         "SELECT customer_id, count(*) AS invoices, sum(CASE WHEN currency = 'EUR' THEN CAST(amount AS DOUBLE) "
         "ELSE CAST(amount AS DOUBLE) * rate_to_eur END) AS invoiced_eur FROM s_invoices "
         "LEFT JOIN eur_rate ON base_currency = currency WHERE status = 'paid' AND subscription_id IS NOT NULL "
         f"AND customer_id IS NOT NULL AND invoice_date > TIMESTAMP '{INVOICE_AS_OF}' - INTERVAL 12 MONTH "
         f"AND invoice_date <= TIMESTAMP '{INVOICE_AS_OF}' GROUP BY 1) LEFT JOIN int_arr USING (customer_id)")
register("q24_arr_by_month",
         lambda s, d: (lambda w: r.arr_by_month(w.staged("subscriptions"), w.staged("fx_transactions")))(wh(s, d)),
         "customer_id month arr previous_arr growth_pct",
         "SELECT *, CASE WHEN previous_arr <> 0 THEN (arr - previous_arr) * 100 / previous_arr END AS growth_pct FROM ("
         "SELECT m.customer_id, m.month, m.arr, p.arr AS previous_arr FROM monthly_arr m LEFT JOIN monthly_arr p "
         "ON p.customer_id = m.customer_id AND p.month = m.month - INTERVAL 1 MONTH)")
