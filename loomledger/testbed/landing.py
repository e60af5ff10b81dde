"""Derive dirty raw events of the nine entities from TPC-H-like tables.

Every row and every defect follows from the keys of the source tables by
modulo rules, so an oracle can state the expected clean value without ever
seeing the JSON. Volumes grow with the source tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.plans.entities import ENTITIES, Entity
from loomledger.plans.quality import Check, columns_read
from loomledger.plans.warehouse import Warehouse
from loomledger.functions import columns as c
from loomledger.generate import rates
from loomledger.session import shared_folder
from loomledger.sources.envelope import DAY_COLUMNS, deal_by_day, pack, read_raw_events, sort_by_day, write_raw_events
from loomledger.sources.tables import build, materialise

# Rotation of currency texts as they arrive.
CURRENCY_TEXTS = ["GBP", "EUR", "CHF", "SEK", "NOK", "DKK", "ISK", "USD", "CAD", "usd", "EURO", ""]
# Rotation of country texts as they arrive.
COUNTRY_TEXTS = ["gb", "DE", "SE", "", "XX", "FR", "Us", "UK"]
# Currency pairs with a rate in millionths, so that both engines compute in whole numbers.
PAIRS = [(base, quote, round(rate * 1_000_000)) for (base, quote), rate in rates.FX_RATES.items()]

# Days of month whose batches are damaged.
RENAMED_KEY_DAYS = {8: "customerId", 20: "Customer_ID"}
TEXT_CENTS_DAY, WHOLE_CENTS_DAY, TEXT_MAJOR_DAY = 12, 14, 18

# Commerce dates are moved forward so that their epoch text has ten digits.
SHIFT_DAYS = 9131
# The clock every testbed run is given.
NOW = "2024-02-15 00:00:00"


def e(sql: str) -> Column:
    return F.expr(sql)


def pick(values: list[object], index: Column) -> Column:
    """values[index], index counted from 0."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def date_text(ts: Column, form: Column) -> Column:
    """A timestamp in one of ten text forms."""
    return (
        F.when(form == 0, F.timestamp_diff("SECOND", F.expr(c.EPOCH), ts).cast("string"))
        .when(form == 1, F.date_format(ts, "MM/dd/yyyy"))
        .when(form == 2, F.lit("13/45/2026"))
        .when(form == 3, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 4, F.date_format(ts, "dd-MM-yyyy"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    )


def ingested(day: Column, second: Column, stale: Column, extra_days: Column) -> Column:
    """A time within the 30-day window, or 45 to 59 days earlier when stale."""
    offset = F.when(stale, day - 45 - extra_days).otherwise(day)
    return e("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(
        offset.cast("int"), F.lit(0), F.lit(0), second.cast("decimal(18,6)"))


def amount_variants(value: Column) -> Column:
    """A money amount as the batch of the day carries it."""
    day = F.dayofmonth("_ingested_at")
    cents = F.round(value * 100, 0).cast("bigint")
    return (
        F.when(day == TEXT_CENTS_DAY, cents.cast("string").cast("variant"))
        .when(day == WHOLE_CENTS_DAY, cents.cast("variant"))
        .when(day == TEXT_MAJOR_DAY, value.cast("string").cast("variant"))
        .otherwise(value.cast("variant"))
    )


def to_envelopes(rows: DataFrame, entity: Entity) -> DataFrame:
    """Pack clean payload columns, damaging keys and amounts by batch day."""
    day = F.dayofmonth("_ingested_at")
    payload: list[Column] = []
    for name in entity.columns:
        value = F.col(name)
        if name == "customer_id":
            payload.append(F.when(~day.isin(*RENAMED_KEY_DAYS), value).alias(name))
            payload += [F.when(day == d, value).alias(variant) for d, variant in RENAMED_KEY_DAYS.items()]
        elif name in entity.amounts:
            payload.append(amount_variants(value).alias(name))
        else:
            payload.append(value.alias(name))
    return pack(rows.withColumn("_schema_version", F.lit(1)), entity, payload)


def batch_id(entity: str, *parts: Column) -> Column:
    spec = ENTITIES[entity]
    return F.concat_ws("_", F.lit(f"{spec.source}_{entity}"), F.date_format("_ingested_at", "yyyy-MM-dd"), *parts)


def padded(number: Column, width: int = 12) -> Column:
    return F.lpad(number.cast("string"), width, "0")


class Tables:
    """The source tables of one scale-factor folder.

    With ``by_day`` the builders deal their rows by ingestion day while they are
    narrow (``dealt``) and carry the day's columns, so that envelopes are written
    where their rows lie. With ``in_place`` as well, the rows of a table that is read by as
    many tasks as there are cores are sorted by day in those tasks and not dealt.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, by_day: bool = False, in_place: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.days = DAY_COLUMNS if by_day else []
        self.in_place = in_place
        self.spread = False

    def __call__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self.spread = self.in_place and read_by_many(table)
        # A file with a single row group is read by one task; spread it before the JSON work.
        return table if self.days else table.repartition(self.spark.sparkContext.defaultParallelism)

    def dealt(self, rows: DataFrame) -> DataFrame:
        if not self.days:
            return rows
        return sort_by_day(rows) if self.spread else deal_by_day(rows)


def read_by_many(table: DataFrame) -> bool:
    """Whether as many tasks as there are cores get rows of a stored table.

    A split that holds no start of a row group gives none, so the rows of splits are counted, from the footers alone.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.rdd.getNumPartitions() >= cores and table.select(F.spark_partition_id()).distinct().count() >= cores


# --- one function per entity ----------------------------------------------

def subscriptions(t: Tables) -> DataFrame:
    k = F.col("event_id")
    rows = (
        t.dealt(
            t("events")
            .select("event_id", "user_id", "event_type", "value", "ts")
            .withColumn("copy", F.explode(e("if(event_id % 40 = 0, array(0, 1), array(0))")))
            .withColumn("_ingested_at", ingested(k * 7 % 30, k % 86400 + F.col("copy"), k % 20 == 7, k % 15)))
        .withColumn("start", e("cast(date_sub(cast(ts as date), cast(event_id % 4 * 15 as int)) as timestamp_ntz)"))
    )
    return rows.select(
        "_ingested_at",
        F.when(k % 211 != 5, F.concat(F.lit("S"), k)).alias("subscription_id"),
        F.when(k % 101 != 0, F.concat(F.lit("C"), "user_id")).alias("customer_id"),
        F.when(k % 9 != 0, F.concat(F.lit("plan_"), k % 20)).alias("plan_id"),
        pick(rates.PLANS, k % 6).alias("plan_name"),
        (F.col("value") + F.col("copy")).alias("mrr_amount"),
        pick(CURRENCY_TEXTS, k % 12).alias("currency"),
        e("case event_type when 'signup' then 'cancelled' when 'error' then 'PAUSED' else 'Active' end").alias("status"),
        date_text(F.col("start"), k % 10).alias("billing_period_start"),
        date_text(e("start + interval 30 days"), (k + 5) % 10).alias("billing_period_end"),
        e("case event_id % 6 when 0 then null when 1 then '12' when 2 then concat(event_id % 49 + 1, '.5') "
          "else cast(event_id % 49 + 1 as string) end").alias("quantity"),
        date_text(e("start - make_dt_interval(cast(event_id % 365 as int))"), F.lit(9)).alias("created_at"),
        batch_id("subscriptions", padded(k)).alias("_batch_id"), *t.days,
    )


def invoices(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = (
        t.dealt(
            t("orders")
            .withColumn("_ingested_at", ingested(k * 11 % 30, k % 86400, k % 20 == 3, k % 15)))
        .withColumn("d", e(f"o_orderdate + interval {SHIFT_DAYS} days"))
    )
    return rows.select(
        "_ingested_at",
        F.when(k % 199 != 1, F.concat(F.lit("I"), k)).alias("invoice_id"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        F.when(k % 5 != 0, F.concat(F.lit("S"), k % 10000)).alias("subscription_id"),
        e("if(o_orderkey % 61 = 0, -o_totalprice, o_totalprice)").alias("amount"),
        pick(CURRENCY_TEXTS, k % 12).alias("currency"),
        date_text(F.col("d"), k % 10).alias("invoice_date"),
        date_text(e("d + interval 14 days"), (k + 3) % 10).alias("due_date"),
        F.when(F.col("o_orderstatus") != "O", date_text(
            e("d + make_dt_interval(cast(o_orderkey % 19 + 1 as int))"), (k + 6) % 10)).alias("paid_at"),
        e("case o_orderstatus when 'F' then 'Paid' when 'O' then 'open' else 'VOID' end").alias("status"),
        F.concat(F.lit('[{"description":"order '), k, F.lit('","amount":'), k, F.lit(',"currency":"EUR"}]'))
        .alias("line_items_json"),
        batch_id("invoices", padded(k)).alias("_batch_id"), *t.days,
    )


def loan_applications(t: Tables) -> DataFrame:
    rows = (
        t("customer")
        .withColumn("n", F.explode(e("sequence(0, cast(c_custkey % 3 as int))")))
        .withColumn("k", e("c_custkey * 3 + n"))
    )
    k, n, cust = F.col("k"), F.col("n"), F.col("c_custkey")
    rows = t.dealt(rows.withColumn("_ingested_at", ingested(k * 13 % 30, k % 86400, k % 20 == 11, k % 15)))
    return rows.select(
        "_ingested_at",
        F.when((cust + n) % 97 != 96, F.concat(F.lit("A"), cust, F.lit("-"), n)).alias("application_id"),
        F.concat(F.lit("C"), cust).alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.when(cust % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("R"), cust)).alias("company_registration_number"),
        pick(COUNTRY_TEXTS, F.col("c_nationkey") % 8).alias("country_code"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_acctbal").alias("requested_amount"),
        pick(CURRENCY_TEXTS, k % 12).alias("currency"),
        date_text(e("timestamp_ntz'2022-01-01 00:00:00' + make_dt_interval(cast((c_custkey * 7 + n * 100) % 700 as int))"),
                  k % 10).alias("application_date"),
        e("case when c_custkey % 4 = 0 then element_at(array('Rejected', 'pending', 'cancelled'), n + 1) "
          "else element_at(array('approved', 'APPROVED', 'rejected'), n + 1) end").alias("status"),
        e("case when c_custkey % 31 = 0 then -50.0D when c_custkey % 7 = 0 then 250.5D + c_custkey % 650 "
          "else 250.0D + c_custkey % 650 end").alias("credit_score"),
        pick(["low", "medium", "high", "N/A"], k % 4).alias("risk_rating"),
        F.when(k % 8 != 0, cust % 195 + 5).alias("headcount_at_application"),
        (cust * 1000 + 500000).alias("valuation_at_application"),
        (cust * 100 + 200000).alias("arr_at_application"),
        F.when(F.dayofmonth("_ingested_at") % 4 == 1, F.concat(F.lit("ref"), k % 5)).alias("referral_source"),
        batch_id("loan_applications", padded(k)).alias("_batch_id"), *t.days,
    )


def credit_facilities(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = (
        t.dealt(
            t("orders")
            .withColumn("copy", F.explode(e("if(o_orderkey % 25 = 0, array(0, 1), array(0))")))
            .withColumn("_ingested_at", ingested(k * 17 % 30, k % 86400 + F.col("copy"), k % 20 == 13, k % 15)))
        .withColumn("d", e(f"o_orderdate + interval {SHIFT_DAYS} days"))
    )
    instalments = e(
        "transform(sequence(1, if(o_orderkey % 7 = 0, 1, 3)), i -> named_struct("
        "'due_date', date_format(d + make_dt_interval(30 * i), 'yyyy-MM-dd'), "
        "'amount', (o_orderkey % 1000) + 0.25D * i))"
    )
    return rows.select(
        "_ingested_at",
        F.when(k % 211 != 0, F.concat(F.lit("F"), k)).alias("facility_id"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        F.when(k % 5 != 0, F.concat(F.lit("A"), "o_custkey", F.lit("-0"))).alias("application_id"),
        e("case when o_orderkey % 97 = 0 then -o_totalprice when o_orderkey % 89 = 0 then 0.0D "
          "else o_totalprice + copy end").alias("facility_limit"),
        pick(CURRENCY_TEXTS, k % 12).alias("currency"),
        date_text(F.col("d"), k % 10).alias("approval_date"),
        date_text(e("d + interval 730 days"), (k + 4) % 10).alias("maturity_date"),
        e("case o_orderstatus when 'F' then 'active' when 'O' then 'Closed' else 'SUSPENDED' end").alias("status"),
        ((k % 100 + 80) / F.lit(1000.0)).alias("interest_rate"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit("")).when(k % 17 == 0, F.lit("[]"))
        .otherwise(F.to_json(instalments)).alias("repayment_schedule_json"),
        F.when(F.dayofmonth("_ingested_at") % 4 == 0, k % 2 == 0).alias("collateral_required"),
        batch_id("credit_facilities", padded(k)).alias("_batch_id"), *t.days,
    )


def _lineitem_key() -> Column:
    return F.col("l_orderkey") * 7 + F.col("l_linenumber")


def _lineitem_batch(entity: str) -> Column:
    cents = F.round(F.col("l_extendedprice") * 100, 0).cast("bigint")
    return batch_id(entity, padded(F.col("l_partkey")), padded(F.col("l_suppkey")), padded(cents))


def _line_id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), "l_orderkey", F.lit("-"), "l_linenumber")


def drawdowns(t: Tables) -> DataFrame:
    m, part, order = _lineitem_key(), F.col("l_partkey"), F.col("l_orderkey")
    rows = (
        t.dealt(
            t("lineitem")
            .withColumn("_ingested_at", ingested(
                (m + part) % 30, (F.col("l_suppkey") * 101 + part) % 86400, part % 20 == 9, part % 15)))
        .withColumn("d", e(f"l_shipdate + interval {SHIFT_DAYS} days"))
    )
    return rows.select(
        "_ingested_at",
        F.when(order % 53 != 0, _line_id("D")).alias("drawdown_id"),
        F.when(part % 103 == 7, F.lit(None)).when(part % 20 == 3, F.concat(F.lit("X"), order))
        .otherwise(F.concat(F.lit("F"), order)).alias("facility_id"),
        F.concat(F.lit("C"), part).alias("customer_id"),
        F.when(m % 33 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
        pick(CURRENCY_TEXTS, m % 12).alias("currency"),
        date_text(F.col("d"), m % 10).alias("drawdown_date"),
        pick(rates.PURPOSES, F.col("l_linenumber") % 5).alias("purpose"),
        e("case l_returnflag when 'A' then 'Completed' when 'N' then 'pending' else 'FAILED' end").alias("status"),
        _lineitem_batch("drawdowns").alias("_batch_id"), *t.days,
    )


def repayments(t: Tables) -> DataFrame:
    m, part, order = _lineitem_key(), F.col("l_partkey"), F.col("l_orderkey")
    rows = (
        t.dealt(
            t("lineitem")
            .withColumn("_ingested_at", ingested(
                (m * 3 + part) % 30, (F.col("l_suppkey") * 103 + part) % 86400, part % 20 == 17, part % 15)))
        .withColumn("d", e(f"l_shipdate + interval {SHIFT_DAYS} days"))
        .withColumn("unpaid", (F.col("l_linestatus") == "O") & (m % 4 == 0))
        # Columns of their own: written into every form of a date, they make a method too long for the JVM to compile.
        .withColumn("due", F.col("d") - F.make_dt_interval((m * 5 % 45 - 10).cast("int")))
        .withColumn("form", m % 10).withColumn("due_form", (m + 2) % 10)
    )
    return rows.select(
        "_ingested_at",
        F.when(order % 211 != 9, _line_id("R")).alias("repayment_id"),
        F.when(order % 53 != 0, _line_id("D")).alias("drawdown_id"),
        F.when(part % 50 == 7, F.concat(F.lit("X"), order)).otherwise(F.concat(F.lit("F"), order)).alias("facility_id"),
        F.concat(F.lit("C"), part).alias("customer_id"),
        F.col("l_extendedprice").alias("scheduled_amount"),
        F.when(~F.col("unpaid"), F.col("l_extendedprice") - F.col("l_quantity")).alias("actual_amount"),
        pick(CURRENCY_TEXTS, m % 12).alias("currency"),
        date_text(F.col("due"), F.col("due_form")).alias("due_date"),
        F.when(~F.col("unpaid"), date_text(F.col("d"), F.col("form"))).alias("actual_date"),
        F.when(m % 40 == 0, F.lit("forgiven")).otherwise(
            e("case l_returnflag when 'A' then 'Paid' when 'N' then 'scheduled' else 'OVERDUE' end")).alias("status"),
        _lineitem_batch("repayments").alias("_batch_id"), *t.days,
    )


def fx_transactions(t: Tables) -> DataFrame:
    k = F.col("event_id")
    pair = k * 5 % 16
    micro = pick([p[2] for p in PAIRS], pair).cast("bigint") + (k % 7 - 3) * 1000
    base_amount = F.lit(1000) + k % 500 * 100
    rows = (
        t.dealt(
            t("events")
            .select("event_id", "user_id", "ts")
            .withColumn("_ingested_at", ingested(k * 19 % 30, k % 86400, k % 20 == 1, k % 15)))
        .withColumn("micro", micro)
        .withColumn("d", e("cast(date_format(ts, 'yyyy-MM-dd HH:mm:ss') as timestamp_ntz)"))
    )
    return rows.select(
        "_ingested_at",
        F.when(k % 211 != 50, F.concat(F.lit("T"), k)).alias("transaction_id"),
        F.concat(F.lit("C"), "user_id").alias("customer_id"),
        F.when(k % 70 == 0, F.lit("EURO")).otherwise(pick([p[0] for p in PAIRS], pair)).alias("base_currency"),
        pick([p[1] for p in PAIRS], pair).alias("quote_currency"),
        base_amount.cast("double").alias("base_amount"),
        F.when(k % 3 != 0, F.floor(base_amount * F.col("micro") / 10000.0) / 100.0).alias("quote_amount"),
        F.when(k % 90 == 0, F.lit(None)).when(k % 95 == 0, F.lit(-1.0))
        .when(k % 20 == 0, F.lit(1000000.0) / F.col("micro"))
        .otherwise(F.col("micro") / F.lit(1000000.0)).alias("rate"),
        F.when(k % 10 != 0, pick(["spot", "forward"], k % 2)).alias("rate_type"),
        date_text(F.col("d"), k % 10).alias("transaction_date"),
        F.when(F.dayofmonth("_ingested_at") % 5 != 0, F.lit("BANKGB2L")).alias("counterparty_bank_bic"),
        batch_id("fx_transactions", padded(k)).alias("_batch_id"), *t.days,
    )


def account_balances(t: Tables) -> DataFrame:
    k, user = F.col("event_id"), F.col("user_id")
    rows = (
        t.dealt(
            t("events")
            .select("event_id", "user_id", "ts", "value")
            .withColumn("_ingested_at", ingested(k * 23 % 30, k % 86400, k % 20 == 15, k % 15)))
        .withColumn("d", e("cast(cast(ts as date) as timestamp_ntz)"))
    )
    balance = F.round(F.col("value") * 100, 0)
    return rows.select(
        "_ingested_at",
        F.concat(F.lit("B"), k).alias("snapshot_id"),
        F.concat(F.when(k % 50 == 3, F.lit("X")).otherwise(F.lit("C")), user).alias("customer_id"),
        F.concat(F.lit("acct_"), user, F.lit("_"), k % 3 + 1).alias("account_id"),
        pick(CURRENCY_TEXTS, F.when(k % 4 == 0, k % 12).otherwise(user % 12)).alias("currency"),
        F.when(k % 41 == 0, -balance).otherwise(balance).alias("balance"),
        date_text(F.col("d"), k % 10).alias("snapshot_date"),
        pick(["operating", "Reserve", "FX"], k % 3).alias("account_type"),
        batch_id("account_balances", padded(k)).alias("_batch_id"), *t.days,
    )


def company_metrics(t: Tables) -> DataFrame:
    k = F.col("event_id")
    rows = (
        t.dealt(
            t("events")
            .select("event_id", "user_id", "ts", "value")
            .withColumn("_ingested_at", ingested(k * 29 % 30, k % 86400, k % 20 == 19, k % 15)))
        .withColumn("d", e("cast(cast(ts as date) as timestamp_ntz)"))
    )
    return rows.select(
        "_ingested_at",
        F.concat(F.lit("M"), k).alias("metric_id"),
        F.concat(F.lit("C"), "user_id").alias("customer_id"),
        date_text(F.col("d"), k % 10).alias("metric_date"),
        e("case when event_id % 12 = 0 then null when event_id % 23 = 0 then 0.0D when event_id % 5 = 0 "
          "then 10.5D + event_id % 90 else 10.0D + event_id % 90 end").alias("headcount"),
        F.when(k % 37 == 0, F.lit(0.0)).otherwise(k % 1000 * 500 + F.lit(1000000.0)).alias("valuation"),
        (F.round(F.col("value") * 100, 0) * 12).alias("arr_reported"),
        batch_id("company_metrics", padded(k)).alias("_batch_id"), *t.days,
    )


# --- access ---------------------------------------------------------------

BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "subscriptions": subscriptions,
    "invoices": invoices,
    "loan_applications": loan_applications,
    "credit_facilities": credit_facilities,
    "drawdowns": drawdowns,
    "repayments": repayments,
    "fx_transactions": fx_transactions,
    "account_balances": account_balances,
    "company_metrics": company_metrics,
}


# Landing folders of this session, by (application, tables folder).
_LANDED: dict[tuple[str, str], str] = {}
# Scans of landed entities; a scan lists its day folders once.
_SCANS: dict[tuple[str, str], DataFrame] = {}


def landing_of(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder for the tables in ``sf_dir``, in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        _LANDED[key] = shared_folder(spark, "landing")
    return _LANDED[key]


def packed_events(spark: SparkSession, sf_dir: str, entity: str, by_day: bool = False, in_place: bool = False) -> DataFrame:
    """Envelopes of one entity, derived from the tables and not yet written; ``by_day`` for ``write_raw_events``."""
    return to_envelopes(BUILDERS[entity](Tables(spark, sf_dir, by_day, in_place)), ENTITIES[entity])


def raw_events(spark: SparkSession, sf_dir: str, entity: str,
               since: date | None = None, until: date | None = None) -> DataFrame:
    """Envelopes of one entity, read back from its landing folder.

    An entity is derived and landed on first use, then shared by all jobs of
    the session.
    """
    landing, spec = landing_of(spark, sf_dir), ENTITIES[entity]
    if (landing, entity) not in _SCANS:
        write_raw_events(packed_events(spark, sf_dir, entity, by_day=True, in_place=True), landing, spec)
        _SCANS[landing, entity] = read_raw_events(spark, landing, spec)
    if since is None and until is None:
        return _SCANS[landing, entity]
    return read_raw_events(spark, landing, spec, since, until)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, lambda entity: raw_events(spark, sf_dir, entity), now=c.ntz(NOW))


_STRICT: dict[tuple[str, str], Warehouse] = {}


def strict_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse with all recoveries, whose parsed rows are shared by all jobs of the session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STRICT:
        _STRICT[key] = Warehouse(spark, lambda entity: raw_events(spark, sf_dir, entity), now=c.ntz(NOW), strict=True)
    return _STRICT[key]


_BUILT: dict[tuple[str, str], Warehouse] = {}


def built_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse with staging and marts written, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = build(warehouse(spark, sf_dir), shared_folder(spark, "warehouse"), with_intermediate=True)
    return _BUILT[key]


_BUILT_IN_PART: dict[tuple[str, str], Warehouse] = {}


def built_models(spark: SparkSession, sf_dir: str, *models: str) -> Warehouse:
    """The warehouse with these models written, for jobs that read no others; the whole one where it is built."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _BUILT:
        return _BUILT[key]
    known = _BUILT_IN_PART.setdefault(key, warehouse(spark, sf_dir))
    missing = [model for model in models if model not in known.tables]
    if missing:
        _BUILT_IN_PART[key] = build(known, shared_folder(spark, "warehouse"), models=missing)
    return _BUILT_IN_PART[key]


# Warehouses written for checks, with the columns that they hold of each model.
_CHECKED: dict[tuple[str, str], list[tuple[dict[str, list[str]], Warehouse]]] = {}


def checked_warehouse(spark: SparkSession, sf_dir: str, checks: list[Check]) -> Warehouse:
    """The warehouse with what the checks read written; one that is written and holds as much is used again."""
    key, columns = (spark.sparkContext.applicationId, sf_dir), columns_read(checks)
    if key in _BUILT:
        return _BUILT[key]
    known = _CHECKED.setdefault(key, [])
    for held, written in known:
        if all(set(names) <= set(held.get(model, [])) for model, names in columns.items()):
            return written
    written = build(warehouse(spark, sf_dir), shared_folder(spark, "checked"), columns=columns)
    known.append((columns, written))
    return written


def staged_warehouse(spark: SparkSession, sf_dir: str, *models: str) -> Warehouse:
    """The warehouse with what these models need of staging written, for jobs that write the models themselves."""
    key, folder = (spark.sparkContext.applicationId, sf_dir), shared_folder(spark, "warehouse")
    if key in _BUILT:
        return _BUILT[key]
    return warehouse(spark, sf_dir).prepared(
        lambda rows, name: materialise(spark, rows, f"{folder}/staging/{name}"), lambda of: [of.model(model) for model in models])


def fully_landed(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder with all nine entities present."""
    for entity in ENTITIES:
        raw_events(spark, sf_dir, entity)
    return landing_of(spark, sf_dir)
