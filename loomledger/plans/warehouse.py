"""Wire the models together over a source of raw envelopes."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.plans import intermediate, marts
from loomledger.plans.entities import ENTITIES
from loomledger.plans.staging import newest_ingestion, stage
from loomledger.plans.strict import stage_recovered

RawSource = Callable[[str], DataFrame]

STAGING_NAMES = [entity.table for entity in ENTITIES.values()]
INTERMEDIATE_NAMES = [
    "int_arr_per_customer", "int_facility_utilization", "int_fx_rates_normalized", "int_repayment_schedule",
]


class Warehouse:
    """Every model as a lazy DataFrame.

    ``raw`` gives the envelopes of an entity by name. Nothing is computed
    until an action; asking for one model plans only what it depends on.
    ``tables`` replaces models by already written ones. ``strict`` reads the raw
    events with all recoveries (``strict.stage_recovered``), whose parsed rows are
    written as soon as a model needs them.
    """

    def __init__(self, spark: SparkSession, raw: RawSource, now: Column | None = None,
                 tables: dict[str, DataFrame] | None = None, strict: bool = False):
        self.spark = spark
        self.raw = raw
        self.now = now
        self.strict = strict
        self.tables = dict(tables or {})
        self._lazy: dict[str, DataFrame] = {}

    def staged(self, entity: str, *columns: str) -> DataFrame:
        """A staging relation; with ``columns``, at least those and the key.

        Naming the columns matters while staging is not written: Catalyst does
        not prune the fields of a payload that is parsed for several columns,
        so only the named keys are asked for in the first place.
        """
        spec = ENTITIES[entity]
        if self.strict:
            return self._model(spec.table, lambda: stage_recovered(self.raw(entity), spec))
        if spec.table in self.tables or not columns:
            return self._model(spec.table, lambda: stage(self.raw(entity), spec))
        narrow = spec.only(*columns)
        return self._model(f"{spec.table}:{','.join(narrow.columns)}", lambda: stage(self.raw(entity), narrow))

    def _usable_rates(self) -> DataFrame:
        return self.staged("fx_transactions", "base_currency", "quote_currency", "rate", "transaction_date")

    def _model(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        if name not in self._lazy:
            self._lazy[name] = build()
        return self._lazy[name]

    def _mart(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        # A lazy mart is not remembered: facts then look keys up in staging,
        # and only a written dimension replaces that.
        return self.tables[name] if name in self.tables else build()

    @cached_property
    def as_of(self) -> Column:
        subscriptions = ENTITIES["subscriptions"]
        if self.strict or subscriptions.table in self.tables:
            newest = self.staged("subscriptions").agg(F.max("_ingested_at").alias("newest"))
        else:
            newest = newest_ingestion(self.raw("subscriptions"), subscriptions)
        return intermediate.as_of_instant(newest, self.now)

    def prepared(self, write: Callable[[DataFrame, str], DataFrame], build: Callable[[Warehouse], object]) -> Warehouse:
        """A warehouse for what ``build`` asks of one: every entity that it needs is staged once, with the columns it needs.

        ``build`` is run first to see which columns of which entities it names; those
        are staged together and given to ``write`` (rows, name), which returns them as a
        written table. Reports that share entities then parse no payload twice.
        """
        demand = _Demand(self)
        build(demand)
        tables = dict(self.tables)
        for entity, columns in demand.columns.items():
            spec = ENTITIES[entity]
            if spec.table not in tables:
                rows = self.staged(entity) if columns is None else self.staged(entity, *sorted(columns))
                tables[spec.table] = write(rows, spec.table)
        return Warehouse(self.spark, self.raw, self.now, tables, self.strict)

    # --- intermediate; with ``columns`` a model has at least those and its key, where narrowing it spares staging ---

    def arr_per_customer(self, *columns: str) -> DataFrame:
        subscriptions = self.staged(
            "subscriptions", "customer_id", "mrr_amount", "currency", "status", "billing_period_start",
            "billing_period_end", "created_at")
        return self._model("int_arr_per_customer", lambda: intermediate.arr_per_customer(
            subscriptions, self._usable_rates(), self.as_of))

    def facility_positions(self, *columns: str) -> DataFrame:
        asked = columns or ("application_id", "currency", "approval_date", "maturity_date", "status", "interest_rate")
        facilities = self.staged("credit_facilities", "customer_id", "facility_limit", *marts.staged_for(asked))
        return intermediate.facility_positions(facilities, self.staged("drawdowns", "facility_id", "amount", "status"))

    def facility_utilization(self, *columns: str) -> DataFrame:
        return self._model("int_facility_utilization", lambda: intermediate.facility_utilization(
            self.staged("credit_facilities", "customer_id", "facility_limit", "currency", "status"),
            self.staged("drawdowns", "facility_id", "amount", "status")))

    def fx_rates_normalized(self, *columns: str) -> DataFrame:
        if "int_fx_rates_normalized" in self.tables or not columns:
            return self._model("int_fx_rates_normalized", lambda: intermediate.fx_rates_normalized(
                self.staged("fx_transactions")))
        needed = {"currency_pair": ("base_currency", "quote_currency"), "quote_amount": ("quote_amount", "base_amount", "rate"),
                  "effective_rate": ("rate",)}
        staged = [name for column in columns for name in needed.get(column, (column,))]
        return intermediate.fx_rates_normalized(
            self.staged("fx_transactions", "transaction_id", *staged), ("transaction_id", *columns))

    def repayment_schedule(self, *columns: str) -> DataFrame:
        return self._model("int_repayment_schedule", lambda: intermediate.repayment_schedule(
            self.staged("credit_facilities", "customer_id", "currency", "repayment_schedule_json")))

    # --- marts ---

    def customer_keys(self) -> DataFrame:
        """Keys of ``dim_customers``: read from it once it is written."""
        if "dim_customers" in self.tables:
            return self.tables["dim_customers"].select("customer_id")
        return marts.customer_keys(self.staged("loan_applications", "customer_id", "status"))

    def facility_lookup(self) -> DataFrame:
        """Keys and approval dates of ``dim_credit_facilities``."""
        source = self._mart("dim_credit_facilities", lambda: self.staged("credit_facilities", "approval_date"))
        if "approval_date" not in source.columns:
            source = self.staged("credit_facilities", "approval_date")
        return source.select("facility_id", "approval_date")

    def facility_keys(self) -> DataFrame:
        source = self._mart("dim_credit_facilities", lambda: self.staged("credit_facilities", "facility_id"))
        return source.select("facility_id")

    def dim_customers(self, *columns: str) -> DataFrame:
        if columns:
            columns = ("customer_id", *columns)
        asked = lambda *names: not columns or not set(names).isdisjoint(columns)
        # A side that is not asked for is not staged either.
        side = lambda entity, needed, *names: self.staged(entity, *names) if needed else None
        company = [] if not asked(*marts.COMPANY) else [
            "company_name", "country_code", "industry", "headcount_at_application", "valuation_at_application",
            "arr_at_application", "application_date"]
        return self._mart("dim_customers", lambda: marts.dim_customers(
            self.staged("loan_applications", "customer_id", "status", *company),
            side("credit_facilities", asked("total_facility_limit"), "customer_id", "facility_limit", "status"),
            side("drawdowns", asked("total_drawn_amount"), "customer_id", "amount", "status"),
            side("account_balances", asked("primary_account_currency"), "customer_id", "currency", "balance"),
            side("company_metrics", asked(*marts.OF_METRICS), "customer_id", "metric_date", "headcount", "valuation", "arr_reported"),
            self.arr_per_customer() if asked(*marts.OF_ARR) else None, columns))

    def dim_credit_facilities(self, *columns: str) -> DataFrame:
        if columns:
            columns = ("facility_id", *columns)
        return self._mart("dim_credit_facilities", lambda: marts.dim_credit_facilities(
            self.facility_positions(*columns), self.customer_keys(), columns))

    def _fact(self, entity: str, columns: tuple[str, ...], *parents: str) -> DataFrame:
        """What a fact with these columns reads of its staging: all, or the columns behind them and the keys."""
        return self.staged(entity, *([*parents, *marts.staged_for(columns)] if columns else []))

    def fct_drawdowns(self, *columns: str) -> DataFrame:
        if columns:
            columns = ("drawdown_id", *columns)
        dated = not columns or "days_since_facility_approval" in columns
        return self._mart("fct_drawdowns", lambda: marts.fct_drawdowns(
            self._fact("drawdowns", columns, "facility_id", "customer_id"),
            self.facility_lookup() if dated else self.facility_keys(), self.customer_keys(), columns))

    def fct_repayments(self, *columns: str) -> DataFrame:
        if columns:
            columns = ("repayment_id", *columns)
        return self._mart("fct_repayments", lambda: marts.fct_repayments(
            self._fact("repayments", columns, "facility_id", "customer_id"), self.facility_keys(), self.customer_keys(), columns))

    def fct_fx_transactions(self, *columns: str) -> DataFrame:
        if columns:
            columns = ("transaction_id", *columns)
        return self._mart("fct_fx_transactions", lambda: marts.fct_fx_transactions(
            self._fact("fx_transactions", columns, "customer_id"), self.customer_keys(), columns))

    def orphan_flags(self, entity: str) -> DataFrame:
        """Whether each row of a fact entity lacks a parent, from the keys alone."""
        if "facility_id" in ENTITIES[entity].columns:
            return marts.orphan_flags(self.staged(entity, "facility_id", "customer_id"), self.customer_keys(), self.facility_keys())
        return marts.orphan_flags(self.staged(entity, "customer_id"), self.customer_keys())

    def model(self, name: str, *columns: str) -> DataFrame:
        """Any of the eighteen models by name; with ``columns``, at least those and the key."""
        for entity in ENTITIES.values():
            if entity.table == name:
                return self.staged(entity.name, *columns)
        return getattr(self, name.removeprefix("int_"))(*columns)

    def register_views(self) -> None:
        """Expose all models to ``spark.sql`` under their names."""
        for name in [*STAGING_NAMES, *INTERMEDIATE_NAMES, *marts.MART_NAMES]:
            self.model(name).createOrReplaceTempView(name)


class _Demand(Warehouse):
    """Notes which columns of which entities are asked for; None stands for all."""

    def __init__(self, of: Warehouse):
        super().__init__(of.spark, of.raw, of.now, of.tables, of.strict)
        self.columns: dict[str, set[str] | None] = {}

    def staged(self, entity: str, *columns: str) -> DataFrame:
        known = self.columns.get(entity, set())
        self.columns[entity] = None if not columns or known is None else known | set(columns)
        return super().staged(entity, *columns)
