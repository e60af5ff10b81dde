"""The facts over bucketed tables, joined without moving a fact's rows.

Loans know two parents. Facts lie in buckets by facility, so the facility is
found in place. For the customer, the fact's distinct (facility, customer) pairs
travel to the customers and the known ones come back to the facts' buckets.
Spark takes buckets by facility for a join on both keys only under ``SETTINGS``;
without them the results are the same, with one more exchange.

Facts of heavy facilities look their facilities up by broadcast (fewer heavy keys
than buckets, each with one parent) and their customers by the usual join.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.operators.keys import with_parent
from loomledger.plans import marts
from loomledger.plans.entities import ENTITIES
from loomledger.plans.warehouse import Warehouse
from loomledger.sources.bucketed import Bucketed, write_bucketed, write_buckets

SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def known_pairs(rows: DataFrame, customers: DataFrame, buckets: int) -> DataFrame:
    """The (facility, customer) pairs of ``rows`` whose customer exists, dealt as the buckets are."""
    pairs = rows.select("facility_id", "customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    return pairs.join(customers, "customer_id", "left_semi").repartition(buckets, "facility_id")


class BucketedStar:
    """Facts and dimensions of a built warehouse in buckets, written on first use: lending by facility, exchange by customer.

    ``buckets`` should make a bucket of the largest fact as large as a task reads well (about 128 MB).
    """

    def __init__(self, built: Warehouse, folder: str, buckets: int):
        self._built = built
        self._folder = folder
        self.buckets = buckets
        self._facts: dict[str, Bucketed] = {}

    @cached_property
    def facilities(self) -> DataFrame:
        return write_buckets(self._built.facility_lookup(), self._folder, "facilities", "facility_id", self.buckets)

    @cached_property
    def customers(self) -> DataFrame:
        return write_buckets(self._built.customer_keys(), self._folder, "customers", "customer_id", self.buckets)

    def fact(self, entity: str) -> Bucketed:
        """The staged rows of a fact in buckets, written on first use."""
        if entity not in self._facts:
            key = "facility_id" if "facility_id" in ENTITIES[entity].columns else "customer_id"
            self._facts[entity] = write_bucketed(self._built.staged(entity), self._folder, entity, key, self.buckets)
        return self._facts[entity]

    def _parents_of_heavy(self, fact: Bucketed, parents: DataFrame) -> DataFrame:
        return F.broadcast(parents.join(F.broadcast(fact.heavy), fact.key, "left_semi"))

    def _lending(self, entity: str, carry: tuple[str, ...] = ()) -> DataFrame:
        fact = self.fact(entity)
        in_place = with_parent(fact.rows, self.facilities, "facility_id", "has_facility", carry)
        known = known_pairs(fact.rows, self.customers, self.buckets).withColumn("has_customer", F.lit(True))
        light = in_place.join(known, ["facility_id", "customer_id"], "left").withColumn(
            "has_customer", F.coalesce("has_customer", F.lit(False)))
        heavy = marts.lending_parents(fact.rest, self._parents_of_heavy(fact, self.facilities), self.customers, carry)
        return light.unionByName(heavy)

    def fct_drawdowns(self) -> DataFrame:
        return marts.drawdown_columns(self._lending("drawdowns", ("approval_date",)))

    def fct_repayments(self) -> DataFrame:
        return marts.repayment_columns(self._lending("repayments"))

    def fct_fx_transactions(self) -> DataFrame:
        fact = self.fact("fx_transactions")
        light = marts.fct_fx_transactions(fact.rows, self.customers)
        return light.unionByName(marts.fct_fx_transactions(fact.rest, self._parents_of_heavy(fact, self.customers)))
