"""Registered queries: staging kept up to date by merging new events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from loomledger.functions import columns as c
from loomledger.plans.entities import ENTITIES
from loomledger.plans.incremental import StagingState, incremental_warehouse
from loomledger.session import shared_folder
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register

#: The first run takes the days from here on; what lies before comes late.
SPLIT = date(2024, 1, 10)


def _state(s, entity: str) -> StagingState:
    return StagingState(s, shared_folder(s, f"state-{entity}"), ENTITIES[entity], n_buckets=16)


def merged_in_two_runs(s, d: str, entity: str) -> StagingState:
    """Newer days first, back-dated days after them."""
    state = _state(s, entity)
    state.merge(ld.raw_events(s, d, entity, since=SPLIT))
    state.merge(ld.raw_events(s, d, entity, until=date(SPLIT.year, SPLIT.month, SPLIT.day - 1)))
    return state


def _followed(s, d: str, entity: str) -> DataFrame:
    """All landed files in several runs of a stream, then once more with nothing new."""
    ld.raw_events(s, d, entity)
    state = _state(s, entity)
    state.follow(ld.landing_of(s, d), files_at_once=20)
    state.follow(ld.landing_of(s, d))
    return state.read()


def _columns(entity: str) -> str:
    return " ".join([*ENTITIES[entity].columns, "_ingested_at", "_schema_version"])


def _facts(s, d: str) -> DataFrame:
    states = {name: merged_in_two_runs(s, d, name) for name in ("drawdowns", "credit_facilities", "loan_applications")}
    return incremental_warehouse(s, states, now=c.ntz(ld.NOW)).fct_drawdowns()


for _name in ("drawdowns", "invoices"):
    register(f"incremental_stg_{_name}", lambda s, d, name=_name: merged_in_two_runs(s, d, name).read(), _columns(_name),
             f"SELECT * FROM s_{_name}")
register("incremental_followed_repayments", lambda s, d: _followed(s, d, "repayments"), _columns("repayments"),
         "SELECT * FROM s_repayments")
register("incremental_fct_drawdowns", _facts,
         "drawdown_id facility_id customer_id amount currency drawdown_date purpose status "
         "days_since_facility_approval is_orphaned", "SELECT * FROM fct_d")
