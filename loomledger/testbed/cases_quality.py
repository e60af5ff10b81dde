"""Registered queries: data-quality checks over the built warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.plans import quality as q
from loomledger.plans.entities import ENTITIES
from loomledger.plans.staging import cleansed, parsed
from loomledger.session import shared_folder
from loomledger.sources.envelope import write_raw_events
from loomledger.sources.tables import build
from loomledger.testbed import landing as ld
from loomledger.testbed.catalog import register
from loomledger.testbed.oracle import NOW

_RESULT = " ".join(q.RESULT_COLUMNS)

# Expected relation per model name.
_TABLES = {entity.table: f"s_{entity.name}" for entity in ENTITIES.values()} | {
    "int_arr_per_customer": "int_arr", "int_facility_utilization": "int_util", "int_fx_rates_normalized": "int_fx",
    "int_repayment_schedule": "int_schedule", "dim_customers": "dim_c", "dim_credit_facilities": "dim_f",
    "fct_drawdowns": "fct_d", "fct_repayments": "fct_r", "fct_fx_transactions": "fct_x",
}


def _literal(value: object) -> str:
    return str(value).upper() if isinstance(value, bool) else f"'{value}'"


def _failures(check: q.Check) -> str:
    table, column = _TABLES[check.model], check.column
    if check.test == "unique":
        return (f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1))")
    if check.test == "not_null":
        return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"
    if check.test == "accepted_values":
        return f"(SELECT count(*) FROM {table} WHERE {column} NOT IN ({', '.join(_literal(v) for v in check.values)}))"
    if check.test == "relationships":
        parent, key = check.parent
        return (f"(SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {_TABLES[parent]} p WHERE p.{key} = c.{column}))")
    return f"(SELECT count(*) FROM {table} WHERE NOT ({check.expression}))"


def _expected(checks: list[q.Check]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{k.model}' AS model, '{k.column}' AS \"column\", '{k.test}' AS test, '{k.severity}' AS severity, "
        f"{_failures(k)} AS failures" for k in checks)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS status "
            f"FROM ({rows})")


def _run(checks: list[q.Check]):
    return lambda s, d: q.run_checks(ld.checked_warehouse(s, d, checks).model, checks)


def _of(test: str) -> list[q.Check]:
    return [check for check in q.SUITE if check.test == test]


for _name, _checks in {
    "dq_unique": _of("unique"),
    "dq_not_null": _of("not_null"),
    "dq_accepted_values": _of("accepted_values"),
    "dq_relationships": _of("relationships"),
    "dq_expression": q.EXTRA_CHECKS[:1],
    "dq_arr_variance": q.EXTRA_CHECKS[1:],
}.items():
    register(_name, _run(_checks), _RESULT, _expected(_checks))

_ALL = [*q.SUITE, *q.EXTRA_CHECKS]
register("dq_suite", _run(_ALL), _RESULT, _expected(_ALL))
def _while_writing(s, d: str) -> DataFrame:
    checks = q.WriteChecks(_ALL)
    return checks.results(build(
        ld.warehouse(s, d), shared_folder(s, "checked"), watch=checks.watch, columns=q.columns_read(_ALL)))


register("dq_suite_while_writing", _while_writing, _RESULT, _expected(_ALL))
register("dq_run_summary", lambda s, d: q.run_summary(q.as_run_results(_run(_ALL)(s, d))),
         "models_ok models_failed tests_ok tests_failed skipped",
         "SELECT CAST(0 AS BIGINT) AS models_ok, CAST(0 AS BIGINT) AS models_failed, "
         "count(*) FILTER (status <> 'fail') AS tests_ok, count(*) FILTER (status = 'fail') AS tests_failed, "
         f"CAST(0 AS BIGINT) AS skipped FROM ({_expected(_ALL)})")
register("dq_run_messages", lambda s, d: q.run_messages(q.as_run_results(_run(_ALL)(s, d))), "message",
         "SELECT test || '_' || model || '_' || \"column\" || CASE WHEN status = 'warn' THEN ': warn' "
         f"ELSE ': ' || failures || ' failing rows' END AS message FROM ({_expected(_ALL)}) WHERE status <> 'pass' "
         "ORDER BY status = 'warn', test || '_' || model || '_' || \"column\"")


def _duplicates_before_dedup(s, d: str) -> DataFrame:
    entity = ENTITIES["repayments"]
    rows = cleansed(parsed(ld.raw_events(s, d, "repayments"), entity), entity)
    return q.duplicated_values(rows, entity.key).withColumnRenamed("count", "copies")


register("dq_duplicated_keys", _duplicates_before_dedup, "repayment_id copies",
         "SELECT 'R' || l_orderkey || '-' || l_linenumber AS repayment_id, count(*) AS copies FROM lineitem "
         "WHERE l_orderkey % 211 <> 9 GROUP BY 1 HAVING count(*) > 1")
register("dq_freshness", lambda s, d: q.freshness(s, ld.fully_landed(s, d), c.ntz(ld.NOW)),
         "source entity last_loaded_at age_seconds status",
         "SELECT source, entity, seen AS last_loaded_at, date_diff('second', seen, "
         f"{NOW}) AS age_seconds, CASE WHEN date_diff('second', seen, {NOW}) > 86400 THEN 'warn' ELSE 'pass' END AS status FROM ("
         + " UNION ALL ".join(
             f"SELECT '{entity.source}' AS source, '{entity.name}' AS entity, max(_ingested_at) AS seen FROM f_{entity.name}"
             for entity in ENTITIES.values()) + ")")
register("dq_landing_check",
         lambda s, d: q.landed_files(s, ld.fully_landed(s, d)).select("source", "entity", "status"),
         "source entity status",
         " UNION ALL ".join(f"SELECT '{entity.source}' AS source, '{entity.name}' AS entity, 'ok' AS status"
                            for entity in ENTITIES.values()))


_LANDED = ("invoices", "company_metrics")


def _landed_in_part(s, d: str) -> DataFrame:
    """All events of two entities; the other seven are missing."""
    folder = shared_folder(s, "landed-in-part")
    for name in _LANDED:
        write_raw_events(ld.packed_events(s, d, name, by_day=True), folder, ENTITIES[name])
    return q.landed_events(s, folder).select("source", "entity", "events", "status")


register("dq_landing_missing", _landed_in_part, "source entity events status",
         " UNION ALL ".join(
             f"SELECT '{entity.source}' AS source, '{entity.name}' AS entity, count(*) AS events, "
             f"CASE WHEN count(*) > 0 THEN 'ok' ELSE 'missing' END AS status FROM f_{entity.name}"
             + ("" if entity.name in _LANDED else " WHERE FALSE") for entity in ENTITIES.values()))


def _stopped(s, d: str) -> DataFrame:
    """The checks for which the run stops."""
    try:
        q.require(_run(_ALL)(s, d))
    except q.ChecksFailed as failed:
        return s.createDataFrame([(message,) for message in str(failed).split(", ")], "message string")
    return s.createDataFrame([], "message string")


register("dq_required", _stopped, "message",
         "SELECT model || '.' || \"column\" || ' ' || test || ' (' || failures || ')' AS message "
         f"FROM ({_expected(_ALL)}) WHERE status = 'fail'")
