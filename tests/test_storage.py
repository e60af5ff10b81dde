"""Sources and sinks."""

import glob

import pytest
from pyspark.sql import functions as F

from loomledger.plans import quality
from loomledger.plans.entities import ENTITIES
from loomledger.plans.marts import MART_NAMES
from loomledger.sources import flat, tables
from loomledger.sources.envelope import read_raw_events, write_raw_events
from loomledger.testbed import landing as ld


def test_landing_layout_and_file_skipping(spark, sf_dir, tmp_path):
    for name in ("invoices", "company_metrics"):
        write_raw_events(ld.packed_events(spark, sf_dir, name), str(tmp_path), ENTITIES[name])
    files = glob.glob(f"{tmp_path}/raw_events/year=*/month=*/day=*/raw_events_payments_invoices_*.parquet")
    assert files
    read = read_raw_events(spark, str(tmp_path), ENTITIES["invoices"])
    assert read.count() == 1500
    assert all("payments_invoices" in path for path in read.inputFiles())


def test_missing_landing_entities_are_reported(spark, sf_dir, tmp_path):
    write_raw_events(ld.packed_events(spark, sf_dir, "company_metrics"), str(tmp_path), ENTITIES["company_metrics"])
    status = {row.entity: row.status for row in quality.landed_files(spark, str(tmp_path)).collect()}
    assert status.pop("company_metrics") == "ok"
    assert set(status.values()) == {"missing"} and len(status) == 8


def test_exports_match_their_declared_schemas(spark, sf_dir, tmp_path):
    built = ld.built_warehouse(spark, sf_dir)
    counts = tables.export_marts(built, str(tmp_path))
    for mart in MART_NAMES:
        written = spark.read.parquet(f"{tmp_path}/{mart}")
        tables.check_schema(mart, written.schema)
        assert written.count() == counts[mart] > 0


def test_schema_drift_stops_an_export(spark, sf_dir, tmp_path):
    wrong = ld.built_warehouse(spark, sf_dir).fct_drawdowns().withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        tables.export_mart(wrong, "fct_drawdowns", str(tmp_path))


def test_external_table(spark, sf_dir, tmp_path):
    tables.export_mart(ld.built_warehouse(spark, sf_dir).fct_drawdowns(), "fct_drawdowns", str(tmp_path))
    table = tables.register_external(spark, "fct_drawdowns", f"{tmp_path}/fct_drawdowns", "external_drawdowns")
    assert table.count() == spark.read.parquet(f"{tmp_path}/fct_drawdowns").count()
    spark.sql("DROP TABLE external_drawdowns")


def test_flat_tables_with_mixed_types(spark, tmp_path):
    entity = ENTITIES["company_metrics"]
    days = "timestamp_ntz'2026-01-0{} 00:00:00'"
    flat.write_flat(spark.sql(f"SELECT 'a' AS metric_id, 1.5D AS valuation, {days.format(1)} AS _ingested_at"), str(tmp_path), entity)
    flat.write_flat(spark.sql(f"SELECT 'b' AS metricId, '2.5' AS valuation, {days.format(2)} AS _ingested_at"), str(tmp_path), entity)
    flat.write_flat(spark.sql(f"SELECT 'c' AS metric_id, 300L AS valuation, true AS new, {days.format(3)} AS _ingested_at"), str(tmp_path), entity)
    rows = flat.read_flat(spark, str(tmp_path), entity).select("metric_id", "metricId", "valuation", "new").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("a", None, "1.5", None), (None, "b", "2.5", None), ("c", None, "300", "true")], key=str)


def test_batches_of_one_day_may_differ_in_names_and_types(spark, tmp_path):
    entity, day = ENTITIES["company_metrics"], "timestamp_ntz'2026-01-01 00:00:00' AS _ingested_at"
    flat.write_flat(spark.sql(f"SELECT 'a' AS metric_id, 1.5D AS valuation, {day}"), str(tmp_path), entity)
    flat.write_flat(spark.sql(f"SELECT 'b' AS metricId, '2.5' AS valuation, {day}"), str(tmp_path), entity, replace=False)
    # A file that another program wrote, without the schema in its name.
    spark.sql("SELECT 'c' AS metric_id, 300L AS valuation").coalesce(1).write.mode("append").parquet(
        f"{flat.flat_path(str(tmp_path), entity)}/year=2026/month=1/day=2")
    rows = flat.read_flat(spark, str(tmp_path), entity).select("metric_id", "metricId", "valuation").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("a", None, "1.5"), (None, "b", "2.5"), ("c", None, "300")], key=str)
    assert len(flat.file_groups(spark, flat.flat_path(str(tmp_path), entity))) == 3


def test_reruns_change_nothing(spark, sf_dir, tmp_path):
    entity = ENTITIES["company_metrics"]
    events = ld.packed_events(spark, sf_dir, entity.name)
    rows = ld.BUILDERS[entity.name](ld.Tables(spark, sf_dir))
    for _ in range(2):
        flat.write_flat(rows, str(tmp_path / "flat"), entity)
        write_raw_events(events, str(tmp_path / "raw"), entity)
    assert flat.read_flat(spark, str(tmp_path / "flat"), entity).count() == rows.count()
    assert read_raw_events(spark, str(tmp_path / "raw"), entity).count() == events.count()
    late = events.limit(3).withColumn("_batch_id", F.lit("late"))
    write_raw_events(late, str(tmp_path / "raw"), entity)
    assert read_raw_events(spark, str(tmp_path / "raw"), entity).count() == events.count() + 3


def test_day_export_replaces_only_its_days(spark, tmp_path):
    def rows(n, day):
        return spark.sql(f"SELECT {n} AS n, timestamp_ntz'2026-01-0{day} 10:00:00' AS at")

    tables.export_by_day(rows(1, 1).union(rows(2, 2)), str(tmp_path / "t"), "at")
    tables.export_by_day(rows(3, 2), str(tmp_path / "t"), "at")
    assert sorted(row.n for row in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]
