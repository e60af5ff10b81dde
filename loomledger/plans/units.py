"""Whether the amounts of a batch are in minor units, from where they lie among the other batches' amounts.

The unit of decision is a batch of at least ``MIN_ROWS`` events; smaller batches of one
ingestion day are decided together. Per unit and column a mergeable quantile sketch
holds the logarithms of the amounts. A unit is in minor units when its amounts are all
whole numbers and their median lies about a hundred times above what is usual for
the column, the median of all units' medians. Whole amounts of the usual size stay as
they are, and so do units that fit neither or are too small: those are undecided.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomledger.functions import columns as c
from loomledger.functions import strict as st
from loomledger.plans.entities import Entity
from loomledger.session import shared_folder

MIN_ROWS = 8
#: How far, in natural logarithms, a median may lie from the usual one or from a hundred times it.
NEAR = 1.5
UNIT = ["_day", "_unit"]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` from a table in the shared folder, so that what follows reads it instead of parsing again."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_unit(text_rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows with their day and unit: a large batch by its id, small batches of a day as the empty text.

    The large batches, few beside the rows, are written first: their true size then decides how they are
    joined, and rows are shuffled by batch only where even the list of batches is large.
    """
    large = text_rows.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= min_rows).select(
        "_batch_id", F.lit(True).alias("_large"))
    large = written(large, "large-batches")
    unit = F.when(F.col("_large"), F.concat(F.lit("batch "), "_batch_id")).otherwise(F.lit(""))
    return (text_rows.join(large, "_batch_id", "left")
            .withColumns({"_day": F.to_date("_ingested_at"), "_unit": unit}).drop("_large"))


def unit_sketches(rows: DataFrame, entity: Entity) -> DataFrame:
    """Per unit its rows and, per amount column, a sketch of the logarithms and whether all are whole."""
    parts: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for name in entity.amounts:
        number = c.to_number(F.col(name))
        parts += [F.kll_sketch_agg_double(F.when(number != 0, F.ln(F.abs(number)))).alias(f"_sketch_{name}"),
                  F.bool_and(st.is_whole_text(F.col(name))).alias(f"_whole_{name}")]
    return rows.groupBy(*UNIT).agg(*parts)


def unit_decisions(text_rows: DataFrame, entity: Entity, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per unit and amount column: rows, factor (median over the usual one), all_whole, decision."""
    return _decided(with_unit(text_rows, min_rows), entity, min_rows)


def _decided(rows: DataFrame, entity: Entity, min_rows: int) -> DataFrame:
    sketches = written(unit_sketches(rows, entity), "units")
    found = None
    for name in entity.amounts:
        sketch = F.col(f"_sketch_{name}")
        filled = F.when(F.kll_sketch_get_n_double(sketch) > 0, sketch)
        medians = sketches.select(*UNIT, "_rows", F.kll_sketch_get_quantile_double(filled, F.lit(0.5)).alias("median"),
                                  F.coalesce(f"_whole_{name}", F.lit(False)).alias("all_whole"))
        usual = medians.filter(F.col("_rows") >= min_rows).agg(F.percentile_approx("median", 0.5, 1000).alias("usual")).scalar()
        shift = F.col("median") - usual
        decision = (
            F.when(F.col("_rows") < min_rows, "undecided")
            .when(F.col("all_whole") & (F.abs(shift - math.log(100)) <= NEAR), "minor")
            .when(F.abs(shift) <= NEAR, "major").otherwise("undecided"))
        part = medians.select(*UNIT, F.lit(name).alias("column"), F.col("_rows").alias("rows"), F.exp(shift).alias("factor"),
                              "all_whole", decision.alias("decision"))
        found = part if found is None else found.union(part)
    return found


def to_major_units(text_rows: DataFrame, entity: Entity, min_rows: int = MIN_ROWS) -> DataFrame:
    """Amounts of minor-unit batches divided by 100; ``_undecided`` lists the columns whose unit is not known."""
    if not entity.amounts:
        return text_rows.withColumn("_undecided", F.array().cast("array<string>"))
    rows = with_unit(text_rows, min_rows)
    per_unit = _decided(rows, entity, min_rows).groupBy(*UNIT).agg(
        F.collect_list(F.when(F.col("decision") == "minor", F.col("column"))).alias("_minor"),
        F.collect_list(F.when(F.col("decision") == "undecided", F.col("column"))).alias("_undecided"))
    # Written for its true size, as the large batches are.
    joined = rows.join(written(per_unit, "unit-decisions"), UNIT, "left")
    scaled = {name: F.when(F.array_contains("_minor", name), (c.to_number(F.col(name)) / 100.0).cast("string"))
              .otherwise(F.col(name)) for name in entity.amounts}
    return joined.withColumns(scaled).drop(*UNIT, "_minor")
