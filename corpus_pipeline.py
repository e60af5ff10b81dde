"""A training corpus from raw documents in five stages, each one of the training-data operators.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept
and returns a DataFrame; all but the last return the columns of documents.
``run`` writes each stage's rows as Parquet to the shared folder and reads them
back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.llm.common import settle, table
from loomledger.llm.langid import keep_identified
from loomledger.llm.line_dedup import delete_repeated_lines
from loomledger.llm.mixing import mixed_rows
from loomledger.llm.packing import pack_documents
from loomledger.llm.simhash import keep_one_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified stay."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; documents that consisted of nothing else go with them."""
    cleaned = delete_repeated_lines(docs)
    emptied = (F.col("deleted_lines") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _sized(cleaned.filter(~emptied)).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id, or one without an id where none has one."""
    return keep_one_each(docs, without_id=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target words: one row per copy that the mix takes, shard after shard, shuffled within."""
    return _sized(mixed_rows(docs)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack_documents(docs)


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have cut."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources", source_mixing),
    ("packing", packing),
]

#: Several stages cannot be stated in SQL. Tests hold line dedup of short lines, SimHash and packing against brute force
#: as operators; of the stages in a row they check counts and columns.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
