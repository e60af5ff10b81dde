"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.session import shared_folder

#: The white space that the operators cut words at: space, tab, newline, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with files that every executor reaches, so a lost executor
    costs only its running tasks.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """The number of runs of other characters than ``WHITE``."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def own_columns(df: DataFrame, own: list[str], needed: list[str]) -> DataFrame:
    """``df`` without the extra columns that bear one of the operator's own names."""
    taken = {name.lower() for name in own} - {name.lower() for name in needed}
    return df.drop(*[name for name in df.columns if name.lower() in taken])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    The workers may not find it by themselves; Spark sends them an archive.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="loomledger-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
