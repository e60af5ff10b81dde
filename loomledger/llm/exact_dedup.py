"""Exact deduplication: a tree merge of sorted digest runs.

Every partition reduces its rows to a run of digests, one entry per digest.
Runs then meet in rounds: partitions get a place number of ``rounds`` digits
to the base ``fan``, and in round ``r`` digit ``r`` of an entry's place becomes
digit ``r`` of its digest's home. ``fan`` partners thus swap the parts of their
runs and merge what they receive, and after the last round each digest lives in
its home alone. Each level is one aggregation whose partial step merges
entries before they are exchanged, so a text that makes up a third of all rows
travels as one entry per run, and no place collects all runs.

An entry keeps the group's best row (most code points in the original text,
then smallest id) and its size. Entries are merged only where the SHA-256, the
byte length and an independent 64-bit hash of the normalised text all agree:
every level verifies the texts it merges by three values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomledger.llm.common import WHITE, require_columns, settle, whole_text

KEYS = ["digest", "n_bytes", "check"]


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One slim row per input row: id, code points and the verified digest of the text without white space."""
    require_columns(docs, [id_col, text_col])
    text = whole_text(text_col)
    plain = F.translate(text, WHITE, "")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(plain, 256)).alias("digest"),
        F.octet_length(plain).alias("n_bytes"),
        F.xxhash64(plain).alias("check"),
    )


def tree_merge(rows: DataFrame, fan: int = 16, rounds: int = 2) -> DataFrame:
    """One entry per digest, merged from per-partition runs in ``rounds`` exchanges of ``fan`` partners."""
    places = fan**rounds
    best = F.struct(F.col("chars"), F.bitwise_not("doc_id").alias("inverted_id"))
    runs = rows.select(
        *KEYS, best.alias("best"), F.lit(1).cast("long").alias("size"),
        F.pmod(F.spark_partition_id(), F.lit(places)).cast("long").alias("place"))
    home = F.pmod(F.col("check"), F.lit(places))
    for level in range(rounds):
        unit = fan**level
        digit = F.pmod(F.floor(F.col("place") / unit), F.lit(fan))
        wanted = F.pmod(F.floor(home / unit), F.lit(fan))
        runs = (runs.withColumn("place", F.col("place") + (wanted - digit) * unit)
                .groupBy("place", *KEYS)
                .agg(F.max("best").alias("best"), F.sum("size").alias("size")))
    return runs.drop("place")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty.
    The row with the most code points stays, then the smallest id. Rows that
    repeat an id with equal text and length are all marked as kept, because
    nothing tells them apart; rows without an id stay only if their whole
    group has none. An empty table gives an empty result, other columns are
    ignored.
    """
    rows = settle(digest_rows(docs, id_col, text_col), "digests")
    groups = tree_merge(rows)
    keep_id = F.bitwise_not(F.col("best.inverted_id"))
    return rows.join(groups, KEYS).select(
        "doc_id", keep_id.alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("chars") == F.col("best.chars"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
