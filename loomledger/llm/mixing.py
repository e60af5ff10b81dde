"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every source gets a target number of words: its weight's share of the whole
   mix, at most ``max_repeat`` times its size, the excess shared again.
2. A source's documents are hashed into blocks and the blocks put in a hashed
   order. Whole passes over the source and a last partial pass give its exact
   quota of block draws; the block, the sub-block and finally the document in
   which the target falls are found by running sums of ever finer groups, so
   that no task orders a whole source.
3. The splitting tree halves the output shards again and again. At each node
   the draws of all sources are divided by one multivariate hypergeometric
   draw, seeded by the node, until every shard has an exact quota per source.
4. A source's draws, in a second hashed order, are dealt to the shards as
   disjoint slices of those quotas. ``mixed_rows`` brings each shard's rows
   together and sorts them by ``shuffle_key``, a hash; a shard of more than
   ``PIECE_WORDS`` words is split by ranges of that hash, one task per range.

The driver sees one row per source (at most ``max_sources``, else an error);
blocks and documents stay in Spark. Block tables are broadcast only while
sources times blocks is below ``BROADCAST_ROWS``, else they join by shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomledger.llm.common import WORD, own_columns, require_columns, settle, whole_text, word_count

#: Names the operator uses itself; an extra input column of such a name is left out.
OWN = ("mix_size mix_source_size mix_target mix_taken mix_draws copy shard shuffle_key _source _order _block _sub _draw "
       "_draws _passes _left _place _block_words _sub_left _sub_words _doc_left _last_words").split()
BLOCKS = 256
SUB_BLOCKS = 1024
BROADCAST_ROWS = 200_000
MAX_SOURCES = 100_000
#: Words of a shard that one task sorts; larger shards are split.
PIECE_WORDS = 4_000_000


@dataclass(frozen=True)
class Recipe:
    """``share`` of all words is mixed, sources in code-point order take ``weights`` in turn."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    max_repeat: int = 2
    shards: int = 64
    seed: int = 11
    max_sources: int = MAX_SOURCES


def fill_targets(sizes: Sequence[int], recipe: Recipe) -> list[float]:
    """Target words per source; those above their cap stop there and the rest is shared again by weight."""
    weights = [float(recipe.weights[i % len(recipe.weights)]) for i in range(len(sizes))]
    caps = [float(recipe.max_repeat * size) for size in sizes]
    targets = [0.0] * len(sizes)
    left, open_ = recipe.share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > caps[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = caps[i]
        left -= sum(caps[i] for i in over)
        closed = set(over)
        open_ = [i for i in open_ if i not in closed]
    return targets


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Draws per (shard, source): the leaves of the splitting tree, each shard holding an equal share."""
    leaves = np.zeros((shards, len(quotas)), dtype=np.int64)

    def descend(first: int, last: int, colours: np.ndarray) -> None:
        if last - first == 1:
            leaves[first] = colours
            return
        middle = (first + last) // 2
        total = int(colours.sum())
        take = total * (middle - first) // (last - first)
        rng = np.random.default_rng([seed, first, last])
        left = rng.multivariate_hypergeometric(colours, take, method="marginals") if total else colours
        descend(first, middle, left)
        descend(middle, last, colours - left)

    descend(0, shards, np.asarray(quotas, dtype=np.int64))
    return leaves


def _digit(seed: int, salt: str, count: int, *columns: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(crc32(f"{seed}/{salt}".encode())), *columns), F.lit(count)).cast("int")


def _running(df: DataFrame, keys: list[str], order: list[Column]) -> Column:
    """Words of earlier rows of the same keys."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("words").over(window), F.lit(0))


def allocate(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """All input columns plus mix_size, mix_source_size, mix_target, mix_taken and mix_draws.

    ``mix_taken`` counts words with repeats; ``mix_draws`` lists (copy, shard,
    words) per copy that the mix takes, the last one possibly shorter than the
    document. Null text has size 0, a null source is a source of its own and
    comes last. Rows that agree in id, source and text are treated alike. An
    empty table gives an empty result.
    """
    return _allocated(docs, recipe, id_col, text_col, source_col)[0]


def _allocated(docs: DataFrame, recipe: Recipe, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, int]:
    """The rows of ``allocate``, and the words of the whole mix."""
    require_columns(docs, [id_col, text_col, source_col])
    docs = own_columns(docs, OWN, [id_col, text_col, source_col])
    spark = docs.sparkSession
    text = whole_text(text_col)
    name = F.col(source_col).cast("string")
    order_hash = F.xxhash64(F.lit(recipe.seed), F.col(id_col), text)
    sized = (docs.withColumn("mix_size", word_count(text))
             .withColumn("_source", F.when(name.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), name)))
             .withColumn("_order", order_hash)
             .withColumn("_block", _digit(recipe.seed, "block", BLOCKS, F.col("_source"), F.col("_order")))
             .withColumn("_sub", _digit(recipe.seed, "sub", SUB_BLOCKS, F.col("_source"), F.col("_order"))))
    slim = sized.select("_source", "_block", "_sub", "_order", F.col("mix_size").alias("words"))

    # Blocks in hashed order with the words before each.
    block_order = [F.xxhash64(F.lit(recipe.seed), F.col("_source"), F.col("_block")), F.col("_block")]
    blocks = slim.groupBy("_source", "_block").agg(F.sum("words").alias("words"))
    blocks = blocks.withColumn("before", _running(blocks, ["_source"], block_order))
    blocks = settle(blocks, "mix-blocks")
    totals = sorted(blocks.groupBy("_source").agg(F.sum("words"), F.count(F.lit(1))).limit(recipe.max_sources + 1).collect())
    if len(totals) > recipe.max_sources:
        raise ValueError(f"more than {recipe.max_sources} sources; raise max_sources if the driver can hold them")
    targets = fill_targets([row[1] for row in totals], recipe)
    plan = []
    for (source, size, count), target in zip(totals, targets, strict=True):
        goal = int(target + 0.5)
        passes = goal // size if size else 0
        plan.append((source, size, target, passes, goal - passes * size, count))
    sources = spark.createDataFrame(plan or [], T.StructType([
        T.StructField("_source", T.StringType()), T.StructField("mix_source_size", T.LongType()),
        T.StructField("mix_target", T.DoubleType()), T.StructField("_passes", T.LongType()),
        T.StructField("_rest", T.LongType()), T.StructField("_blocks", T.LongType())]))
    bounded = F.broadcast if len(plan) * max(BLOCKS, SUB_BLOCKS) <= BROADCAST_ROWS else (lambda df: df)

    # The last pass: how many words it takes from each block, sub-block, document.
    placed = blocks.join(F.broadcast(sources), "_source").withColumn("_left", F.col("_rest") - F.col("before"))
    cut_block = placed.filter((F.col("_left") > 0) & (F.col("_left") < F.col("words"))).select("_source", "_block", "_left")
    fine = (slim.join(bounded(cut_block), ["_source", "_block"])
            .groupBy("_source", "_block", "_sub", "_left").agg(F.sum("words").alias("words")))
    fine = (fine.withColumn("before", _running(fine, ["_source"], [F.col("_sub")]))
            .withColumn("_sub_left", F.col("_left") - F.col("before"))
            .select("_source", "_block", "_sub", "_sub_left", F.col("words").alias("_sub_words")))
    cut_sub = fine.filter((F.col("_sub_left") > 0) & (F.col("_sub_left") < F.col("_sub_words"))).drop("_sub_words")
    single = slim.join(bounded(cut_sub), ["_source", "_block", "_sub"])
    single = (single.withColumn("before", _running(single, ["_source"], [F.col("_order")]))
              .groupBy("_source", "_block", "_sub", "_order")
              .agg(F.min(F.col("_sub_left") - F.col("before")).alias("_doc_left")))

    # Draws per source: whole passes, and the blocks of the last pass.
    drawn = placed.withColumn("_last", (F.col("_left") > 0).cast("long"))
    quotas = {row[0]: row[1] for row in drawn.groupBy("_source").agg(
        F.sum(F.col("_passes") + F.col("_last"))).collect()}
    leaves = split_quotas([quotas[row[0]] for row in plan], recipe.shards, recipe.seed)
    ends = spark.createDataFrame(
        [(row[0], [int(x) for x in np.cumsum(leaves[:, i])]) for i, row in enumerate(plan)],
        "_source string, _ends array<long>")
    # A block without a draw goes first: from 0 to -1 a sequence counts down.
    copies = (drawn.filter(F.col("_passes") + F.col("_last") > 0)
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_passes") + F.col("_last") - 1))))
    draw_order = Window.partitionBy("_source").orderBy(
        F.xxhash64(F.lit(recipe.seed + 1), F.col("_source"), F.col("_block"), F.col("copy")), "_block", "copy")
    dealt = (copies.withColumn("_position", F.row_number().over(draw_order) - 1)
             .join(F.broadcast(ends), "_source")
             .withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_position"))))
             .groupBy("_source", "_block")
             .agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("_draws")))
    per_block = (placed.join(dealt, ["_source", "_block"], "left")
                 .select("_source", "_block", "mix_source_size", "mix_target", "_passes", "_left",
                         F.col("words").alias("_block_words"), "_draws"))

    joined = (sized.join(bounded(per_block), ["_source", "_block"])
              .join(bounded(fine), ["_source", "_block", "_sub"], "left")
              .join(bounded(single), ["_source", "_block", "_sub", "_order"], "left"))
    last = (F.when(F.col("_left") >= F.col("_block_words"), F.col("mix_size"))
            .when(F.col("_left") <= 0, F.lit(0))
            .when(F.col("_sub_left") >= F.col("_sub_words"), F.col("mix_size"))
            .when(F.col("_sub_left") <= 0, F.lit(0))
            .otherwise(F.greatest(F.lit(0), F.least(F.col("mix_size"), F.col("_doc_left"))))).cast("long")
    words = lambda draw: F.when(draw["copy"] < F.col("_passes"), F.col("mix_size")).otherwise(F.col("_last_words"))
    mix = (joined.withColumn("_last_words", last)
           .withColumn("mix_draws", F.transform(
               F.coalesce("_draws", F.array().cast("array<struct<copy:bigint,shard:int>>")),
               lambda draw: F.struct(draw["copy"].alias("copy"), draw["shard"].alias("shard"), words(draw).alias("words"))))
           .withColumn("mix_taken", F.aggregate("mix_draws", F.lit(0).cast("long"), lambda total, draw: total + draw["words"]))
           .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_draws"))
    return mix, sum(passes * size + rest for _, size, _, passes, rest, _ in plan)


def mixed_rows(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """One row per copy that the mix takes: the input columns, copy, shard and shuffle_key.

    A partition holds rows of one shard (of one range of ``shuffle_key``, if the
    shard is large), sorted by ``shuffle_key``; partitions follow the order of shards.
    The one document per source in which the target falls is cut after the
    words taken. Documents without words carry nothing to a mix counted in
    words; they pass once per draw of their block.
    """
    docs = own_columns(docs, OWN, [id_col, text_col, source_col])
    taken, total = _allocated(docs, recipe, id_col, text_col, source_col)
    one = taken.withColumn("_draw", F.explode("mix_draws"))
    whole = F.col("_draw.words") == F.col("mix_size")
    head = F.concat_ws(" ", F.slice(F.regexp_extract_all(whole_text(text_col), F.lit(WORD), F.lit(0)),
                                    F.lit(1), F.col("_draw.words").cast("int")))
    key = F.xxhash64(F.lit(recipe.seed + 2), F.col(id_col), whole_text(text_col), F.col("_draw.copy"))
    rows = (one.filter(whole | (F.col("_draw.words") > 0))
            .withColumn("shuffle_key", key)
            .withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(head))
            .select(*docs.columns, F.col("_draw.copy").alias("copy"), F.col("_draw.shard").alias("shard"), "shuffle_key"))
    pieces = max(1, -(-total // (recipe.shards * PIECE_WORDS)))
    piece = F.least(F.lit(pieces - 1), F.floor((F.col("shuffle_key") / 2.0 ** 64 + 0.5) * pieces).cast("int"))
    return (rows.withColumn("_place", F.col("shard") * pieces + piece)
            .repartitionById(recipe.shards * pieces, "_place").sortWithinPartitions("shuffle_key").drop("_place"))
