"""Language identification by Bayesian evidence fusion.

Four kinds of evidence speak about a row's language:

* the **text**, by naive Bayes over byte trigrams of its letters, trained on rows
  of declared language (a bounded sample: the ``SAMPLE`` rows of smallest id hash
  per language), tempered because neighbouring trigrams overlap;
* the **declared** language (a column, or the ``lang`` attribute of the page's root
  tag), by how often each declaration goes with each language;
* the **address suffix**, by its mix of languages;
* the **host**, whose prior is smoothed towards its suffix and that towards all rows.

The last three are estimated over all rows by grouped aggregation of the text's
own posteriors, so a host that holds a third of all rows is summed before the
shuffle and joined back by key. The log posteriors add up. ``und`` competes as a
language of its own, in which all trigrams are equally likely: junk goes there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomledger.llm.common import own_columns, require_columns, settle, ship_package, whole_text

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
SAMPLE = 1000
BUCKETS = 1 << 16
#: Weight of one trigram's evidence, and the most that the text can say in total.
TEMPER, TEXT_LIMIT = 0.25, 60.0
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 20.0, 50.0, 5.0
MIN_CONFIDENCE = 0.5
_MIX = np.uint32(2654435761)


def _letters() -> np.ndarray:
    """Bytes in lower case; all but letters and bytes of longer characters become spaces."""
    table = np.full(256, 32, dtype=np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


_TABLE = _letters()


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every byte trigram that is not within spaces."""
    raw = [b"  " + text.encode().lower() + b"  " for text in texts]
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    data = _TABLE[np.frombuffer(b"".join(raw), dtype=np.uint8)].astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)[:-2]
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    use = (data[1:-1] != 32) & (owner == np.repeat(np.arange(len(texts)), lengths)[2:])
    return ((code[use] * _MIX) >> np.uint32(16)).astype(np.int64), owner[use]


def train_profiles(rows: DataFrame, languages: Sequence[str] = LANGUAGES, sample: int = SAMPLE) -> np.ndarray:
    """log probability of each bucket by language, the last row for ``und``; rows: (id, text, declared)."""
    ship_package(rows.sparkSession)
    order = Window.partitionBy("declared").orderBy(F.xxhash64("id"), "id")
    labelled = rows.filter(F.col("declared").isin(*languages)).select("id", "declared", "part")
    chosen = (labelled.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample)
              .select("id", "declared", "part"))
    # At most ``sample`` keys per language are sent, so that no other row's text moves.
    texts = rows.select("id", "part", "text").join(F.broadcast(chosen), ["id", "part"]).select("declared", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                kinds = np.array([languages.index(x) for x in part.column("declared").to_pylist()])
                bucket, owner = trigrams(part.column("text").to_pylist())
                np.add.at(counts, (kinds[owner], bucket), 1)
        yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in counts], pa.binary()), pa.array(range(len(languages)))],
                                         ["counts", "language"])

    total = np.zeros((len(languages), BUCKETS))
    for counts, language in texts.repartition(8).mapInArrow(run, "counts binary, language long").toLocalIterator():
        total[language] += np.frombuffer(bytes(counts), dtype=np.int64)
    smooth = total + 0.5
    profiles = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    used = max(1, int((total.sum(axis=0) > 0).sum()))
    return np.vstack([profiles, np.full(BUCKETS, -np.log(used))])


def text_evidence(rows: DataFrame, profiles: np.ndarray, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """The rows without text, with trigrams and the tempered log likelihoods per language and ``und``."""
    ship_package(rows.sparkSession)
    model = rows.sparkSession.sparkContext.broadcast(profiles.astype(np.float32).T.copy())
    kept = [name for name in rows.columns if name != "text"]
    fields = [f"{name} {kind}" for name, kind in rows.dtypes if name != "text"]
    schema = ", ".join([*fields, "trigrams long", "evidence array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = part.column("text").to_pylist()
                bucket, owner = trigrams(texts)
                count = np.bincount(owner, minlength=len(texts))
                sums = np.zeros((len(texts), model.value.shape[1]))
                if len(owner):
                    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    sums[owner[first]] = np.add.reduceat(model.value[bucket], first, axis=0, dtype=np.float64)
                sums *= TEMPER
                top = sums.max(axis=1, keepdims=True)
                sums = np.maximum(sums - top, -TEXT_LIMIT)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), pa.array(count), pa.array(list(sums), pa.list_(pa.float64()))],
                    [*kept, "trigrams", "evidence"])

    return rows.mapInArrow(run, schema)


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda x: x / total)


def _sums(size: int) -> Column:
    return F.array(*[F.sum(F.col("posterior")[i]) for i in range(size)])


def _added(a: str | Column, b: str | Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def fuse(evidence: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Adds language, confidence and accepted to rows with evidence, declared, suffix and host."""
    size = len(languages) + 1
    start = evidence.withColumn("posterior", _posterior(F.col("evidence")))
    everything = start.agg(_sums(size).alias("sums")).first()["sums"] or [0.0] * size
    overall = (np.array([x or 0.0 for x in everything]) + 1.0)
    overall /= overall.sum()
    prior = F.array(*[F.lit(float(p)) for p in overall])

    def smoothed(sums: Column, weight: float, towards: Column) -> Column:
        total = F.aggregate(sums, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(sums, towards, lambda n, p: (n + weight * p) / (total + weight))

    suffixes = start.groupBy("suffix").agg(_sums(size).alias("sums"))
    suffixes = suffixes.select(F.col("suffix").alias("of_suffix"), smoothed(F.col("sums"), SUFFIX_WEIGHT, prior).alias("suffix_prior"))
    hosts = start.groupBy("host", "suffix").agg(_sums(size).alias("sums"))
    hosts = (hosts.join(suffixes, F.col("suffix").eqNullSafe(F.col("of_suffix")))
             .select(F.col("host").alias("of_host"), F.col("suffix").alias("host_suffix"),
                     smoothed(F.col("sums"), HOST_WEIGHT, F.col("suffix_prior")).alias("host_prior")))
    # P(declared | language), each declaration's sums against those of the language.
    all_sums = F.array(*[F.lit(float(x or 0.0)) for x in everything])
    declared = start.groupBy("declared").agg(_sums(size).alias("sums"))
    declared = declared.select(
        F.col("declared").alias("of_declared"),
        F.zip_with("sums", all_sums, lambda n, total: F.log((n + DECLARED_WEIGHT / size) / (total + DECLARED_WEIGHT))).alias("declared_log"))
    logs = _added(_added("evidence", "declared_log"), F.transform("host_prior", lambda p: F.log(p)))
    joined = (evidence
              .join(hosts, F.col("host").eqNullSafe(F.col("of_host")) & F.col("suffix").eqNullSafe(F.col("host_suffix")))
              .join(declared, F.col("declared").eqNullSafe(F.col("of_declared")))
              .withColumn("posterior", _posterior(logs)))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    names = F.array(*[F.lit(x) for x in [*languages, UNKNOWN]])
    return (joined.withColumn("language", F.when(F.col("trigrams") == 0, F.lit(UNKNOWN)).otherwise(F.element_at(names, best)))
            .withColumn("confidence", F.when(F.col("trigrams") == 0, F.lit(0.0)).otherwise(F.array_max("posterior")))
            .withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("confidence") >= MIN_CONFIDENCE))
            .drop("of_host", "host_suffix", "of_declared", "host_prior", "declared_log", "posterior", "evidence"))


def identify(rows: DataFrame) -> DataFrame:
    """One row per input row of (part, id, text, declared, suffix, host): without text, with the result.

    Added are trigrams, language, confidence and accepted. Null text counts as
    empty; rows without letters are ``und`` and not accepted. Null declarations,
    suffixes and hosts are values of their own. Ids may be null or repeat. An empty
    table gives an empty result.
    """
    require_columns(rows, ["part", "id", "text", "declared", "suffix", "host"])
    rows = rows.select("part", "id", whole_text("text").alias("text"), "declared", "suffix", "host")
    evidence = settle(text_evidence(rows, train_profiles(rows)), "evidence")
    return fuse(evidence)


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: the lang column as declaration, the source as host, no address."""
    return docs.select(F.lit("document").alias("part"), F.col("doc_id").cast("long").alias("id"), F.col("text"),
                       F.lower(F.trim("lang")).alias("declared"), F.lit(None).cast("string").alias("suffix"),
                       F.col("source").cast("string").alias("host"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as evidence rows: declared language of the root tag, host and its last label, text outside tags."""
    html = whole_text("html")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    declared = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]+)""", 1))
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(body, r"(?s)<[^>]*>", " ")
    return pages.select(F.lit("page").alias("part"), F.col("page_id").cast("long").alias("id"), text.alias("text"),
                        F.when(declared != "", declared).alias("declared"),
                        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), host.alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, all columns as they are.

    A row is kept if its id and text belong to an accepted row; rows that repeat
    both are treated alike.
    """
    require_columns(docs, ["doc_id", "text", "lang", "source"])
    docs = own_columns(docs, ["part", "_id", "_part"], ["doc_id", "text", "lang", "source"])
    keyed = document_rows(docs).withColumn("part", F.xxhash64(whole_text("text"), "declared", "host").cast("string"))
    accepted = identify(keyed).filter("accepted").select(F.col("id").alias("_id"), F.col("part").alias("_part")).distinct()
    hashed = F.xxhash64(whole_text("text"), F.lower(F.trim("lang")), F.col("source").cast("string")).cast("string")
    return docs.join(accepted, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (hashed == F.col("_part")), "left_semi")
