"""The registered queries of the training-data operators, and expected results where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomledger.llm.ann import nearest
from loomledger.llm.common import table
from loomledger.llm.exact_dedup import exact_duplicates
from loomledger.llm.fingerprints import edit_likeness
from loomledger.llm.langid import document_rows, identify, page_rows
from loomledger.llm.line_dedup import delete_repeated_lines
from loomledger.llm.merkle import merkle_manifest
from loomledger.llm.mixing import allocate
from loomledger.llm.packing import pack_documents
from loomledger.llm.prefix_tries import family_trie
from loomledger.llm.quality import quality
from loomledger.llm.simhash import simhash_components
from loomledger.llm.suffix_tree import score_documents
from loomledger.llm.token_counts import token_counts


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op2_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return delete_repeated_lines(docs).select("doc_id", "n_lines", "deleted_lines", "text")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return allocate(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_components(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_rows(table(spark, sf_dir, "documents")).union(page_rows(table(spark, sf_dir, "pages")))
    found = identify(rows)
    of = lambda part: F.when(F.col("part") == part, F.col("id"))
    return found.select(of("document").alias("doc_id"), of("page").alias("page_id"), "declared", "suffix", "host", "trigrams",
                        "language", "confidence", F.col("accepted").alias("kept"))


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family_trie(table(spark, sf_dir, "conversations"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(odd_out, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_manifest(table(spark, sf_dir, "documents"), found).drop("proof")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_one_bit_codes": op2_one_bit_codes,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_language_id": op9_language_id,
    "op10_suffix_tree": op10_suffix_tree,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_winnowing": op12_winnowing,
    "op13_merkle_manifest": op13_merkle_manifest,
}



def crc32_sql(digits: str) -> str:
    """The unsigned CRC-32 of an ASCII text, as SQL."""
    octet = f"list_transform(range(1, length({digits}) + 1), lambda i: ascii(substring({digits}, i::INTEGER, 1))::UBIGINT)"
    eight = "list_reduce(list_prepend(xor(state, octet), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), " \
            "lambda s, z: xor(s >> 1, 3988292384::UBIGINT * (s & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {octet}), lambda state, octet: {eight}), 4294967295::UBIGINT)"


#: Levels that the SQL of op13 can climb: enough for 3**16 leaves of a source, and as many sources.
_LEVELS = 16


def _tree_sql(leaves: str, up: str) -> tuple[str, str, str]:
    """Tables of a tree's levels over ``leaves`` (tree, place, n, digest): (tables, level prefix, last level)."""
    tables = [f"{up}0 AS (SELECT tree, place, n, digest FROM {leaves})"]
    for k in range(_LEVELS):
        tables.append(
            f"{up}{k + 1} AS (SELECT tree, place // 3 AS place, CASE WHEN max(n) > 1 THEN (max(n) + 2) // 3 ELSE 1 END AS n, "
            f"CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE max(digest) END AS digest "
            f"FROM {up}{k} GROUP BY tree, place // 3)")
    return ", ".join(tables), up, f"{up}{_LEVELS}"


def _climb_sql(up: str, start: str, name: str) -> str:
    """Tables that carry (id, tree, place, proof, folded) of ``start`` to the top of its tree."""
    tables = [f"{name}0 AS (SELECT * FROM {start})"]
    for k in range(_LEVELS):
        tables.append(
            f"{name}{k + 1} AS (SELECT c.id, c.tree, c.place // 3 AS place, "
            f"CASE WHEN any_value(s.n) > 1 THEN any_value(c.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.place) "
            f"FILTER (s.place <> c.place), '') ELSE any_value(c.proof) END AS proof, "
            f"CASE WHEN any_value(s.n) > 1 THEN sha256(string_agg(CASE WHEN s.place = c.place THEN c.folded ELSE s.digest END, '' "
            f"ORDER BY s.place)) ELSE any_value(c.folded) END AS folded "
            f"FROM {name}{k} c JOIN {up}{k} s ON s.tree = c.tree AND s.place // 3 = c.place // 3 GROUP BY c.id, c.tree, c.place)")
    return ", ".join(tables)


def _merkle_sql() -> str:
    def digest(text: str) -> str:
        parts = " || ".join(
            f"coalesce(strlen({v}) || ':' || {v}, '-')"
            for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text))
        return f"sha256({parts})"

    lower, _, roots = _tree_sql("leaves", "a")
    upper, _, root = _tree_sql("sources", "b")
    tampered = f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    return f"""
        WITH hashed AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce('1' || source, '0') AS tree, {digest('text')} AS digest,
                   {digest(tampered)} AS folded FROM documents),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
                   count(*) OVER (PARTITION BY tree) AS n FROM hashed),
        {lower},
        sources AS (
            SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n, digest,
                   tree AS name FROM {roots}),
        {upper},
        {_climb_sql('a', "(SELECT id, tree, place, '' AS proof, folded FROM leaves)", 'c')},
        joined AS (
            SELECT c.id, '' AS tree, s.place, c.proof, c.folded FROM c{_LEVELS} c JOIN sources s ON s.name = c.tree),
        {_climb_sql('b', 'joined', 'd')}
        SELECT l.doc_id, l.digest AS leaf, a.digest AS subroot, b.digest AS root, sha256(d.proof) AS proof_sha256,
               d.folded AS folded_root, d.folded = b.digest AS verified
        FROM leaves l JOIN {roots} a USING (tree) CROSS JOIN {root} b JOIN d{_LEVELS} d USING (id)
    """


def _trie_sql() -> str:
    key = "sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
        WITH turns AS (
            SELECT conv_id, {key} AS key, length(coalesce(text, '')) AS chars,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {key}) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS lender, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)),
        rebuilt AS (
            SELECT c.conv_id, t.place, t.key, t.chars FROM convs c JOIN turns t ON t.conv_id = c.lender AND t.place < c.h
            UNION ALL
            SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(l.n, 0)), t.key, t.chars
            FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
            LEFT JOIN (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1) l ON l.conv_id = c.lender),
        members AS (
            SELECT conv_id, 0 AS depth, '' AS path, NULL AS parent, 0 AS chars FROM convs
            UNION ALL
            SELECT conv_id, place + 1, string_agg(key, '') OVER through,
                   coalesce(string_agg(key, '') OVER (through ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), chars
            FROM rebuilt WINDOW through AS (PARTITION BY conv_id ORDER BY place)),
        nodes AS (
            SELECT path, depth, parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs
            FROM members GROUP BY path, depth, parent),
        lengths AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY 1),
        ends AS (
            SELECT m.path, string_agg(m.conv_id, ',' ORDER BY m.conv_id) AS ids
            FROM members m JOIN lengths USING (conv_id, depth) GROUP BY 1),
        children AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        sums AS (
            SELECT above.path, count(*) FILTER (children.path IS NULL) AS n_leaves,
                   sum((below.n_convs - 1) * below.chars) AS saved_tokens
            FROM nodes below LEFT JOIN children USING (path)
            JOIN members above ON above.conv_id = below.conv_id AND above.depth <= below.depth GROUP BY 1)
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
               coalesce(c.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
               sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM nodes n LEFT JOIN nodes p ON p.path = n.parent LEFT JOIN children c ON c.path = n.path
        JOIN sums s ON s.path = n.path LEFT JOIN ends e ON e.path = n.path
    """


ORACLE_SQL: dict[str, str] = {
    "op11_prefix_trie": _trie_sql(),
    "op13_merkle_manifest": _merkle_sql(),
    "op4_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        ranked AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM plain)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
}
