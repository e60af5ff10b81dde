"""Small tables with the awkward rows that every operator must take."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in that was it for with one two three four five".split()


def awkward_rows(seed=1, count=60):
    """Nulls in any column, empty and blank texts, one very long text, ties, repeated rows, copies."""
    rnd = random.Random(seed)
    prose = lambda n: " ".join(rnd.choice(WORDS) + rnd.choice(["", ",", ".", "x", "q7"]) for _ in range(n))
    rows = [(i, "\n".join(prose(rnd.randint(1, 25)) for _ in range(rnd.randint(1, 6))), rnd.choice(["en", "de"]), f"s{i % 3}", i)
            for i in range(count)]
    rows += [(100 + i, rows[i % 5][1], "en", "s0", 1) for i in range(10)]
    rows += [(120 + i, rows[3][1].replace(" ", "  ", i), "en", "s1", 1) for i in range(4)]
    rows += [(200, None, "en", "s0", None), (201, "", None, None, 0), (202, " \t\n ", "en", None, 4), (203, "\n\n", "xx", "", 2),
             (204, prose(20_000), "en", "s1", 1), (205, "Ünïcode ß Σ 中文 😀 <|endoftext|> don't 'll  ", "fr", "s2", 1),
             (206, "x" * 5000, "en", "s2", 1), (None, "no id at all", "en", "s1", 1), (None, None, None, None, None)]
    rows += [rows[7], rows[7], (207, "word", "en", "s0", 1), (208, "word", "en", "s0", 1)]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOC_SCHEMA)


def clashing(df, names):
    """Extra columns of the given names."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("extra").alias(name) for name in names if name not in df.columns])


def collected(df):
    return [tuple(row) for row in df.collect()]
