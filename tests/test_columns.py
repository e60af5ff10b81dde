"""Column functions against the expected engine's own casts."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomledger.functions import columns as c

HYPOTHESIS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def ask(sql, values, kind):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (i INTEGER, x {kind})")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [row[0] for row in con.execute(f"SELECT {sql} FROM t ORDER BY i").fetchall()]


def tell(spark, column, values, kind):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").repartition(2)
    return [row[0] for row in df.orderBy("i").select(column(F.col("x"))).collect()]


@HYPOTHESIS
@given(st.lists(st.floats(min_value=-1e12, max_value=1e12), min_size=50, max_size=200))
def test_money_rounds_like_the_expected_cast(spark, values):
    assert tell(spark, c.to_money, values, "double") == ask("TRY_CAST(x AS DECIMAL(18,2))", values, "DOUBLE")


def test_money_edges(spark):
    values = [1.005, 2.675, 0.125, -0.125, 0.375, 1e16, -1e17, 9999999999999999.0, float("nan"), float("inf"), None, 0.0]
    assert tell(spark, c.to_money, values, "double") == ask("TRY_CAST(x AS DECIMAL(18,2))", values, "DOUBLE")


@HYPOTHESIS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6).map(lambda x: round(x * 2) / 2), min_size=20, max_size=100))
def test_whole_numbers_round_half_to_even(spark, values):
    assert tell(spark, c.to_whole, values, "double") == ask("TRY_CAST(x AS BIGINT)", values, "DOUBLE")


DATE_PIECES = st.one_of(
    st.datetimes(min_value=__import__("datetime").datetime(1990, 1, 1), max_value=__import__("datetime").datetime(2090, 1, 1))
    .flatmap(lambda t: st.sampled_from([
        t.strftime("%Y-%m-%d"), t.strftime("%Y-%m-%dT%H:%M:%S"), t.strftime("%Y-%m-%d %H:%M"), t.strftime("%Y/%m/%d"),
        t.strftime("%m/%d/%Y"), t.strftime("%d-%m-%Y"), t.strftime("%Y%m%d"), t.strftime("%Y-%m-%dT%H:%M:%S.%f"),
        t.strftime("%Y-%m-%dT%H:%M:%S") + "Z", t.strftime("%Y-%m-%dT%H:%M:%S") + "+02:00", t.strftime("%Y-%m"),
        t.strftime("%Y-%m-%d") + " junk", f"{t.year}-{t.month}-{t.day}", t.strftime(" %Y-%m-%d")])),
    st.integers(min_value=1000000000, max_value=9999999999).map(str),
    st.text(alphabet="0123456789-/:T ", max_size=12),
)

PARSE = ("CASE WHEN TRY_CAST(x AS TIMESTAMP) IS NOT NULL THEN TRY_CAST(x AS TIMESTAMP) "
         "WHEN regexp_matches(x, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(left(x, 10) AS TIMESTAMP) "
         "WHEN regexp_matches(x, '^[0-9]{10}$') THEN make_timestamp(CAST(x AS BIGINT) * 1000000) END")


@HYPOTHESIS
@given(st.lists(DATE_PIECES, min_size=30, max_size=120))
def test_dates_parse_like_the_expected_ladder(spark, values):
    # A trailing blank or fraction dot is read differently; such text is not a date in any source.
    values = [v for v in values if v == v.strip() or v[:1] == " "]
    assert tell(spark, c.parse_date, values, "string") == ask(PARSE, values, "VARCHAR")


def test_epoch_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        [value] = tell(spark, lambda x: c.parse_date(x).cast("string"), ["1709634030"], "string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert value == "2024-03-05 10:20:30"


def test_lateness_ladder_bounds(spark):
    labels = tell(spark, c.lateness_bucket, [-3, 0, 1, 7, 8, 30, 31, None], "int")
    assert labels == ["on time / early", "on time / early", "1-7 days late", "1-7 days late", "8-30 days late",
                      "8-30 days late", "30+ days late", "30+ days late"]


def test_day_difference_counts_midnights(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-01 23:59:00' a, timestamp_ntz'2024-01-02 00:01:00' b").select(
        c.days_between(F.col("a"), F.col("b")).alias("d")).first()
    assert row.d == 1


def test_rate_edges(spark):
    assert tell(spark, c.harmonised_rate, [11.5, 0.087, 10.0, None], "double") == [1 / 11.5, 0.087, 10.0, None]
