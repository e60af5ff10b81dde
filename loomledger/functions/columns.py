"""Column -> Column building blocks.

Everything here is a built-in expression, so it stays inside whole-stage
codegen; there is no Python UDF in the package.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomledger.functions import fixed

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
# A decimal without arguments means (18,3) in the results to match.
PLAIN_DECIMAL = "decimal(18,3)"
NTZ = "timestamp_ntz"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# A date alone, or a date and time with an optional zone that is dropped;
# blanks may lead, and may trail a time. Group 1 is what gets cast; anything
# else must not reach the cast, because Spark also reads '2026', '2026-01'
# and padded dates as timestamps.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_ZONE = r" ?(?:Z|[+-]\d{2}(?::?\d{2})?)?"
_ISO = rf"^\s*({_DAY}(?=$)|{_DAY}[ T]{_TIME}(?={_ZONE}\s*$))"
_SLASHED_ISO = r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})"
_ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"
_EPOCH_SECONDS = r"^\d{10}$"
# Java's number parser takes a trailing type letter ('12d'); text never means it.
_TYPED_NUMBER = r"[0-9.]\s*[dDfF]\s*$"


# --- JSON payload ---------------------------------------------------------

#: Where ``json_struct`` puts a payload that is not valid JSON.
MALFORMED = "_malformed"


def json_struct(payload: Column, fields: Iterable[str]) -> Column:
    """Parse the payload once into a struct of strings.

    One pass per row instead of one path lookup per field. Keys are matched
    case-sensitively; a missing key or JSON null gives NULL. Malformed text is
    kept whole in the field ``MALFORMED``.
    """
    schema = ", ".join(f"`{name}` string" for name in [*fields, MALFORMED])
    return F.from_json(payload, schema, {"columnNameOfCorruptRecord": MALFORMED})


def json_text(payload: Column, field: str, default: str | None = None) -> Column:
    value = F.get_json_object(payload, f"$.{field}")
    return value if default is None else F.coalesce(value, F.lit(default))


def json_number(payload: Column, field: str) -> Column:
    return to_number(json_text(payload, field))


# --- numbers --------------------------------------------------------------

def to_number(text: Column) -> Column:
    return F.when(~text.rlike(_TYPED_NUMBER), text.try_cast("double"))


def to_money(number: Column) -> Column:
    """Double -> decimal(18,2), rounding the scaled value half away from zero.

    Rounding ``x * 100`` rather than the shortest text of ``x`` is what makes
    1.005 become 1.00; out-of-range and non-finite values become NULL.
    """
    cents = F.round(number * F.lit(100.0), 0).try_cast("decimal(18,0)")
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def to_whole(number: Column) -> Column:
    """Double -> bigint, ties to even."""
    return F.bround(number, 0).try_cast("bigint")


def money_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY_SUM)


def not_negative(value: Column) -> Column:
    return F.when(value >= 0, value)


def within(value: Column, low: int, high: int) -> Column:
    return F.when(value.between(low, high), value)


def credit_score(number: Column) -> Column:
    return within(to_whole(number), fixed.CREDIT_SCORE_MIN, fixed.CREDIT_SCORE_MAX)


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * n / d`` in doubles; NULL when d is NULL or 0."""
    n, d = numerator.cast("double"), denominator.cast("double")
    scaled = n if scale == 1.0 else n * F.lit(float(scale))
    return F.when(d != 0, scaled / d)


# --- text -----------------------------------------------------------------

def allow_listed(text: Column, codes: list[str]) -> Column:
    code = F.upper(text)
    return F.when(code.isin(*codes), code)


def currency(text: Column) -> Column:
    return allow_listed(text, fixed.CURRENCIES)


def country(text: Column) -> Column:
    return allow_listed(text, fixed.COUNTRIES)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def null_label(text: Column, label: str = "(null)") -> Column:
    return or_default(text, label)


def currency_pair(base: Column, quote: Column, separator: str = "") -> Column:
    """NULL when either side is NULL."""
    return F.concat(base, F.lit(separator), quote)


# --- dates ----------------------------------------------------------------

def parse_date(text: Column) -> Column:
    """ISO date or time, else the leading ISO date, else 10-digit epoch seconds."""
    dashed = F.regexp_replace(text, _SLASHED_ISO, "$1-$2-$3")
    iso = F.regexp_extract(dashed, _ISO, 1).try_cast(NTZ)
    leading_day = F.when(text.rlike(_ISO_PREFIX), F.substring(text, 1, 10).try_cast(NTZ))
    epoch = F.when(text.rlike(_EPOCH_SECONDS), from_epoch(text.try_cast("bigint")))
    return F.coalesce(iso, leading_day, epoch)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds -> zoneless UTC time, whatever the session zone is."""
    return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end (midnights crossed, not 24 h blocks)."""
    return F.datediff(end, start).cast("bigint")


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast(NTZ)


def days_before(ts: Column, days: int) -> Column:
    return ts - F.expr(f"interval {int(days)} days")


def months_before(ts: Column, months: int) -> Column:
    return ts - F.expr(f"interval {int(months)} months")


def ntz(text: str) -> Column:
    return F.lit(text).cast(NTZ)


# --- business rules -------------------------------------------------------

def to_eur(amount: Column, code: Column, rate_to_eur: Column) -> Column:
    """EUR as is; other currencies by their rate; NULL without a rate."""
    value = amount.cast("double")
    return F.when(code == "EUR", value).when(rate_to_eur.isNotNull(), value * rate_to_eur)


def harmonised_rate(rate: Column) -> Column:
    return F.when(rate > fixed.INVERSE_RATE_ABOVE, F.lit(1.0) / rate).otherwise(rate)


def quote_or_estimate(quote: Column, base: Column, rate: Column) -> Column:
    return F.coalesce(quote.cast("double"), base.cast("double") * rate)


def lateness_bucket(lag_days: Column) -> Column:
    """Ladder of upper bounds; a NULL lag falls to the last label."""
    first, *rest = fixed.LATENESS_LADDER
    ladder = reduce(
        lambda acc, step: acc.when(lag_days <= step[0], step[1]),
        rest,
        F.when(lag_days <= first[0], first[1]),
    )
    return ladder.otherwise(fixed.LATENESS_REST)
