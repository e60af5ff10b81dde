"""Make a result comparable across engines: money as double, doubles to ten
significant digits, times as text to the microsecond. Only the registered queries
use this, at their edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ten_digits(value: Column) -> Column:
    finite = F.abs(value) < float("inf")
    return F.when(finite, F.format_string("%.9e", value).try_cast("double")).otherwise(value)


def comparable(df: DataFrame) -> DataFrame:
    outputs = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = ten_digits(value.cast("double"))
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        outputs.append(value.alias(field.name))
    return df.select(*outputs)
