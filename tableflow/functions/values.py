"""Canonical text, hashes of rows, and null-safe comparison of values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layouts in which run times are accepted.
TIME_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss.SSSSSSSSSXXX", "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd",
)


def canon(c: Column, data_type: T.DataType) -> Column:
    """One text for equal values in every engine: floats by a fixed scale, times to the second, booleans as 1 and 0, bytes as hex."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.cast("decimal(38,6)").cast("string")
    if isinstance(data_type, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(data_type, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def canon_of(df: DataFrame, name: str) -> Column:
    return canon(F.col(f"`{name}`"), df.schema[name].dataType)


def _plain(c: Column, data_type: T.DataType) -> Column:
    """Nested values with the entries of maps in order, so that equal maps have one text."""
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(_plain(e["key"], data_type.keyType).alias("key"), _plain(e["value"], data_type.valueType).alias("value"))))
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda x: _plain(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_plain(c[f.name], f.dataType).alias(f.name) for f in data_type.fields]))
    return c


def _holds_map(data_type: T.DataType) -> bool:
    return "map<" in data_type.simpleString()


def exact_text(c: Column, data_type: T.DataType) -> Column:
    """A text that differs whenever the value does: shortest digits of numbers (1, 1.0 and 1.00 are one value), times to the microsecond."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.regexp_replace((c + F.lit(0.0).cast(data_type)).cast("string"), r"\.0$", "")  # -0.0 is 0.0
    if isinstance(data_type, T.DecimalType) and data_type.scale > 0:
        return F.regexp_replace(F.regexp_replace(c.cast("string"), "0+$", ""), r"\.$", "")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_plain(c, data_type) if _holds_map(data_type) else c, {"ignoreNullFields": "false"})
    return canon(c, data_type)


def row_md5(df: DataFrame, columns: list[str] | None = None, strict: bool = True) -> Column:
    """MD5 of the row's texts. Exact texts behind their lengths, NULL as n, so that no two rows are written alike.

    strict=False is the form that other engines are compared by: canonical texts joined by a bar, NULL spelled out;
    it takes some different rows for equal.
    """
    names = columns or df.columns
    if not strict:
        return F.md5(F.concat_ws("|", *[F.coalesce(canon_of(df, c), F.lit("NULL")) for c in names]).cast("binary"))
    texts = [exact_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in names]
    return F.md5(F.concat(F.lit(""), *[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]).cast("binary"))


def fingerprint_number(md5: Column) -> Column:
    """The first 15 hex digits of a hash as a whole number."""
    return F.conv(F.substring(md5, 1, 15), 16, 10).cast("long")


_NUMBERS = (T.IntegralType, T.FractionalType)


def values_equal(a: Column, b: Column, left: T.DataType, right: T.DataType) -> Column:
    """NULL equals NULL alone; numbers by value, times by instant, bytes by content; other mixed types by their text."""
    if left == right or isinstance(left, _NUMBERS) and isinstance(right, _NUMBERS):
        return a.eqNullSafe(b)
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(left, times) and isinstance(right, times):
        return a.cast("timestamp").eqNullSafe(b.cast("timestamp"))
    if isinstance(left, times + (T.BinaryType,)) or isinstance(right, times + (T.BinaryType,)):
        return a.isNull() & b.isNull()
    return a.cast("string").eqNullSafe(b.cast("string"))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which two key columns are compared; text where they have no other in common."""
    if a == b:
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    whole = [20 if isinstance(x, T.IntegralType) else x.precision - x.scale if isinstance(x, T.DecimalType) else 99 for x in (a, b)]
    scale = max(x.scale if isinstance(x, T.DecimalType) else 0 for x in (a, b))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DecimalType(max(whole) + scale, scale) if max(whole) + scale <= 38 else T.DoubleType()
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return T.TimestampType() if isinstance(a, times) and isinstance(b, times) else T.StringType()


def key_value(c: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A key in the type it is compared in: its exact text where that is text, so that the number 1.0 meets the text 1."""
    return exact_text(c, own) if isinstance(wanted, T.StringType) and not isinstance(own, T.StringType) else c.cast(wanted)


def parse_time(c: Column) -> Column:
    """The first layout that reads the text; NULL if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(x)) for x in TIME_LAYOUTS])


def row_preview(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The first three columns as text, each cut to 17 characters and three dots when longer than 20."""
    shown = []
    for name in (columns or df.columns)[:3]:
        t = F.coalesce(canon_of(df, name), F.lit("NULL"))
        shown.append(F.concat(F.lit(f"{name}:"), F.when(F.char_length(t) > 20, F.concat(F.left(t, F.lit(17)), F.lit("..."))).otherwise(t)))
    return F.concat(F.lit("{"), F.concat_ws(", ", *shown), F.lit("}"))


def all_equal(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions, F.lit(True))
