"""Scans. A cursor is always a typed literal or a named parameter, so it reaches the files or the database as a filter."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def query_scan(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None, args: dict[str, Any] | None = None) -> DataFrame:
    """Run a task's SQL over named DataFrames; closing semicolons are dropped. Views of the session are as before afterwards."""
    known = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary} if views else set()
    before = {name: spark.table(name) for name in views or {} if name.lower() in known}
    try:
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql.strip().rstrip(";").rstrip(), args=args)  # names are resolved here, once
    finally:
        for name in views or {}:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def jdbc_scan(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None, key: str | None = None, cursor: Any = None, shards: int = 1) -> DataFrame:
    """A query of a database. With a key only rows past the cursor; with shards also in parallel ranges of the key.

    The cursor is a filter that reaches the database, in the ranges' bounds too. Without rows there is one range.
    """
    text = query.strip().rstrip(";").rstrip()
    if key is None or shards < 2:
        df = spark.read.format("jdbc").options(url=url, query=text, **(properties or {})).load()
        return df if key is None else incremental_scan(df, key, cursor)
    return incremental_scan(range_scan(spark, url, f"({text}) q", key, shards, properties, cursor), key, cursor)


def range_scan(spark: SparkSession, url: str, table: str, key: str, partitions: int, properties: dict[str, str] | None = None, cursor: Any = None) -> DataFrame:
    """Read a table (or a query in brackets with a name) over JDBC in parallel ranges of a numeric or time key.

    The bounds come from one aggregate query, over the rows past the cursor if there is one; rows outside the bounds fall in the first or last range.
    """
    if partitions < 2:
        raise ValueError("a range scan needs two partitions at least")
    whole = spark.read.jdbc(url, table, properties=properties)
    low, high = incremental_scan(whole, key, cursor).agg(F.min(key), F.max(key)).first()
    if low is None:
        return whole
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties)


#: Keys that are drawn for each shard where they have no mergeable quantiles.
DRAWN = 400


@dataclass(frozen=True)
class Shard:
    """Rows from lower (inclusive) to upper (exclusive), tuples of key values; None is open. nulls: rows with a NULL in their key instead."""

    lower: tuple | None = None
    upper: tuple | None = None
    nulls: bool = False


def equal_shards(df: DataFrame, keys: list[str], shards: int) -> list[Shard]:
    """Ranges of a key with about as many rows each, whatever its values: at most so many, and one more for rows with a NULL in their key.

    One number or time is cut at mergeable quantiles, so in one pass with partial results; texts and keys of several columns at the
    quantiles of DRAWN rows a shard, drawn at random with a fixed seed, which alone come to the driver. Together the ranges are
    open on both sides, so each row is in one, also one that came after the bounds were taken. A single key is never parted.
    """
    if shards <= 1:
        raise ValueError("shards must be over one")
    columns = [F.col(f"`{k}`") for k in keys]
    known = df.select(*columns).dropna()
    kind = df.schema[keys[0]].dataType
    if len(keys) == 1 and isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        found = known.agg(F.percentile_approx(columns[0], [i / shards for i in range(1, shards)], 200 * shards).alias("q")).first()["q"]
        cuts = [(v,) for v in found or []]
    else:
        n = known.count()
        drawn = sorted(map(tuple, known.sample(min(1.0, 1.2 * DRAWN * shards / max(n, 1)), seed=0).collect()))
        cuts = [drawn[len(drawn) * i // shards] for i in range(1, shards)] if drawn else []
    cuts = sorted(set(cuts))
    ranges = [Shard(a, b) for a, b in zip([None, *cuts], [*cuts, None], strict=True)]
    return ranges + [Shard(nulls=True)]


def _from(keys: list[Column], bound: tuple, kinds: list[T.DataType]) -> Column:
    """Whether the key is at the bound or after it; the first column alone is a filter that reaches the files."""
    values = [F.lit(v).cast(t) for v, t in zip(bound, kinds, strict=True)]
    after = keys[-1] >= values[-1]
    for k, v in reversed(list(zip(keys[:-1], values[:-1], strict=True))):
        after = (k > v) | (k == v) & after
    return (keys[0] >= values[0]) & after


def in_shard(df: DataFrame, keys: list[str], shard: Shard) -> DataFrame:
    """The rows of one range."""
    columns, kinds = [F.col(f"`{k}`") for k in keys], [df.schema[k].dataType for k in keys]
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    if shard.nulls:
        return df.where(missing)
    out = df.where(~missing)
    if shard.lower is not None:
        out = out.where(_from(columns, shard.lower, kinds))
    if shard.upper is not None:
        out = out.where((columns[0] <= F.lit(shard.upper[0]).cast(kinds[0])) & ~_from(columns, shard.upper, kinds))
    return out


def equal_scan(df: DataFrame, keys: list[str], shards: int, cursor: Any = None) -> DataFrame:
    """The rows past a cursor of the first key column as a union of one scan for each equal range, each with filters of its own."""
    df = incremental_scan(df, keys[0], cursor)
    return reduce(DataFrame.unionByName, [in_shard(df, keys, s) for s in equal_shards(df, keys, shards)])


def equal_range_scan(spark: SparkSession, url: str, table: str, key: str, shards: int, properties: dict[str, str] | None = None, cursor: Any = None) -> DataFrame:
    """A table of a database in ranges of a number with about as many rows each, by its quantiles; rows without a key are a range of their own."""
    keys = incremental_scan(spark.read.jdbc(url, table, properties=properties).select(key), key, cursor)
    if not isinstance(keys.schema[key].dataType, T.NumericType):
        raise TypeError("only a number's ranges can be written for every database")
    name = f'"{key}"' if not url.startswith(("jdbc:mysql", "jdbc:mariadb")) else f"`{key}`"
    conditions = []
    for s in equal_shards(keys, [key], shards):
        parts = [f"{name} {sign} {bound[0]}" for sign, bound in ((">=", s.lower), ("<", s.upper)) if bound is not None] or [f"{name} IS NOT NULL"]
        conditions.append(f"{name} IS NULL" if s.nulls else " AND ".join(parts))
    return incremental_scan(spark.read.jdbc(url, table, predicates=conditions, properties=properties), key, cursor)


def sharded_scan(df: DataFrame, key: str, shards: int, cursor: Any = None) -> DataFrame:
    """The rows past the cursor as a union of one scan for each range of the key, each with its own filters on the files.

    Only the ranges come to the driver, a row each. Rows without a key are a part of their own where there is no cursor; none of them is past one.
    """
    keyless = [df.where(F.col(key).isNull())] if cursor is None else []
    df = incremental_scan(df, key, cursor)
    ranges = shard_ranges(df, key, shards).orderBy("shard").collect()
    parts = [shard_filter(df, key, r["lower"], r["upper"], r["last_inclusive"]) for r in ranges]
    return reduce(DataFrame.unionByName, parts + keyless) if parts + keyless else df.limit(0)


def shard_ranges(df: DataFrame, key: str, shards: int) -> DataFrame:
    """shard, lower, upper, last_inclusive: the key's range in at most so many parts; one part when all keys are equal, no row without keys.

    Whole numbers step by max((max - min) div shards, 1) and stop once a lower bound passes the maximum; floats and
    times are cut in equal widths.
    """
    if shards <= 1:
        raise ValueError("shards must be over one")
    kind = df.schema[key].dataType
    bounds = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo is not null")
    numbered = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    last = F.col("shard") == shards - 1
    if isinstance(kind, T.IntegralType):
        step = F.greatest(F.expr(f"(hi - lo) div {shards}"), F.lit(1))
        lower = F.col("lo") + F.col("shard") * step
        upper = F.least(F.when(last, F.col("hi")).otherwise(F.col("lo") + (F.col("shard") + 1) * step), F.col("hi"))
        cut = numbered.select("shard", lower.alias("lower"), upper.alias("upper"), "hi").where("lower < hi or shard = 0")
        return cut.select("shard", F.col("lower").cast("long"), F.col("upper").cast("long"), (F.col("upper") == F.col("hi")).alias("last_inclusive"))
    if isinstance(kind, T.FractionalType):
        width = (F.col("hi") - F.col("lo")) / shards
        lower, upper = F.col("lo") + F.col("shard") * width, F.when(last, F.col("hi")).otherwise(F.col("lo") + (F.col("shard") + 1) * width)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        name = kind.simpleString()
        numbered = numbered.withColumns({"lo": F.unix_micros(F.col("lo").cast("timestamp")), "hi": F.unix_micros(F.col("hi").cast("timestamp"))})
        width = F.expr(f"(hi - lo) div {shards}")
        lower, upper = (F.timestamp_micros(x).cast(name) for x in (F.col("lo") + F.col("shard") * width, F.when(last, F.col("hi")).otherwise(F.col("lo") + (F.col("shard") + 1) * width)))
    else:
        raise TypeError(f"cannot split a key of type {kind.simpleString()}")
    cut = numbered.where("lo < hi or shard = 0").withColumns({"lower": lower, "upper": upper, "single": F.col("lo") == F.col("hi")})
    return cut.select("shard", "lower", F.when(F.col("single"), F.col("lower")).otherwise(F.col("upper")).alias("upper"), (last | F.col("single")).alias("last_inclusive"))


def shard_filter(df: DataFrame, key: str, lower: Any, upper: Any, last_inclusive: bool) -> DataFrame:
    """The rows of one shard."""
    k = F.col(key)
    return df.where((k >= F.lit(lower)) & ((k <= F.lit(upper)) if last_inclusive else (k < F.lit(upper))))


def with_shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    """The rows with their shard's number; the ranges are a few rows and are broadcast. Rows without a key have none."""
    ranges = shard_ranges(df, key, shards)
    inside = (F.col(key) >= F.col("lower")) & ((F.col(key) < F.col("upper")) | F.col("last_inclusive") & (F.col(key) <= F.col("upper")))
    return df.join(F.broadcast(ranges), inside, "left").drop("lower", "upper", "last_inclusive")


def up_to(df: DataFrame, key: str, bound: Any, first: bool) -> DataFrame:
    """The rows up to a round's bound; the first round takes those without a key too, which no later one will find past its cursor."""
    inside = F.col(key) <= F.lit(bound)
    return df.where(inside | F.col(key).isNull() if first else inside)


def incremental_scan(df: DataFrame, key: str, cursor: Any = None, lateness: Any = None) -> DataFrame:
    """Rows strictly past the cursor; with lateness, also those that far behind it (the caller drops what it has seen). Without a cursor all, those without a key too."""
    if cursor is None:
        return df
    bound = F.lit(cursor).cast(df.schema[key].dataType)
    return df.where(F.col(key) > (bound if lateness is None else bound - F.lit(lateness)))


def order_by_cursor(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def templated_scan(spark: SparkSession, sql: str, cursor: Any = None, default: Any = 0, key: str | None = None, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL with :last_value, bound to the cursor (default without one); ordered by the key if there is one and the text has no order."""
    df = query_scan(spark, sql, views, {"last_value": default if cursor is None else cursor})
    return df.orderBy(key) if key and not re.search(r"\border\s+by\b", sql, re.I) else df


def text_decode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Binary values of the named columns as UTF-8 text; other types stay."""
    binary = [c for c in columns if isinstance(df.schema[c].dataType, T.BinaryType)]
    return df.withColumns({c: F.decode(c, "UTF-8") for c in binary})


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def key_range(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def counts_and_range(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def federated_scan(spark: SparkSession, sources: dict[str, DataFrame | dict[str, Any]]) -> dict[str, DataFrame]:
    """Two aliased sources for a join: DataFrames as they are, or the arguments of a JDBC scan."""
    if len(sources) != 2:
        raise ValueError(f"a federated task takes two sources, not {len(sources)}")
    return {alias: s if isinstance(s, DataFrame) else jdbc_scan(spark, **s) for alias, s in sources.items()}
