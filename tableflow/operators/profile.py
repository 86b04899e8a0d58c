"""Sizes and keys of a table."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def size_estimate(df: DataFrame) -> DataFrame:
    """n_rows and size_bytes: the bytes of texts and binaries, 16 for every other value and for NULL texts none."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts], F.lit(16 * (len(df.columns) - len(texts))))
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("size_bytes"))


def suggest_merge_keys(df: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """key_columns, n_rows, n_distinct, n_null, is_key for each candidate: a key has no NULL and as many values as rows."""
    parts = []
    for columns in candidates:
        # a row for each value with its count: partial counts before the shuffle, no distinct set held in one place
        null = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])
        groups = df.groupBy(*columns, null.alias("_null")).agg(F.count("*").alias("_n"))
        parts.append(groups.agg(
            F.lit(",".join(columns)).alias("key_columns"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count_if(~F.col("_null")).alias("n_distinct"),
            F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).alias("n_null"),
        ))
    return reduce(DataFrame.unionByName, parts).withColumn("is_key", (F.col("n_null") == 0) & (F.col("n_rows") == F.col("n_distinct")))


#: Relative standard deviation of the estimated distinct counts; a set is tried exactly from four of them below the row count on.
ERROR = 0.02


def find_keys(df: DataFrame, most: int = 3, columns: list[str] | None = None) -> DataFrame:
    """key_columns, n_rows, n_distinct, n_null, is_key: the least sets of at most so many columns that tell all rows apart and hold no NULL.

    Level by level over the sets of columns: the distinct counts of all sets of a level are estimated in one scan by mergeable
    sketches; a set that holds a key already is passed over, one whose columns cannot have enough values together too. Only sets
    whose estimate comes near the number of rows are counted exactly. Sets come in the order of the columns.
    """
    comparable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.BinaryType)) and (columns is None or f.name in columns)]
    found: list[tuple[str, ...]] = []
    distinct: dict[str, float] = {}
    usable, n = comparable, 0
    for size in range(1, most + 1):
        sets = [c for c in combinations(usable, size) if not any(set(k) <= set(c) for k in found)]
        # n rows need n values: of columns with fewer together no key is made
        sets = [c for c in sets if size == 1 or reduce(lambda a, b: a * b, [distinct[x] * (1 + 4 * ERROR) for x in c]) >= n]
        if not sets:
            continue
        estimates = [F.approx_count_distinct(F.struct(*[F.col(f"`{x}`") for x in c]), ERROR).alias(str(i)) for i, c in enumerate(sets)]
        row = df.agg(F.count("*").alias("n"), *estimates, *[F.count(F.col(f"`{c}`")).alias(f"has {c}") for c in comparable]).first()
        n = row["n"]
        if size == 1:
            distinct = {c[0]: row[str(i)] for i, c in enumerate(sets)}
            usable = [c for c in comparable if row[f"has {c}"] == n]
            sets, near = [c for c in sets if c[0] in usable], {c[0]: distinct[c[0]] for c in sets}
            tried = [c for c in sets if near[c[0]] >= n * (1 - 4 * ERROR)]
        else:
            tried = [c for i, c in enumerate(sets) if row[str(i)] >= n * (1 - 4 * ERROR)]
        if tried:
            proofs = suggest_merge_keys(df, [list(c) for c in tried]).where("is_key").collect()  # a row for each set that was near
            proven = {r["key_columns"] for r in proofs}
            found += [c for c in tried if ",".join(c) in proven]
    if not found:
        return suggest_merge_keys(df.limit(0), [[c] for c in comparable[:1]]).limit(0)
    return suggest_merge_keys(df, [list(c) for c in found])


#: Rows of each side of a quantile that the sketches leave open, as a share of all: three times their error.
NARROW = 10_000


def exact_quantiles(df: DataFrame, shares: dict[str, list[float]]) -> dict[str, list[Any]]:
    """For each column the least values at or below which such shares of its rows lie, NULL left out; None without values.

    Three scans: sketches bound each value, rows below the bounds are counted, and of the values between them alone (a few in ten thousand rows)
    the number of each is fetched. No task gets all values of a column, as an exact percentile's does.
    """
    near = 3 / NARROW
    asked = {c: [x for s in own for x in (max(0.0, s - near), min(1.0, s + near))] for c, own in shares.items()}
    bounds = df.agg(*[x for i, (c, own) in enumerate(asked.items()) for x in (F.percentile_approx(f"`{c}`", own, NARROW).alias(f"q{i}"), F.count(f"`{c}`").alias(f"n{i}"))]).first()
    spans = {c: list(zip((bounds[f"q{i}"] or [])[::2], (bounds[f"q{i}"] or [])[1::2], strict=True)) for i, c in enumerate(shares)}
    below = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"`{c}`") < F.lit(low)).alias(f"b{i}_{j}") for i, (c, own) in enumerate(spans.items()) for j, (low, _) in enumerate(own)]).first()
    out: dict[str, list[Any]] = {}
    for i, (c, own) in enumerate(spans.items()):
        value = F.col(f"`{c}`")
        out[c] = [None] * (len(shares[c]) - len(own))
        for j, (low, high) in enumerate(own):
            at = below[f"b{i}_{j}"]
            for v, n in df.where(value.between(F.lit(low), F.lit(high))).groupBy(value.alias("v")).agg(F.count("*").alias("n")).orderBy("v").collect():
                at += n
                if at >= bounds[f"n{i}"] * shares[c][j]:
                    out[c].append(v)
                    break
            else:
                raise RuntimeError(f"{c}: no value at {shares[c][j]} between the bounds")
    return out
