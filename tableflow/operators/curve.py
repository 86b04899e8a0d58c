"""Rows along a space-filling curve (Hilbert), so that files can be skipped by a filter on any of several columns.

Each column is split at its own quantiles into 2^bits ranges of about as many rows; the ranks of a row's values
give its place on the curve. Neighbours on the curve are near in every column, so a file of a stretch of it has narrow bounds in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import all_equal
from .project import column_named

#: Bits of a column's rank (fewer where all together would exceed a long), rows drawn for each bound of a text, and how much of a text counts.
BITS, DRAWN, TEXT = 8, 40, 64


def _value(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.substring(c, 1, TEXT)
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c
    raise TypeError(f"{name}: only numbers, times and texts have a place on the curve")


def curve_bounds(df: DataFrame, columns: list[str], bits: int) -> dict[str, list]:
    """For each column the last values of all its 2^bits ranges but one, repeated where one value fills several; empty without values.

    Numbers and times: quantiles by mergeable sketches, all columns in one scan. Texts: of DRAWN rows a bound, drawn with a fixed seed.
    """
    ranges = 1 << bits
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    others = [c for c in columns if c not in texts]
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.count("*").alias("n"), *[F.percentile_approx(_value(df, c), shares, 50 * ranges).alias(f"q{i}") for i, c in enumerate(others)]).first()
    bounds = {c: found[f"q{i}"] or [] for i, c in enumerate(others)}
    if texts:
        share = min(1.0, DRAWN * ranges / max(found["n"], 1))
        drawn = df.select(*[_value(df, c).alias(f"t{i}") for i, c in enumerate(texts)]).sample(share, seed=0).collect()
        for i, c in enumerate(texts):
            own = sorted((r[i] for r in drawn if r[i] is not None), key=str.encode)
            bounds[c] = [own[max(0, len(own) * k // ranges - 1)] for k in range(1, ranges)] if own else []
    return bounds


def _rank(c: Column, kind: T.DataType, bounds: list, bits: int) -> Column:
    """How many bounds are below the value, by binary search; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b).cast(kind) for b in bounds])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(c > F.element_at(held, at + step), at + step).otherwise(at))


def curve_place(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The place of each row on the curve, a long. The bounds are taken now, in one or two jobs."""
    columns = [column_named(df, c) for c in columns]
    if len({*columns}) != len(columns) or not 1 <= len(columns) <= 16:
        raise ValueError("a curve needs one to sixteen different columns")
    bits = min(bits, 62 // len(columns))
    bounds = curve_bounds(df, columns, bits)
    ranks = F.array(*[_rank(_value(df, c), df.schema[c].dataType, bounds[c], bits) for c in columns])
    return _interleaved(_hilbert(ranks, len(columns), bits), len(columns), bits)


def _hilbert(ranks: Column, n: int, bits: int) -> Column:
    """The n parts of the place on a Hilbert curve (Skilling's transform): from the highest bit down, the lower bits are turned so that the curve never jumps."""
    turns = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in reversed(range(1, bits)) for i in range(n)]) if bits > 1 else F.array().cast("array<struct<q:int,i:int>>")

    def turned(x: Column, at: Column) -> Column:
        low, own = at["q"] - 1, F.get(x, at["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        high = own.bitwiseAND(at["q"]) != 0
        first = F.when(high, low).otherwise(swap)
        return F.transform(x, lambda v, k: v.bitwiseXOR(F.when(k == 0, first).when((k == at["i"]) & ~high, swap).otherwise(F.lit(0))))

    def gray(made: Column, v: Column) -> Column:
        return F.concat(made, F.array(v.bitwiseXOR(F.coalesce(F.get(made, F.size(made) - 1), F.lit(0)))))

    x = F.aggregate(F.aggregate(turns, ranks, turned), F.array().cast("array<int>"), gray)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(1, bits))]) if bits > 1 else F.array().cast("array<int>")
    return F.aggregate(F.array(x), x, lambda _, g: F.transform(g, lambda v: v.bitwiseXOR(F.aggregate(steps, F.lit(0), lambda t, q: F.when(F.get(g, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)))))


def _interleaved(parts: Column, n: int, bits: int) -> Column:
    """The bits of n numbers in turn, the first number's first."""

    def spread(part: Column) -> Column:
        out = F.lit(0).cast("long")
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(part, b).bitwiseAND(F.lit(1)).cast("long"), b * n))
        return out

    return F.aggregate(parts, F.lit(0).cast("long"), lambda place, part: F.shiftleft(place, 1).bitwiseOR(spread(part)))


def curve_ordered(df: DataFrame, columns: list[str], partitions: int | None = None, bits: int = BITS) -> DataFrame:
    """Rows in stretches of the curve, one for each partition, and sorted along it.

    Rows at one place are dealt further by a hash of the row, equal rows by the partition they come from, so that a value (or NULL, which has
    rank 0) which holds much of the table is not one task's. An empty table stays one.
    """
    from .write import row_hash

    name = next(n for k in range(len(df.columns) + 1) if (n := f"_place{k}") not in df.columns)
    placed = df.withColumn(name, curve_place(df, columns, bits))
    order = [F.col(name), F.xxhash64(row_hash(df), F.spark_partition_id())]
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(name).drop(name)


def file_skipping(table: DataFrame, filters: dict[str, tuple]) -> DataFrame:
    """n_files, and for each filtered column (low, high) how many files a scan has to read by their bounds: column, n_files, n_read, n_rows (that match)."""
    names = {column_named(table, c): v for c, v in filters.items()}
    within = {c: F.col(f"`{c}`").between(F.lit(low), F.lit(high)) for c, (low, high) in names.items()}
    bounds = [x for i, (c, w) in enumerate(within.items()) for x in (F.min(f"`{c}`").alias(f"low{i}"), F.max(f"`{c}`").alias(f"high{i}"), F.count_if(w).alias(f"n{i}"))]
    files = table.groupBy(F.input_file_name().alias("_file")).agg(*bounds)
    rows = [
        F.struct(F.lit(c).alias("column"), F.count("*").alias("n_files"), F.count_if(all_equal([F.col(f"low{i}") <= F.lit(high), F.col(f"high{i}") >= F.lit(low)])).alias("n_read"), F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias("n_rows"))
        for i, (c, (low, high)) in enumerate(names.items())
    ]
    return files.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
