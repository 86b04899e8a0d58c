"""Fingerprints of key ranges in levels, so that two tables are compared by reading only where they differ.

A tree has a leaf for each range of the key, with the number of its rows and the sum and XOR of their hashes, and above it nodes of FAN
children each up to one root. All three are sums of the rows' own, so nodes add up, a tree grows by the tree of the rows
that are appended, and it says whether two tables are equal without a row being read. The ranges are cut from one table
by its quantiles; the tree of another table is built on the same cuts. A table that is written in order of the key lets files
be skipped when only some ranges are read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import fingerprint_number, row_md5
from ..sources.scans import Shard, equal_shards, in_shard
from . import reconcile, write
from .project import column_named

#: Children of a node.
FAN = 16
_NODE = "level int, node long, n_rows long, hash_sum decimal(38,0), hash_xor long"


@dataclass(frozen=True)
class HashTree:
    """nodes: level (0: leaves), node, n_rows, hash_sum, hash_xor; the keys, columns and cuts that they are of. The last leaf holds rows with a NULL in their key."""

    nodes: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    cuts: tuple[tuple, ...]

    @property
    def levels(self) -> int:
        n, levels = len(self.cuts) + 2, 0
        while n > 1:
            n, levels = -(-n // FAN), levels + 1
        return levels

    def total(self) -> tuple[int, int, int]:
        """Rows, hash sum and XOR of the whole table: its fingerprint, without a scan."""
        r = self.nodes.where(F.col("level") == self.levels).first()
        return (r["n_rows"], int(r["hash_sum"]), r["hash_xor"]) if r else (0, 0, 0)

    def save(self, path: str) -> None:
        """Beside the table, to be read by load_tree."""
        spark, at = self.nodes.sparkSession, path.rstrip("/")
        spark.createDataFrame([(json.dumps([self.keys, self.columns]),)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{at}/about")
        cuts = spark.createDataFrame([(i, *c) for i, c in enumerate(self.cuts)], ["place", *[f"k{i}" for i in range(len(self.keys))]]) if self.cuts else spark.range(0).withColumnRenamed("id", "place")
        cuts.coalesce(1).write.mode("overwrite").parquet(f"{at}/cuts")
        self.nodes.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/nodes")

    def plus(self, rows: DataFrame) -> HashTree:
        """The tree after rows were appended; only they are read."""
        more = build(rows.select(*self.columns), list(self.keys), self.cuts)
        both = self.nodes.unionByName(more.nodes)
        return HashTree(_summed(both, "level", "node"), self.keys, self.columns, self.cuts)


def load_tree(spark: SparkSession, path: str) -> HashTree:
    """A tree that save has written."""
    about = spark.read.parquet(f"{path.rstrip('/')}/about").first()
    keys, columns = json.loads(about["about"])
    return HashTree(spark.read.schema(_NODE).parquet(f"{path.rstrip('/')}/nodes"), tuple(keys), tuple(columns), tuple(tuple(r)[1:] for r in spark.read.parquet(f"{path.rstrip('/')}/cuts").orderBy("place").collect()))


def _summed(nodes: DataFrame, *by: str) -> DataFrame:
    grouped = nodes.groupBy(*by).agg(F.sum("n_rows").cast("long").alias("n_rows"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
    return grouped.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(_NODE).fields if f.name in grouped.columns])


def _range_of(df: DataFrame, keys: list[str], cuts: tuple[tuple, ...]) -> Column:
    """The number of cuts at or before the key, by binary search in the array of them; for NULL keys the one after the last range."""
    kinds = [df.schema[k].dataType for k in keys]
    pack = lambda values: F.struct(*[v.cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, kinds, strict=True))])
    own = [F.col(f"`{k}`") for k in keys]
    missing = write._some_null(keys)
    if not cuts:
        return F.when(missing, 1).otherwise(0)
    # one literal that is folded to an array before the scan: a thousand cuts are no thousand expressions
    texts = json.dumps([{f"k{i}": _written(v, isinstance(kinds[i], T.TimestampType)) for i, v in enumerate(c)} for c in cuts])
    plain, typed = (", ".join(f"k{i}: {t}" for i, t in enumerate(ts)) for ts in (["string"] * len(kinds), [t.simpleString() for t in kinds]))
    bounds, steps = F.from_json(F.lit(texts), f"array<struct<{plain}>>").cast(f"array<struct<{typed}>>"), []
    step = 1 << (len(cuts).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1
    at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.coalesce(F.get(bounds, at + s - 1) <= pack(own), F.lit(False)), at + s).otherwise(at))
    return F.when(missing, len(cuts) + 1).otherwise(at)


def _written(value: object, zoned: bool) -> str:
    """A text that casts back to the value; instants with their zone."""
    return value.astimezone(timezone.utc).isoformat() if zoned and isinstance(value, datetime) else str(value)


def build(df: DataFrame, keys: list[str], cuts: tuple[tuple, ...] | None = None, leaves: int = 1024) -> HashTree:
    """The tree of a table: one scan and one aggregation with partial results; without cuts another pass for the quantiles of the key."""
    keys = [column_named(df, k) for k in keys]
    if cuts is None:
        cuts = tuple(s.lower for s in equal_shards(df, keys, leaves) if s.lower is not None)
    hashed = df.select(_range_of(df, keys, cuts).cast("long").alias("node"), fingerprint_number(row_md5(df)).alias("h"))
    level = _summed(hashed.select("node", F.lit(1).alias("n_rows"), F.col("h").cast("decimal(38,0)").alias("hash_sum"), F.col("h").alias("hash_xor")), "node")
    leaf = HashTree(level, tuple(keys), tuple(df.columns), cuts)
    nodes, spark = level.withColumn("level", F.lit(0)), df.sparkSession
    # as many rows as there are leaves: they are kept, so that no level scans the table again
    rows = [tuple(r) for r in nodes.select("level", "node", "n_rows", "hash_sum", "hash_xor").collect()]
    all_rows, below = list(rows), rows
    for n in range(1, leaf.levels + 1):
        above: dict[int, list] = {}
        for _, node, count, total, xor in below:
            a = above.setdefault(node // FAN, [0, 0, 0])
            a[0], a[1], a[2] = a[0] + count, a[1] + total, a[2] ^ xor
        below = [(n, node, *values) for node, values in sorted(above.items())]
        all_rows += below
    return HashTree(spark.createDataFrame(all_rows, _NODE), tuple(keys), tuple(df.columns), cuts)


def differing(a: HashTree, b: HashTree) -> list[int]:
    """The leaves in which two trees differ: from the root down, only below nodes that differ."""
    if a.cuts != b.cuts or a.keys != b.keys:
        raise ValueError("the trees have other ranges")
    if sorted(c.lower() for c in a.columns) != sorted(c.lower() for c in b.columns):
        raise ValueError("the trees have other columns")
    open_: list[int] | None = None
    for level in range(a.levels, -1, -1):
        x, y = (t.nodes.where(F.col("level") == level) for t in (a, b))
        if open_ is not None:
            x, y = (d.where((F.col("node") / FAN).cast("long").isin(open_)) for d in (x, y))
        both = x.select("node", F.struct("n_rows", "hash_sum", "hash_xor").alias("x")).join(y.select("node", F.struct("n_rows", "hash_sum", "hash_xor").alias("y")), "node", "full")
        open_ = sorted(r["node"] for r in both.where(~F.col("x").eqNullSafe(F.col("y"))).select("node").collect())
        if not open_:
            return []
    return open_


def rows_of(df: DataFrame, tree: HashTree, leaves: list[int]) -> DataFrame:
    """The rows of some leaves; neighbouring leaves are one range, and ranges are filters that reach the files."""
    keys, last = [column_named(df, k) for k in tree.keys], len(tree.cuts)
    runs: list[list[int]] = []
    for i in (i for i in leaves if i <= last):
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    shards = [Shard(tree.cuts[i - 1] if i else None, tree.cuts[j] if j < last else None) for i, j in runs]
    shards += [Shard(nulls=True)] if last + 1 in leaves else []
    parts = [in_shard(df, keys, s) for s in shards]
    return write.append_union(parts) if parts else df.limit(0)


def tree_diff(source: DataFrame, target: DataFrame, source_tree: HashTree, target_tree: HashTree, **more) -> reconcile.Diff:
    """What reconcile.diff finds, from the ranges that differ alone; equal rows of other ranges are not among its rows."""
    leaves = differing(source_tree, target_tree)
    return reconcile.diff(rows_of(source, source_tree, leaves), rows_of(target, target_tree, leaves), list(source_tree.keys), **more)


def summary(found: reconcile.Diff, source_tree: HashTree, target_tree: HashTree) -> DataFrame:
    """The counts of the whole tables: those of all rows (of repeated keys too) from the trees, those of differing rows from the ranges read."""
    return found.summary.withColumns({"source_total": F.lit(source_tree.total()[0]).cast("long"), "target_total": F.lit(target_tree.total()[0]).cast("long")})
