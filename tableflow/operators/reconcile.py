"""Keyed comparison of two tables, digests, and checks after a load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import all_equal, common_type, fingerprint_number, key_value, row_md5, values_equal
from .project import column_named, where_limit


@dataclass(frozen=True)
class Diff:
    """All keys with their state, and what can be read from them."""

    rows: DataFrame
    keys: list[str]
    columns: list[str]

    def _one(self, state: str, side: str) -> DataFrame:
        return self.rows.where(F.col("state") == state).select(*[F.col(f"{side}.`{c}`").alias(c) for c in self.columns])

    @property
    def source_only(self) -> DataFrame:
        return self._one("source_only", "source")

    @property
    def target_only(self) -> DataFrame:
        return self._one("target_only", "target")

    @property
    def mismatch(self) -> DataFrame:
        """The key, both rows and the names of the columns that differ."""
        return self.rows.where("state = 'mismatch'").select(*[F.col(f"source.`{k}`").alias(k) for k in self.keys], "source", "target", "diff_cols")

    @property
    def summary(self) -> DataFrame:
        """One row of counts; a single pass over the joined keys."""
        state = F.col("state")
        return self.rows.agg(
            F.count_if(state != "target_only").alias("source_total"), F.count_if(state != "source_only").alias("target_total"),
            F.count_if(state == "source_only").alias("source_only"), F.count_if(state == "target_only").alias("target_only"), F.count_if(state == "mismatch").alias("mismatch"),
        )

    @property
    def by_column(self) -> DataFrame:
        return self.rows.where("state = 'mismatch'").select(F.explode("diff_cols").alias("column_name")).groupBy("column_name").agg(F.count("*").alias("n_rows"))

    def write(self, path: str, fmt: str = "json") -> None:
        """One folder for each set; rows of both sides become JSON text in CSV files."""
        flat = self.mismatch if fmt == "json" else self.mismatch.withColumns({"source": F.to_json("source"), "target": F.to_json("target"), "diff_cols": F.concat_ws(",", "diff_cols")})
        for name, df in (("source_only", self.source_only), ("target_only", self.target_only), ("mismatch", flat), ("summary", self.summary)):
            writer = df.write.mode("overwrite")
            (writer.option("header", True).csv if fmt == "csv" else writer.json)(f"{path}/{name}")


def _side(df: DataFrame, keys: list[Column], columns: list[str], name: str, unique: bool) -> DataFrame:
    """The key as one struct (equal structs have equal or both NULL fields), the row as another, its rank in its key by a hash."""
    side = df.select(F.struct(*keys).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name))
    if unique:
        return side.withColumn("_rank", F.lit(1))
    draw = F.xxhash64(name)
    order = Window.partitionBy("_key").orderBy(draw.desc() if name == "source" else draw.asc())
    return side.withColumn("_rank", F.row_number().over(order))


def diff(source: DataFrame, target: DataFrame, keys: list[str], where: str | None = None, limit: int | None = None, unique_keys: bool = False, strict_keys: bool = False) -> Diff:
    """Compare two tables by key, NULL keys included. Columns are those that both tables have, matched without regard to case.

    A key with several rows: the source's last one takes part (by a hash of the row), the others do not; the target's
    first one is compared and its others count as target_only. unique_keys promises that there are none and saves the
    ranking; strict_keys looks, and raises when there are any.
    """
    if not keys:
        raise ValueError("a diff needs keys")
    keys = [column_named(source, k) for k in keys]
    columns = [c for c in source.columns if c.lower() in {x.lower() for x in target.columns}]
    right = target.select(*[F.col(f"`{column_named(target, c)}`").alias(c) for c in columns])
    left = source.select(*[F.col(f"`{c}`") for c in columns])
    left, right = where_limit(left, where, limit, keys), where_limit(right, where, limit, keys)
    types = [common_type(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    own, other = ([key_value(F.col(f"`{k}`"), side.schema[k].dataType, t).alias(f"k{i}") for i, (k, t) in enumerate(zip(keys, types, strict=True))] for side in (left, right))
    if strict_keys:
        for name, side, key in (("source", left, own), ("target", right, other)):
            if not side.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
                raise ValueError(f"the {name} has repeated keys")
    a, b = _side(left, own, columns, "source", unique_keys or strict_keys), _side(right, other, columns, "target", unique_keys or strict_keys)
    a = a.where("_rank = 1").withColumn("_in_source", F.lit(True))
    b = b.withColumn("_in_target", F.lit(True))
    # on the key alone, so that ranking and joining share one shuffle and one sort of each side
    on = (a["_key"] == b["_key"]) & (b["_rank"] == 1)
    names = [
        F.when(~values_equal(F.col(f"source.`{c}`"), F.col(f"target.`{c}`"), left.schema[c].dataType, right.schema[c].dataType), F.lit(c)) for c in columns
    ]
    joined = a.join(b, on, "full").select("source", "target", "_in_source", "_in_target")
    differing = F.when(F.col("_in_source") & F.col("_in_target"), F.array_compact(F.array(*names)))
    state = F.when(F.col("_in_target").isNull(), "source_only").when(F.col("_in_source").isNull(), "target_only").when(F.size("diff_cols") > 0, "mismatch").otherwise("equal")
    return Diff(joined.withColumn("diff_cols", differing).withColumn("state", state).select("source", "target", "diff_cols", "state"), keys, columns)


#: Row hashes that are sorted and joined in one group of a digest.
DIGEST_ROWS = 100_000


def table_digest(df: DataFrame, columns: list[str] | None = None, strict: bool = True) -> DataFrame:
    """One MD5 of the multiset of rows: MD5 over the sorted row hashes, joined by line feeds. A hash that occurs n > 1 times stands once, as hash:n.

    A larger table's hashes are dealt by their first digits, as many as leave DIGEST_ROWS in a group on average; each
    group has its own digest, and the digest is over those in order. Tables of equal rows have equal counts, so equal groups.
    """
    hashes = df.select(row_md5(df, columns, strict).alias("h"))
    n, digits = hashes.count(), 0
    while n > DIGEST_ROWS << 4 * digits:
        digits += 1
    times = hashes.groupBy("h").agg(F.count("*").alias("n"))  # partial counts: equal rows are one row from here on
    hashes = times.select(F.when(F.col("n") > 1, F.concat("h", F.lit(":"), F.col("n").cast("string"))).otherwise(F.col("h")).alias("h"))
    for at in range(digits, -1, -1):  # groups of groups, sixteen at a time
        hashes = hashes.groupBy(F.left("h", F.lit(at)).alias("p")).agg(F.md5(F.expr("listagg(h, '\\n') within group (order by h)").cast("binary")).alias("h"))
        hashes = hashes.select(F.concat("p", "h").alias("h")) if at else hashes
    return hashes.agg(F.coalesce(F.max("h"), F.md5(F.lit("").cast("binary"))).alias("digest"))


def fingerprint(df: DataFrame, columns: list[str] | None = None, bucket: Column | None = None) -> DataFrame:
    """n_rows, hash_sum, hash_xor of the rows' hashes: independent of order, sensitive to repeats; with a bucket, one row for each."""
    hashed = df.select(*([bucket.alias("bucket")] if bucket is not None else []), fingerprint_number(row_md5(df, columns)).alias("h"))
    grouped = hashed.groupBy("bucket") if bucket is not None else hashed
    return grouped.agg(F.count("*").alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor("h").alias("hash_xor"))


def beside(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables."""
    stacked = rows[0]
    for r in rows[1:]:
        stacked = stacked.unionByName(r, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def validate_checksum(written: DataFrame, reread: DataFrame) -> DataFrame:
    """One row: both fingerprints and whether they agree."""
    columns = written.columns
    a = fingerprint(written, columns).select(*[F.col(c).alias(f"source_{c}") for c in ("n_rows", "hash_sum", "hash_xor")])
    b = fingerprint(reread.select(*columns), columns).select(*[F.col(c).alias(f"target_{c}") for c in ("n_rows", "hash_sum", "hash_xor")])
    same = all_equal([F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in ("n_rows", "hash_sum", "hash_xor")])
    return beside(a, b).withColumn("passed", same)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Exact proof that two tables hold the same rows as often: counts of what either has more of, in one pass."""
    tagged = a.select(*a.columns, F.lit(1).alias("_n")).unionByName(b.select(*a.columns, F.lit(-1).alias("_n")))
    net = tagged.groupBy(*a.columns).agg(F.sum("_n").alias("net"))
    return net.agg(F.coalesce(F.sum(F.greatest("net", F.lit(0))), F.lit(0)).alias("only_left"), F.coalesce(F.sum(F.greatest(-F.col("net"), F.lit(0))), F.lit(0)).alias("only_right")).withColumn("passed", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def validate_row_count(before: int, after: int, expected: int) -> tuple[bool, str]:
    """Whether the target grew by the rows that were written (for a merge: by the inserted keys)."""
    grew = after - before
    return grew == expected, "" if grew == expected else f"row count: target grew by {grew}, expected {expected}"


def random_sample(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """n rows by the order of a keyed hash: repeatable, and a top-n instead of a sort."""
    draw = F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys], F.lit(str(seed))).cast("binary"))
    return df.withColumn("_draw", draw).orderBy("_draw", *keys).limit(n).drop("_draw")


def missing_rows(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows that the table does not hold identically, NULLs equal."""
    other = table.select(*[F.col(f"`{column_named(table, c)}`").alias(f"_t{i}") for i, c in enumerate(rows.columns)])
    return rows.join(other, all_equal([rows[f"`{c}`"].eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(rows.columns)]), "left_anti")


def validate_sample(source: DataFrame, target: DataFrame, n: int = 1000, keys: list[str] | None = None, seed: int = 0, show: int = 5) -> tuple[DataFrame, DataFrame]:
    """Sampled source rows that the target lacks (the first few of them, by key), and a row with both counts."""
    sample = random_sample(source, n, keys or source.columns, seed)
    missing = missing_rows(sample, target)
    counts = beside(sample.agg(F.count("*").alias("sampled")), missing.agg(F.count("*").alias("missing"))).withColumn("passed", F.col("missing") == 0)
    return missing.orderBy(*(keys or source.columns)).limit(show), counts
