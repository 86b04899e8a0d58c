"""Table writes: replace, append, merge, additive schema changes, target types and physical order."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import all_equal, row_md5
from .curve import curve_ordered
from .project import column_named


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in a table's place: two renames, the old folder last to go."""
    fs, new = _fs(spark, staged)
    _, p = _fs(spark, path)
    old = p.suffix(f"_old_{uuid.uuid4().hex}")
    if fs.exists(p) and not fs.rename(p, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, p):
        fs.rename(old, p)
        raise OSError(f"cannot put {staged} in place")
    if fs.exists(old):
        fs.delete(old, True)


def write_table(df: DataFrame, path: str, mode: str = "replace", must_exist: bool = False, cluster: list[str] | None = None) -> None:
    """Write Parquet: replace goes through a staging folder, so the table may be read by the plan that replaces it."""
    spark = df.sparkSession
    exists = path_exists(spark, path)
    if must_exist and not exists:
        raise FileNotFoundError(f"no table at {path}")
    out = clustered(df, cluster) if cluster else df
    if mode == "append":
        out.write.mode("append").parquet(path)
    elif mode == "replace":
        staged = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex}"
        out.write.parquet(staged)
        _swap(spark, staged, path)
    else:
        raise ValueError(f"unknown write mode: {mode}")


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, to settle ties alike in every run."""
    return F.xxhash64(*[F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def work_folder(spark: SparkSession) -> str:
    """A new folder that all machines share, below the one the session names for checkpoints; a session in one process may do without a name."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
    return f"{named or tempfile.mkdtemp(prefix='tableflow-')}/tableflow_{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and a function for their number that is to be asked after they were written, once and with no shuffle between: no scan of its own counts them."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("n")), lambda: seen.get.get("n") or 0


def write_files_of(df: DataFrame, path: str, rows: int, folders: int) -> int:
    """Parquet files of exactly so many rows each, the last one of the rest, dealt in turn over folders part=0, part=1 and on; how many folders there are.

    Rows are numbered by the sizes of the partitions before theirs, so no task gets more than some files; the plan has to give the
    same partitions each time, as a scan does.
    """
    number, at = (next(n for k in range(len(df.columns) + 1) if (n := f"_{what}{k}") not in df.columns) for what in ("number", "at"))
    placed = df.withColumns({at: F.spark_partition_id(), number: F.monotonically_increasing_id()})  # the low 33 bits count within the partition
    total, before = 0, []
    for r in placed.groupBy(at).agg(F.count("*").alias("n")).orderBy(at).collect():
        before.append((r[at], total))
        total += r["n"]
    parts = max(1, min(folders, -(-total // rows)))
    starts = F.broadcast(df.sparkSession.createDataFrame(before, f"{at} int, _before long"))
    file = F.expr(f"(_before + ({number} & {(1 << 33) - 1})) div {rows}")
    dealt = placed.join(starts, at).select(*df.columns, file.alias(number)).withColumn("part", (F.col(number) % parts).cast("int"))
    dealt.repartition(number).sortWithinPartitions("part", number).drop(number).write.option("maxRecordsPerFile", rows).partitionBy("part").parquet(path)
    return parts


def is_path(target: str) -> bool:
    return not target.startswith(("catalog:", "jdbc:", "versioned:"))


def in_types(df: DataFrame, target: DataFrame) -> DataFrame:
    """The columns that the target has too, in its types."""
    own = {f.name.lower(): f for f in target.schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(own[c.lower()].dataType).alias(own[c.lower()].name) for c in df.columns if c.lower() in own])


class Target:
    """Where a task writes: a folder of Parquet files, one with a log of versions, a table of the catalog, or one of a database."""

    def __init__(self, spark: SparkSession, name: str, options: dict[str, str] | None = None, evolve: bool = False):
        self.spark, self.name, self.options, self.evolve = spark, name, options or {}, evolve
        self.kind, self.table = ("versioned", name.removeprefix("versioned:")) if name.startswith("versioned:") else ("path", name) if is_path(name) else ("catalog", name.removeprefix("catalog:")) if name.startswith("catalog:") else ("jdbc", self.options["dbtable"])

    def versions(self):
        from .versioned import VersionedTable

        return VersionedTable(self.spark, self.table)

    def exists(self) -> bool:
        if self.kind == "versioned":
            return self.versions().exists()
        if self.kind == "path":
            return path_exists(self.spark, self.table)
        if self.kind == "catalog":
            return self.spark.catalog.tableExists(self.table)
        from .dbmerge import table_exists

        return table_exists(self.spark, self.name, self.options)

    def read(self) -> DataFrame:
        if self.kind == "versioned":
            return self.versions().read()
        if self.kind == "path":
            return merge_table(self.spark, self.table, self.evolve)
        return self.spark.table(self.table) if self.kind == "catalog" else self.spark.read.format("jdbc").options(url=self.name, **{k: v for k, v in self.options.items() if k != "staging_table"}).load()

    def write(self, df: DataFrame, spec, exists: bool, cursor: tuple | None = None) -> None:
        """One load in the task's mode. Columns are matched by name; new ones are added if the task says so. A versioned table takes the cursor into the same commit."""
        if spec.must_exist and not exists:
            raise FileNotFoundError(f"no table {self.name}")
        out = clustered(df, spec.cluster) if spec.cluster else df
        if self.kind == "versioned":
            table = self.versions()
            if spec.mode == "merge":
                table.merge(df, spec.merge_keys, spec.order_by or None, spec.schema_evolution, cursor)
            elif spec.mode == "append":
                table.append(df, spec.schema_evolution, cursor)
            else:
                table.replace(df, [n for n, _ in parse_order(spec.cluster)], cursor=cursor)
            return None if spec.mode == "merge" else table.rows_written
        if self.kind != "path" and spec.mode == "merge" and exists:
            from . import dbmerge

            if self.kind == "jdbc":
                dbmerge.merge_into_database(self.spark, self.name, self.options, df, spec.merge_keys, spec.order_by or None)
            else:
                dbmerge.merge_into_catalog(self.spark, self.table, df, spec.merge_keys, spec.order_by or None, spec.schema_evolution)
            return None
        if self.kind != "path" and spec.mode == "merge":
            out = one_row_per_key(out, [column_named(out, k) for k in spec.merge_keys], spec.order_by or None)
        if self.kind == "path" and spec.mode == "merge":
            merge_into(self.spark, self.table, df, spec.merge_keys, spec.order_by or None, evolve=spec.schema_evolution)
            return None
        out, written = counted(out)
        if self.kind == "jdbc":
            out.write.format("jdbc").options(url=self.name, **{k: v for k, v in self.options.items() if k != "staging_table"}).mode("append" if spec.mode == "append" else "overwrite").save()
        elif self.kind == "catalog":
            if spec.mode == "replace" and exists:  # the plan may read the table that it replaces
                staged = work_folder(self.spark)
                out.write.parquet(staged)
                self.spark.read.schema(out.schema).parquet(staged).write.mode("overwrite").saveAsTable(self.table)
                remove(self.spark, staged)
            elif not exists:
                out.write.saveAsTable(self.table)
            else:
                known = {c.lower() for c in self.spark.table(self.table).columns}
                more = [f for f in df.schema.fields if f.name.lower() not in known] if spec.schema_evolution else []
                if more:
                    self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
                evolve_append(self.spark.table(self.table).limit(0), out).select(*self.spark.table(self.table).columns).write.insertInto(self.table)
        else:
            if spec.mode == "append" and exists and spec.schema_evolution:
                out = evolve_append(self.read().limit(0), out)
            write_table(out, self.table, spec.mode)
        return written() if spec.mode != "merge" else None


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Of the rows of a key the last one in the given order, NULL being least; of equal ones that with the greatest hash.

    A maximum with partial results, so a key of very many rows is no single sort. Rows with a NULL key are a key of their own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    order = F.struct(*[F.col(f"`{column_named(df, c)}`") for c in order_by], row_hash(df))
    return df.groupBy(*[F.col(f"`{column_named(df, k)}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def _cast(c: Column, own: T.DataType, wanted: T.DataType, name: str) -> Column:
    """The value in the target's type; one that does not fit stops the job instead of becoming NULL."""
    if own == wanted:
        return c
    made = c.try_cast(wanted)
    return F.when(c.isNotNull() & made.isNull(), F.raise_error(F.concat(F.lit(f"{name} does not fit {wanted.simpleString()}: "), c.cast("string")))).otherwise(made)


def _checked(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The source's columns that the target has, in its order and types."""
    if not keys:
        raise ValueError("a merge needs keys")
    for k in keys:
        column_named(target, k), column_named(source, k)
    own = {f.name.lower(): f for f in source.schema.fields}
    both = [(own[f.name.lower()], f) for f in target.schema.fields if f.name.lower() in own]
    return source.select(*[_cast(F.col(f"`{a.name}`"), a.dataType, b.dataType, b.name).alias(b.name) for a, b in both])


def one_row_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    """The row of each key that a merge takes: the last by order_by, without an order the one with the greatest hash. Keys with a NULL are not compared."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(f"`{k}`").isNull()
    return latest_per_key(df.where(~some_null), keys, order_by or []).unionByName(df.where(some_null))


def _some_null(keys: list[str]) -> Column:
    return F.greatest(F.lit(False), *[F.col(f"`{k}`").isNull() for k in keys])


def not_held(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, but of those with a NULL in their key only as many as the target does not hold."""
    keys = [column_named(rows, k) for k in keys]
    if not any(rows.schema[k].nullable for k in keys):
        return rows
    without = rows.where(_some_null(keys))
    own = without.groupBy(row_md5(rows).alias("_h")).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("_row"), F.count("*").alias("_n"))
    held = target.where(_some_null(keys)).select(*[F.col(f"`{column_named(target, c)}`").alias(c) for c in rows.columns])
    held = held.groupBy(row_md5(held).alias("_h")).agg(F.count("*").alias("_m"))
    lacking = own.join(held, "_h", "left").withColumn("_n", F.col("_n") - F.coalesce("_m", F.lit(0))).where("_n > 0")
    return rows.where(~_some_null(keys)).unionByName(lacking.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_row.*"))


def merge(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The target after an upsert: rows of the source win by key, the last of them by order_by; the rest of the target stays.

    The source takes the target's types. Columns that it lacks keep their values in rows it updates and are NULL in new ones.
    Rows with a NULL in their key match no key; they are inserted as often as the target does not hold them already, so a
    merge that is repeated adds none. A source of key columns alone changes no row.
    """
    more = [c for c in order_by or [] if c.lower() not in {x.lower() for x in target.columns}]
    new = _checked(target, source, keys) if not more else _checked(target.select("*", *[F.lit(None).cast(source.schema[column_named(source, c)].dataType).alias(c) for c in more]), source, keys)
    new = not_held(target, one_row_per_key(new, [column_named(target, k) for k in keys], order_by).drop(*more), keys)
    kept = target.join(new.select(*keys), keys, "left_anti")
    lacking = [c for c in target.columns if c not in new.columns]
    if lacking:
        new = new.join(target.select(*keys, *lacking), keys, "left").select(*target.columns)
    return kept.select(*target.columns).unionByName(new)


def merge_newest(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """A merge in which a row of the source that is older than the target's, by order_by, changes nothing; NULL is oldest, of equals the source's wins."""
    own = [column_named(target, k) for k in keys]
    typed = _checked(target, source, keys)
    lacked = not_held(target, typed.where(_some_null(own)), own)
    return upsert_newest(target, typed.where(~_some_null(own)), own, order_by).unionByName(lacked, allowMissingColumns=True)


def upsert_newest(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """merge_newest for a source without NULL in its keys. Both tables are read once: their rows meet by key in one shuffle, with no join."""
    own, order = [column_named(target, k) for k in keys], [column_named(target, c) for c in order_by]
    new = latest_per_key(_checked(target, source, keys), own, order)
    is_new, dealt, held_age, new_age, row = (next(n for k in range(len(target.columns) + 1) if (n := f"_{what}{k}") not in target.columns) for what in ("new", "dealt", "held", "age", "row"))
    # the target's rows without a key meet nothing, so they need not be in one task
    held = target.withColumns({is_new: F.lit(False), dealt: F.when(_some_null(own), F.spark_partition_id())})
    both = held.unionByName(new.withColumns({is_new: F.lit(True), dealt: F.lit(None).cast("int")}), allowMissingColumns=True)
    group, age = Window.partitionBy(*[F.col(f"`{k}`") for k in own], dealt), F.struct(*[F.col(f"`{c}`") for c in order])
    ages = {held_age: F.min(F.when(~F.col(is_new), age)).over(group), new_age: F.max(F.when(F.col(is_new), age)).over(group)}
    wins = F.col(new_age).isNotNull() & (F.col(held_age).isNull() | (F.col(new_age) >= F.col(held_age)))
    if len(new.columns) == len(target.columns):
        return both.withColumns(ages).where(F.col(is_new) == wins).select(*target.columns)
    # columns that the source lacks keep their values
    ages[row] = F.first(F.when(F.col(is_new), F.struct(*[F.col(f"`{c}`") for c in new.columns])), ignorenulls=True).over(group)
    taken = [F.when(wins & ~F.col(is_new), F.col(f"{row}.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in new.columns else F.col(f"`{c}`") for c in target.columns]
    return both.withColumns(ages).where(~F.col(is_new) | F.col(held_age).isNull()).select(*taken)


def merge_changes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The keys with what a merge would do: insert, update, unchanged or keep. Rows without a key that the target holds already are kept ones."""
    keys = [column_named(target, k) for k in keys]
    new = not_held(target, one_row_per_key(_checked(target, source, keys), keys, None), keys)
    values = [c for c in new.columns if c not in keys]
    a = target.select(*[F.col(f"`{k}`").alias(f"_t{i}") for i, k in enumerate(keys)], F.struct(*([F.col(f"`{c}`") for c in values] or [F.lit(1).alias("x")])).alias("_old"))
    b = new.select(*keys, F.struct(*([F.col(f"`{c}`") for c in values] or [F.lit(1).alias("x")])).alias("_new"))
    joined = b.join(a, all_equal([F.col(f"`{k}`") == F.col(f"_t{i}") for i, k in enumerate(keys)]), "full")
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "keep").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("update")
    return joined.select(*[F.coalesce(F.col(f"`{k}`"), F.col(f"_t{i}")).alias(k) for i, k in enumerate(keys)], action.alias("action"))


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


#: Bytes of a table for which a new one gets one folder of keys, and the least number of them.
FOLDER_BYTES, FOLDERS = 1 << 30, 64
#: Beside the folders: how many there are and the table's schema. Spark's readers skip names that start so.
_ABOUT = "_merge_table.json"


def merge_table(spark: SparkSession, path: str, evolve: bool = False) -> DataFrame:
    """A table kept by merge_into, with the columns of all its merges; a plain table as it is, with evolve the columns of all its files."""
    about = _about(spark, path)
    if about is None:
        return spark.read.option("mergeSchema", evolve).parquet(path)
    return spark.read.schema(T.StructType.fromJson(about["schema"]).add("key_bucket", T.IntegerType())).parquet(path).drop("key_bucket")


def _about(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{_ABOUT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put_about(spark: SparkSession, path: str, about: dict) -> None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/{_ABOUT}")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(about).encode()))
    out.close()


def _in_folders(df: DataFrame, keys: list[str], buckets: int, path: str) -> None:
    """Write the rows into folders by key; Spark evens out the files, so a large folder has several."""
    df.withColumn("key_bucket", bucket_of(keys, buckets)).hint("rebalance", "key_bucket").write.partitionBy("key_bucket").parquet(path)


def _restored(spark: SparkSession, path: str) -> None:
    """Put back folders that a run moved aside and died before it replaced."""
    fs, p = _fs(spark, path)
    for aside in fs.globStatus(_fs(spark, f"{path.rstrip('/')}/_old_*")[1]) or []:
        for folder in fs.listStatus(aside.getPath()):
            home = _fs(spark, f"{path.rstrip('/')}/{folder.getPath().getName()}")[1]
            if not fs.exists(home):
                fs.rename(folder.getPath(), home)
        fs.delete(aside.getPath(), True)


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: list[str], order_by: list[str] | None = None, buckets: int | None = None, evolve: bool = False) -> None:
    """Upsert into a Parquet table kept in folders by a hash of the key: only folders the source touches are written again.

    The source takes the table's types; a value that does not fit stops the merge before anything changes. The number of
    folders is fixed when the table is made (by its size, if not given), kept beside it, and another one is refused. evolve
    adds the source's new columns, NULL in older rows; otherwise they are left out. A plain Parquet table is dealt into
    folders by its first merge.

    Merged folders are staged, then take the places of the old ones one by one; folders that a dead run moved aside are
    put back by the next, and a merge that is run again gives the same table. Of several rows of a key see one_row_per_key.
    """
    if not keys:
        raise ValueError("a merge needs keys")
    path = path.rstrip("/")
    staged = f"{path}_staging_{uuid.uuid4().hex}"
    fs, place = _fs(spark, path)
    if fs.exists(place):
        _restored(spark, path)
    about = _about(spark, path) if fs.exists(place) else None
    if about is None:
        rows = spark.read.parquet(path) if fs.exists(place) else None
        if rows is not None and "key_bucket" in rows.columns:
            raise ValueError(f"{path} has folders of keys, but nothing says how many there should be")
        merged = one_row_per_key(source, [column_named(source, k) for k in keys], order_by) if rows is None else merge(*_evolved(rows, source, evolve), keys, order_by)
        size = int(str(merged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        buckets = buckets or max(FOLDERS, min(1 << 16, -(-size // FOLDER_BYTES) if size < 1 << 60 else 0))
        _in_folders(merged, [column_named(merged, k) for k in keys], buckets, staged)
        _put_about(spark, staged, {"buckets": buckets, "keys": [column_named(merged, k) for k in keys], "schema": merged.schema.jsonValue()})
        _swap(spark, staged, path)
        return
    if buckets not in (None, about["buckets"]):
        raise ValueError(f"{path} has {about['buckets']} folders of keys, not {buckets}")
    if sorted(k.lower() for k in keys) != sorted(k.lower() for k in about["keys"]):
        raise ValueError(f"{path} is dealt by {', '.join(about['keys'])}")
    buckets, keys = about["buckets"], about["keys"]
    schema = T.StructType.fromJson(about["schema"])
    table = spark.read.schema(T.StructType(schema.fields).add("key_bucket", T.IntegerType())).parquet(path)
    old, new = _evolved(table, source, evolve)
    columns = [c for c in old.columns if c != "key_bucket"]
    keyed = _checked(old.select(*keys), source, keys)
    # the numbers of folders come to the driver: as many as there are at most
    touched = sorted(r[0] for r in keyed.select(bucket_of(keys, buckets)).distinct().collect())
    merged = merge(old.where(F.col("key_bucket").isin(touched)).select(*columns), new, keys, order_by)
    _in_folders(merged, keys, buckets, staged)
    fresh, _ = _fs(spark, staged)
    made = {f.getPath().getName() for f in fresh.listStatus(_fs(spark, staged)[1]) if f.isDirectory()}
    if not made <= {f"key_bucket={b}" for b in touched}:
        raise RuntimeError("merged rows belong to folders that were not read")
    if merged.columns != [f.name for f in schema.fields]:
        _put_about(spark, path, about | {"schema": merged.schema.jsonValue()})  # before the rows: readers see NULL until then
    aside = f"{path}/_old_{uuid.uuid4().hex}"
    fs.mkdirs(_fs(spark, aside)[1])
    for name in sorted(made):
        home = _fs(spark, f"{path}/{name}")[1]
        if fs.exists(home) and not fs.rename(home, _fs(spark, f"{aside}/{name}")[1]):
            raise OSError(f"cannot move {home} aside")
        if not fs.rename(_fs(spark, f"{staged}/{name}")[1], home):
            raise OSError(f"cannot put {name} in place")
    fs.delete(_fs(spark, aside)[1], True)
    fs.delete(_fs(spark, staged)[1], True)


def _evolved(table: DataFrame, source: DataFrame, evolve: bool) -> tuple[DataFrame, DataFrame]:
    """Both with the source's new columns, if they are to be added."""
    known = {c.lower() for c in table.columns}
    more = [f for f in source.schema.fields if f.name.lower() not in known] if evolve else []
    return table.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more}) if more else table, source


def inserted_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> int:
    """By how many rows a merge will make the target grow: keys that it lacks, and rows with a NULL in their key that it does not hold."""
    new = not_held(target, one_row_per_key(_checked(target, source, keys), [column_named(target, k) for k in keys], None), keys)
    return new.select(*keys).join(target.select(*keys), keys, "left_anti").count()


def evolve_append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Both tables' rows; columns that one lacks are NULL in it. Names match without regard to case, types do not change."""
    own = {c.lower(): c for c in target.columns}
    renamed = source.select(*[F.col(f"`{c}`").alias(own.get(c.lower(), c)) for c in source.columns])
    return target.unionByName(renamed, allowMissingColumns=True)


def append_union(frames: list[DataFrame]) -> DataFrame:
    """Several tasks that append to one table."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


#: What the text-only profile and those without Booleans store.
PROFILES = {
    "sqlite": {"boolean": "long", "time": "text", "decimal": "number"},
    "mysql": {"boolean": "long", "time": "timestamp", "decimal": "decimal"},
    "postgres": {"boolean": "boolean", "time": "timestamp", "decimal": "decimal"},
    "sqlserver": {"boolean": "boolean", "time": "timestamp", "decimal": "decimal"},
    "oracle": {"boolean": "long", "time": "timestamp", "decimal": "decimal"},
    "duckdb": {"boolean": "boolean", "time": "timestamp", "decimal": "decimal"},
}


def conform_types(df: DataFrame, profile: str) -> DataFrame:
    """Every column as the given kind of target would store it, in one projection."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile: {profile}")
    rules = PROFILES[profile]
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.IntegralType):
            c = c.cast("long")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double" if t.scale else "long") if rules["decimal"] == "number" else c
        elif isinstance(t, T.FractionalType):
            c = c.cast("double")
        elif isinstance(t, T.BooleanType):
            c = c.cast(rules["boolean"]) if rules["boolean"] == "boolean" else c.cast("int").cast("long")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if rules["time"] == "text" else c.cast("timestamp_ntz" if isinstance(t, T.TimestampNTZType) else "timestamp")
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif not isinstance(t, (T.StringType, T.BinaryType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def parse_order(specs: list[str]) -> list[tuple[str, bool]]:
    """Columns with their direction (true: ascending) from name, name:ASC, name:DESC, name:1 or name:-1."""
    out = []
    for spec in specs:
        name, _, way = spec.partition(":")
        if way.strip().upper() not in ("", "ASC", "DESC", "1", "-1"):
            raise ValueError(f"unknown direction in {spec}")
        out.append((name.strip(), way.strip().upper() not in ("DESC", "-1")))
    return out


def curve_columns(specs: list[str]) -> list[str]:
    """The columns of an order written as hilbert(a, b); none for another order."""
    if len(specs) == 1 and specs[0].strip().lower().startswith("hilbert(") and specs[0].strip().endswith(")"):
        return [c.strip() for c in specs[0].strip()[len("hilbert(") : -1].split(",")]
    return []


def clustered(df: DataFrame, specs: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of the columns and sorted within them, so files of the written table can be skipped.

    A single ``hilbert(a, b)`` instead of names orders by all its columns alike, along a space-filling curve.
    """
    if curve := curve_columns(specs):
        return curve_ordered(df, curve, partitions)
    order = [F.col(n).asc() if up else F.col(n).desc() for n, up in parse_order(specs)]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)
