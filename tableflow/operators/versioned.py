"""Tables with a log of versions and an index of keys.

A table is a folder of Parquet files and a log of small JSON entries, one a commit: which files it adds and takes away, the
schema, and the cursors of the loads it finishes. An entry is put in place by one create-if-absent, so a commit happens whole
or not at all, and of two writers that read the same version one loses and looks again. Readers read the files of one
version and never see half a commit. Files are never changed, and go only with vacuum.

A table with keys has, for each file, the bounds of its first key column and a Bloom filter of all keys. A merge asks them
which files may hold a key of the source, reads the key columns of those, and rewrites only files that do hold one.
"""

from __future__ import annotations

import bisect
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import write
from .project import column_named

#: Commits between two entries that list all files.
FULL = 20
#: Rows of a file at most, and so keys of one Bloom filter.
FILE_ROWS = 2_000_000
#: Source keys that are sent to all tasks to ask the filters; for more of them the key columns of all files are read.
ASKED = 20_000
#: Bits a key and look-ups of a Bloom filter: about one wrong answer in a hundred.
BITS, LOOKUPS = 10, 7
#: Times that a writer that lost looks again.
TRIES = 20


class Conflict(RuntimeError):
    """Another writer has committed the version that this one wanted."""


class StaleCursor(RuntimeError):
    """The load that a commit would finish has been finished by another one."""


@dataclass(frozen=True)
class Snapshot:
    """A version: its files, the folders of their index, schema, keys and cursors."""

    version: int = -1
    schema: dict | None = None
    files: tuple[str, ...] = ()
    index: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    cursors: dict[str, str] = field(default_factory=dict)


def _next(s: Snapshot, entry: dict) -> Snapshot:
    if "files" in entry:
        files, index = entry["files"], entry["indexes"]
    else:
        gone = set(entry["remove"])
        files = [f for f in s.files if f not in gone] + entry["add"]
        index = [*s.index, *entry["index"]] if files else []
    return Snapshot(entry["version"], entry["schema"], tuple(files), tuple(index), tuple(entry["keys"]), s.cursors | entry["cursors"])


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of 64-bit hashes; its size follows their number."""
    bits = np.zeros(max(64, -(-BITS * len(hashes) // 8) * 8), bool)
    bits[_places(hashes, len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def _places(hashes: np.ndarray, m: int) -> np.ndarray:
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(33)) | np.uint64(1)
    return ((h[:, None] + np.arange(LOOKUPS, dtype=np.uint64) * step[:, None]) % np.uint64(m)).astype(np.int64)


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(filter_, np.uint8)).astype(bool)
    return bits[_places(hashes, len(bits))].all(axis=1)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self.log = write._fs(spark, f"{self.path}/_log")

    # --- the log

    def _name(self, version: int):
        return write._fs(self.spark, f"{self.path}/_log/{version:020d}.json")[1]

    def _versions(self) -> list[int]:
        if not self.fs.exists(self.log):
            return []
        return sorted(int(f.getPath().getName()[:20]) for f in self.fs.listStatus(self.log) if f.getPath().getName().endswith(".json"))

    def _entry(self, version: int) -> dict:
        stream = self.fs.open(self._name(version))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self._versions())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the one asked for."""
        versions = self._versions()
        if not versions and version is None:
            return Snapshot()
        version = versions[-1] if version is None else version
        if version not in versions:
            raise ValueError(f"{self.path} has no version {version}")
        entries: list[dict] = []
        for v in range(version, -1, -1):
            entries.append(self._entry(v))
            if "files" in entries[-1]:
                break
        out = Snapshot()
        for e in reversed(entries):
            out = _next(out, e)
        return out

    def history(self) -> DataFrame:
        """version, operation, written_at, added, removed: a row for each entry of the log."""
        rows = [(e["version"], e["operation"], e["written_at"], len(e["add"]), len(e["remove"])) for e in map(self._entry, self._versions())]
        return self.spark.createDataFrame(rows, "version long, operation string, written_at double, added long, removed long")

    def _commit(self, base: Snapshot, operation: str, schema: dict, add: list[str], remove: list[str], index: list[str], keys: tuple[str, ...], cursors: dict[str, str]) -> Snapshot:
        """The next version, if nobody else has made it."""
        version = base.version + 1
        entry = {"version": version, "operation": operation, "written_at": time.time(), "schema": schema, "add": add, "remove": remove, "index": index, "keys": list(keys), "cursors": cursors}
        after = _next(base, entry)
        if version % FULL == 0:
            entry |= {"files": list(after.files), "indexes": list(after.index), "cursors": after.cursors}
        self.fs.mkdirs(self.log)
        draft = write._fs(self.spark, f"{self.path}/_log/.draft_{uuid.uuid4().hex}")[1]
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        try:
            if not self._placed(draft, self._name(version)):
                raise Conflict(f"{self.path}: version {version} is there already")
        finally:
            self.fs.delete(draft, False)
        return after

    def _placed(self, draft, place) -> bool:
        """Give a finished file its name, unless the name is taken; one step of the file system that only one writer can win."""
        jvm = self.spark.sparkContext._jvm
        try:
            if self.fs.getScheme() == "file":
                at = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(at(place), at(draft))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                never = self.spark.sparkContext._gateway.new_array(rename, 1)
                never[0] = rename.NONE
                context.rename(draft, place, never)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        return True

    # --- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version; later commits do not change what it reads."""
        return self._rows(self.snapshot(version))

    def _rows(self, s: Snapshot, files: list[str] | None = None) -> DataFrame:
        if s.schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema, paths = T.StructType.fromJson(s.schema), list(s.files if files is None else files)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def cursor(self, name: str, default: Any = None) -> Any:
        return self.snapshot().cursors.get(name, default)

    # --- writing

    def _files(self, df: DataFrame, keys: tuple[str, ...] | list[str], parts: int | None = None) -> tuple[list[str], list[str]]:
        """Write rows as new files, in ranges of the keys; the files, and the folder of their index. rows_written says how many there were."""
        folder = f"data_{uuid.uuid4().hex}"
        if keys:
            order = [F.col(f"`{k}`") for k in keys]
            # for one file there is no range to be sampled, which would run the plan once more
            df = (df.repartition(1) if parts == 1 else df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)).sortWithinPartitions(*order)
        df, written = write.counted(df)
        df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{self.path}/{folder}")
        self.rows_written = written()
        place = write._fs(self.spark, f"{self.path}/{folder}")[1]
        files = sorted(f"{folder}/{f.getPath().getName()}" for f in self.fs.listStatus(place) if f.getPath().getName().startswith("part-"))
        if not keys or not files:
            return files, []
        self._index(df.schema, folder, keys, len(files)).write.parquet(f"{self.path}/_index/{folder}")
        return files, [f"_index/{folder}"]

    def _index(self, schema: T.StructType, folder: str, keys: tuple[str, ...] | list[str], files: int) -> DataFrame:
        """file, low, high, null_keys, filter: a row for each file of a folder, from its key columns alone."""
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").select(_file().alias("file"), F.col(f"`{keys[0]}`").alias("first"), _key_hash(schema, keys).alias("hash"))
        bounds = rows.groupBy("file").agg(F.min("first").alias("low"), F.max("first").alias("high"), F.count_if(F.col("hash").isNull()).alias("null_keys"))
        # so few bytes a row that whole files would otherwise be put together in a task
        made = rows.where("hash is not null").repartition(4 * files, "file").groupBy("file").applyInPandas(lambda p: pd.DataFrame({"file": p["file"].iloc[:1], "filter": [bloom(p["hash"].to_numpy(np.int64))]}), "file string, filter binary")  # a file's rows are bounded
        return bounds.join(made, "file", "left").withColumn("file", F.concat(F.lit(f"{folder}/"), "file"))

    def _again(self, step: Callable[[Snapshot], Snapshot]) -> Snapshot:
        """A step from the newest version, until it is the one that commits."""
        for _ in range(TRIES):
            try:
                return step(self.snapshot())
            except Conflict:
                time.sleep(0.05 * np.random.default_rng().random())
        raise Conflict(f"{self.path}: {TRIES} times another writer was first")

    @staticmethod
    def _finishes(s: Snapshot, cursor: tuple[str, Any, Any] | None) -> dict[str, str]:
        """The cursors that a commit sets: (name, value it must still have, new value)."""
        if cursor is None:
            return {}
        name, was, now = cursor
        if s.cursors.get(name) != (None if was is None else str(was)):
            raise StaleCursor(f"{name} is at {s.cursors.get(name)}, not at {was}")
        return {name: str(now)}

    def replace(self, df: DataFrame, keys: list[str] | None = None, parts: int | None = None, cursor: tuple[str, Any, Any] | None = None) -> Snapshot:
        """All rows anew, in ranges of the keys if there are any; the plan may read this very table."""
        named = tuple(column_named(df, k) for k in keys or [])
        files, index = self._files(df, named, parts)

        def step(s: Snapshot) -> Snapshot:
            return self._commit(s, "replace", df.schema.jsonValue(), files, list(s.files), index, named, self._finishes(s, cursor))

        return self._again(step)

    def append(self, df: DataFrame, evolve: bool = False, cursor: tuple[str, Any, Any] | None = None) -> Snapshot:
        """More rows, written once, whoever else commits meanwhile. With a cursor the commit is refused (StaleCursor) if the cursor is not where it was."""
        first = self.snapshot()
        if first.schema is None:
            return self.replace(df, cursor=cursor)
        self._finishes(first, cursor)
        table = self.spark.createDataFrame([], T.StructType.fromJson(first.schema))
        rows = write.evolve_append(table, df if evolve else df.select(*[c for c in df.columns if c.lower() in {x.lower() for x in table.columns}]))
        files, index = self._files(rows, first.keys)

        def step(s: Snapshot) -> Snapshot:
            known = T.StructType.fromJson(s.schema)
            more = [f for f in rows.schema.fields if f.name not in known.names]
            return self._commit(s, "append", T.StructType([*known.fields, *more]).jsonValue(), files, [], index, s.keys, self._finishes(s, cursor))

        return self._again(step)

    def merge(self, source: DataFrame, keys: list[str], order_by: list[str] | None = None, evolve: bool = False, cursor: tuple[str, Any, Any] | None = None, newest: bool = False) -> Snapshot:
        """Upsert by key (see write.merge): only files that hold a key of the source are written anew, new keys go with them.

        The source is read several times; stage what is costly to make. newest compares with the table's rows by order_by, too: an older row changes nothing (see write.merge_newest).
        """

        def step(s: Snapshot) -> Snapshot:
            done = self._finishes(s, cursor)
            if s.schema is None:
                return self._first(write.one_row_per_key(source, [column_named(source, k) for k in keys], order_by), keys, s, done)
            old, new = write._evolved(self._rows(s), source, evolve)
            own = [column_named(old, k) for k in keys]
            if s.keys and sorted(own) != sorted(s.keys):
                raise ValueError(f"{self.path} has the keys {', '.join(s.keys)}")
            typed = write._checked(old.select(*own), source, own)
            counts = typed.agg(F.count("*").alias("n"), F.count_if(write._some_null(own)).alias("nulls")).first()
            touched = self.touched(s, typed, counts["n"])
            keyed = new.where(~write._some_null([column_named(new, k) for k in keys]))
            part = write._evolved(self._rows(s, touched), source, evolve)[0]
            merged = write.upsert_newest(part, keyed, own, order_by or []) if newest else write.merge(part, keyed, own, order_by)
            if counts["nulls"]:
                holding = self._rows(s, self._with_null_keys(s))
                without = write._checked(old, new.where(write._some_null([column_named(new, k) for k in keys])), own)
                merged = merged.unionByName(write.not_held(write._evolved(holding, source, evolve)[0], without, own), allowMissingColumns=True)
            named = tuple(s.keys or own)
            files, index = self._files(merged, named, max(1, len(touched)))
            return self._commit(s, "merge", merged.schema.jsonValue(), files, touched, index, named, done)

        return self._again(step)

    def delete_where(self, condition: Column, operation: str = "delete") -> Snapshot:
        """Rows for which the condition holds go: files that have one are written anew without it, the others stay."""

        def step(s: Snapshot) -> Snapshot:
            found = self._rows(s).where(condition).select(F.col("_metadata.file_path").alias("_file")).distinct().collect()  # a row for each file at most
            return self._without(s, [r[0] for r in found], lambda rows: rows.where(~F.coalesce(condition, F.lit(False))), operation)

        return self._again(step)

    def delete_keys(self, gone: DataFrame, keys: list[str]) -> Snapshot:
        """Rows with one of the keys go; only files that hold one are written anew."""

        def step(s: Snapshot) -> Snapshot:
            own = [column_named(self._rows(s), k) for k in keys]
            typed = write._checked(self._rows(s).select(*own), gone, own).dropna().distinct()
            return self._without(s, self.touched(s, typed), lambda rows: rows.join(typed, own, "left_anti").select(*rows.columns), "delete")

        return self._again(step)

    def _without(self, s: Snapshot, paths: list[str], left: Callable[[DataFrame], DataFrame], operation: str) -> Snapshot:
        by_name = {f.rsplit("/", 1)[1]: f for f in s.files}
        touched = sorted(by_name[p.rsplit("/", 1)[1]] for p in paths)
        files, index = self._files(left(self._rows(s, touched)), s.keys, max(1, len(touched))) if touched else ([], [])
        return self._commit(s, operation, s.schema, files, touched, index, s.keys, {})

    def _first(self, rows: DataFrame, keys: list[str], s: Snapshot, done: dict[str, str]) -> Snapshot:
        own = tuple(column_named(rows, k) for k in keys)
        files, index = self._files(rows, own)
        return self._commit(s, "merge", rows.schema.jsonValue(), files, [], index, own, done)

    # --- which files

    def _indexed(self, s: Snapshot) -> DataFrame | None:
        """The index of the version's files; None where files have none."""
        if not s.keys or not s.index:
            return None
        here = self.spark.createDataFrame([(f,) for f in s.files], "file string")
        return self.spark.read.parquet(*[f"{self.path}/{i}" for i in s.index]).join(here, "file", "left_semi")

    def _with_null_keys(self, s: Snapshot) -> list[str]:
        index = self._indexed(s)
        return list(s.files) if index is None else sorted(r["file"] for r in index.where("null_keys > 0").select("file").collect())

    def candidates(self, s: Snapshot, keys: DataFrame) -> list[str]:
        """Files whose bounds and filter allow a key; keys are few, in the table's types and without NULL."""
        index = self._indexed(s)
        if index is None:
            return list(s.files)
        schema = T.StructType.fromJson(s.schema)
        asked = keys.select(F.col(f"`{s.keys[0]}`").alias("first"), _key_hash(schema, s.keys).alias("hash")).distinct().toArrow()
        order = sorted(range(asked.num_rows), key=lambda i: asked["first"][i].as_py())
        first, hashes = [asked["first"][i].as_py() for i in order], asked["hash"].to_numpy()[order] if order else np.zeros(0, np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = []
                for file, low, high, made in zip(*(b.column(c).to_pylist() for c in ("file", "low", "high", "filter")), strict=True):
                    if low is None or made is None:
                        continue
                    a, z = bisect.bisect_left(first, low), bisect.bisect_right(first, high)
                    if a < z and may_hold(made, hashes[a:z]).any():
                        found.append(file)
                yield pa.RecordBatch.from_pydict({"file": pa.array(found, pa.string())})

        return sorted(r["file"] for r in index.select("file", "low", "high", "filter").mapInArrow(run, "file string").collect())

    def touched(self, s: Snapshot, keys: DataFrame, n: int | None = None) -> list[str]:
        """Files that hold one of the keys (n at most, if that is known): the index says which may, their key columns say which do."""
        named = list(keys.columns)
        wanted = keys.dropna().distinct()
        few = n is not None and n <= ASKED or wanted.limit(ASKED + 1).count() <= ASKED
        files = self.candidates(s, wanted.select(*[F.col(f"`{k}`") for k in (s.keys or named)])) if few else list(s.files)
        if not files:
            return []
        held = self._rows(s, files).select(*named, F.col("_metadata.file_path").alias("_file"))
        found = held.join(F.broadcast(wanted) if few else wanted, named, "left_semi").select("_file").distinct()
        by_name = {f.rsplit("/", 1)[1]: f for f in files}
        return sorted(by_name[r[0].rsplit("/", 1)[1]] for r in found.collect())

    def vacuum(self, keep: int = 10, older_s: float = 7 * 86400) -> int:
        """Delete files that none of the last versions has and that are old enough for no reader or writer to be at them. How many."""
        versions = self._versions()[-keep:]
        used = {f for v in versions for f in self.snapshot(v).files} | {i for v in versions for i in self.snapshot(v).index}
        before, gone = (time.time() - older_s) * 1000, 0
        for pattern in ("data_*", "_index/data_*"):
            for folder in self.fs.globStatus(write._fs(self.spark, f"{self.path}/{pattern}")[1]) or []:
                name = ("_index/" if pattern.startswith("_index") else "") + folder.getPath().getName()
                if name in used:
                    continue
                for f in self.fs.listStatus(folder.getPath()):
                    if f"{name}/{f.getPath().getName()}" not in used and f.getModificationTime() < before:
                        self.fs.delete(f.getPath(), False)
                        gone += f.getPath().getName().startswith("part-")
                if not [f for f in self.fs.listStatus(folder.getPath()) if not f.getPath().getName().startswith((".", "_"))] and folder.getModificationTime() < before:
                    self.fs.delete(folder.getPath(), True)
        return gone


def _file() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def _key_hash(schema: T.StructType, keys: tuple[str, ...] | list[str]) -> Column:
    """A hash of the whole key; NULL where a part of it is."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    return F.when(known, F.xxhash64(*[F.col(f"`{k}`").cast(schema[k].dataType) for k in keys]))
