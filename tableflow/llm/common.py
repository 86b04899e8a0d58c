"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that a function gets at a time. Spark's own Arrow batches end at 64 MB; working copies of texts are larger.
SLICE_ROWS, SLICE_BYTES = 1000, 4 << 20
#: Bytes of input for which an operator asks for one shuffle partition, beside the session's number.
PARTITION_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A job whose session hands rows to Python a thousand at a time. Operators leave settings alone; whoever runs them chooses."""

    @functools.wraps(job)
    def run(spark: SparkSession, *more) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SLICE_ROWS))
        return job(spark, *more)

    return run


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator needs, as ``doc_id`` and ``text``; other columns of the input cannot clash. A missing id stays NULL."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c) for c in more])


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many rows and bytes, but of one row at least."""
    held = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
            held += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(held), 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = min(at + rows, max(at + 1, full), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of an Arrow column; null counts as empty, bytes that are not UTF-8 are replaced."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        return [(x or b"").decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the machine. Arrow's pool and the C library keep it otherwise, and a Python worker lives on through later stages."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # glibc has it
        trim(0)


def releasing(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow whose task gives back, after its last batch, what it no longer needs."""

    @functools.wraps(fn)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """Apply fn to each slice of each Arrow batch; it returns the columns of the result, or None for no rows."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = arrow_types(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := fn(part)) is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[n], types[n]) for n in names], names)

    return df.mapInArrow(releasing(run), schema)


def arrow_types(schema: str) -> dict[str, pa.DataType]:
    known = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
    }
    return {f.split()[0]: known[f.split()[1]] for f in schema.split(", ")}


def record(columns: dict, schema: str) -> pa.RecordBatch:
    types = arrow_types(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in types.items()], list(types))


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that all machines share: the session's. Where none is named, a session in one process gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("name a folder that all machines share in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_side(ids: DataFrame, rows: int = 250_000) -> DataFrame:
    """A saved list of ids for a join with texts: broadcast while it has so few rows, else hashed after a shuffle, never sorted."""
    ids = saved(ids)
    return F.broadcast(ids) if ids.count() <= rows else ids.hint("shuffle_hash")


def partitions(spark: SparkSession, size: int = 0, each: int = PARTITION_BYTES) -> int:
    """The session's number of shuffle partitions, or more where so many bytes need them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


#: Rows of one key that a join leaves in one task, at least.
HOT_ROWS = 200


def frequent(counts: DataFrame, key: str, total: int) -> list[tuple]:
    """The keys that one task should not take alone, and over how many to deal each; counts (key, n) says how many of so many rows a key has.

    A key is frequent from a quarter of a task's even share on, so the list has four keys for each shuffle partition at most.
    """
    even = max(HOT_ROWS, total // (4 * partitions(counts.sparkSession)))
    return [(r[0], -(-r[1] // even)) for r in counts.where(F.col("n") > even).select(key, "n").collect()]


def spread_join(big: DataFrame, small: DataFrame, key: str, hot: list[tuple], how: str) -> DataFrame:
    """big joined with small (one row a key), where the rows of frequent keys are dealt over several tasks."""
    if not hot:
        return big.join(small, key, how)
    kind = small.schema[key].dataType.simpleString()
    parts = F.broadcast(big.sparkSession.createDataFrame(hot, f"`{key}` {kind}, _parts int"))
    others = [F.col(f"`{c}`") for c in big.columns if c != key]
    dealt = big.join(parts, key, "left").withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*others), F.col("_parts")).cast("int"))).drop("_parts")
    each = small.join(parts, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    return dealt.join(each, [key, "_part"], how).drop("_part")


def surviving(docs: DataFrame, groups: DataFrame, text_key: Column, id_col: str) -> DataFrame:
    """The rows of docs, with all their columns, but for those that do not stay; of rows repeated as a whole one stays.

    groups (doc_id, text_key, stays) has every row of docs that belongs to a group of copies; a row is known by its id and
    the key of its text, as an id may have several texts.
    """
    own_id, own_key = (next(n for k in range(len(docs.columns) + 1) if (n := f"_{what}{k}") not in docs.columns) for what in ("id", "key"))
    pairs = saved(groups.groupBy(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).agg(F.max("stays").alias("_stays"), F.count("*").alias("_n")))

    def same(side: DataFrame) -> Column:
        return F.col(f"`{id_col}`").cast("long").eqNullSafe(side[own_id]) & (text_key == side[own_key])

    gone = small_side(pairs.where("not _stays").select(own_id, own_key))
    left = docs.join(gone, same(gone), "left_anti")
    again = pairs.where("_stays and _n > 1").select(own_id, own_key)
    if again.isEmpty():
        return left
    again = small_side(again)
    one = left.join(again, same(again)).groupBy(own_id, own_key).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row")).select("_row.*")
    return left.join(again, same(again), "left_anti").unionByName(one)
