"""Rows that cannot be loaded: found by predicates before the write, kept with their reason, and read back."""

from __future__ import annotations

import multiprocessing
import os
import pickle
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import canon_of
from .project import column_named


def split_loadable(df: DataFrame, schema: T.StructType, keys: list[str] | None = None, target: DataFrame | None = None, order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows as the schema wants them, and the others with a reason as _error.

    Reasons: a value that does not convert, a required value that is missing, a text longer than the field's
    maxLength, a key seen before in this table (the first by order_by loads), a key that the target holds already.
    """
    reasons: list[Column] = []
    for f in schema.fields:
        c = F.col(f"`{column_named(df, f.name)}`")
        if df.schema[column_named(df, f.name)].dataType != f.dataType:
            reasons.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if not f.nullable:
            reasons.append(F.when(c.isNull(), F.lit(f"{f.name}: missing")))
        if most := f.metadata.get("maxLength"):
            reasons.append(F.when(F.char_length(c.cast("string")) > most, F.lit(f"{f.name}: longer than {most}")))
    rows = df.withColumn("_reasons", F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>"))
    if keys:
        order = [F.size("_reasons").asc(), *[F.col(c) for c in order_by or []], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
        typed = [F.col(f"`{column_named(df, k)}`").try_cast(schema[k].dataType) for k in keys]
        unreadable = reduce(lambda x, y: x | y, [k.isNull() for k in typed])
        # rows without a key repeat nobody's: each is dealt by itself
        spread = F.when(unreadable, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()))
        first = F.row_number().over(Window.partitionBy(*typed, spread).orderBy(*order)) == 1
        rows = rows.withColumn("_reasons", F.when(first | (F.size("_reasons") > 0), F.col("_reasons")).otherwise(F.array(F.lit("duplicate key"))))
        if target is not None:
            known = target.select(*[F.col(f"`{k}`").alias(f"_t{i}") for i, k in enumerate(keys)]).distinct().withColumn("_known", F.lit(True))
            same = [k == F.col(f"_t{i}") for i, k in enumerate(typed)]
            rows = rows.join(known, same, "left").withColumn("_reasons", F.when(F.col("_known") & (F.size("_reasons") == 0), F.array(F.lit("key exists"))).otherwise(F.col("_reasons")))
    good = rows.where("size(_reasons) = 0").select(*[F.col(f"`{column_named(df, f.name)}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    bad = rows.where("size(_reasons) > 0").select(*df.columns, F.concat_ws("; ", "_reasons").alias("_error"))
    return good, bad


def dead_letters_json(bad: DataFrame, task: str, table: str, error: str = "_error", at: Column | None = None) -> DataFrame:
    """row (texts), error, task_name, table_name, timestamp."""
    columns = [c for c in bad.columns if c != error]
    stamp = F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return bad.select(F.array(*[canon_of(bad, c) for c in columns]).alias("row"), F.col(error).alias("error"), F.lit(task).alias("task_name"), F.lit(table).alias("table_name"), stamp.alias("timestamp"))


def dead_letters_csv(bad: DataFrame, table: str, error: str = "_error", at: Column | None = None) -> DataFrame:
    """The source's columns as text, then _dlq_error, _dlq_table_name, _dlq_timestamp; NULL is written as empty."""
    columns = [c for c in bad.columns if c != error]
    stamp = F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return bad.select(*[canon_of(bad, c).alias(c) for c in columns], F.col(error).alias("_dlq_error"), F.lit(table).alias("_dlq_table_name"), stamp.alias("_dlq_timestamp"))


def write_dead_letters(letters: DataFrame, path: str, fmt: str = "json", by_date: bool = False) -> None:
    """Append to any file system Spark reaches; by_date deals the files into folders by their day."""
    stamp = "timestamp" if fmt == "json" else "_dlq_timestamp"
    out = letters.withColumn("dlq_date", F.left(F.col(stamp), F.lit(10))) if by_date else letters
    writer = out.write.mode("append")
    if by_date:
        writer = writer.partitionBy("dlq_date")
    if fmt == "json":
        writer.json(path)
    elif fmt == "csv":
        writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        raise ValueError(f"unknown dead-letter format: {fmt}")


def read_dead_letters(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The rows of a dead-letter folder with their types, ready for the load they failed in; values that still do not convert are NULL."""
    if fmt == "csv":
        texts = spark.read.option("header", True).csv(path)
        return texts.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    rows = spark.read.schema("row array<string>, error string, task_name string, table_name string, timestamp string").json(path)
    return rows.select(*[F.col("row")[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


class RowFailure(Exception):
    """What became of a row in a process of its own; its text is the message."""


#: Rows that are sent to a child process at a time.
SENT = 1000


class LimitedCalls:
    """A function called in a child process that is killed when a row takes too long, whatever it does, and started again for the next row.

    Rows go to the child many at a time and it writes each result as it has it, so nobody waits for a message between two rows,
    and what was made before a row that hangs is there. Each row is begun once.
    """

    def __init__(self, fn: Callable[[dict], dict], limit_s: float):
        self.fn, self.limit_s, self.child = fn, limit_s, None

    @staticmethod
    def _answer(fn: Callable[[dict], dict], rows, results, parents: list) -> None:
        for end in parents:  # else this process would hold the pipe open that tells it of its parent's end
            end.close()
        out = results.fileno()
        while True:
            try:
                part = rows.recv()
            except EOFError:
                return
            for row in part:
                began = time.perf_counter()
                try:
                    made = pickle.dumps((True, fn(row), time.perf_counter() - began))
                except Exception as e:  # the function's, or a result that cannot be sent
                    made = pickle.dumps((False, f"{type(e).__name__}: {e}", time.perf_counter() - began))
                left = memoryview(len(made).to_bytes(8, "little") + made)
                while left:
                    left = left[os.write(out, left) :]

    def _start(self) -> None:
        fork = multiprocessing.get_context("fork")
        (rows, self.rows), (self.results, results) = fork.Pipe(duplex=False), fork.Pipe(duplex=False)
        self.child = fork.Process(target=self._answer, args=(self.fn, rows, results, [self.rows, self.results]), daemon=True)
        self.child.start()
        rows.close(), results.close()
        self.read, self.at = b"", 0

    def _bytes(self, n: int) -> bytes:
        """The next bytes of the results; what is there is read at once."""
        while len(self.read) - self.at < n:
            if not self.results.poll(self.limit_s):
                raise RowFailure(f"TimeoutError: no result within {self.limit_s} s")
            more = os.read(self.results.fileno(), 1 << 16)
            if not more:
                raise EOFError
            self.read, self.at = self.read[self.at :] + more, 0
        self.at += n
        return self.read[self.at - n : self.at]

    def __call__(self, rows: list[dict]) -> Iterator[dict | RowFailure]:
        """What the function makes of each row, or why there is nothing."""
        done = 0
        while done < len(rows):
            if self.child is None:
                self._start()
            part = rows[done : done + SENT]
            try:
                self.rows.send(part)
                for _ in part:
                    ok, value, seconds = pickle.loads(self._bytes(int.from_bytes(self._bytes(8), "little")))
                    done += 1
                    yield RowFailure(f"TimeoutError: no result within {self.limit_s} s") if seconds > self.limit_s else value if ok else RowFailure(value)
            except (EOFError, OSError):
                self.close()
                done += 1
                yield RowFailure("RuntimeError: the function ended its process")
            except RowFailure as e:
                self.close()
                done += 1
                yield e

    def close(self) -> None:
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.rows.close(), self.results.close()
            self.child = None


def tagged_transform(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType, on_error: str = "dlq", limit_s: float | None = None) -> DataFrame:
    """Each row once: what a Python function makes of it (_out_…), the row itself (_in_…) and the message where the function failed (_error).

    With a limit the function runs in a child of the worker; a row that takes longer fails, even where it hangs for good or ends its process.
    """
    names = [f.name for f in schema.fields]
    both = T.StructType([*[T.StructField(f"_out_{f.name}", f.dataType) for f in schema.fields], *[T.StructField(f"_in_{f.name}", f.dataType) for f in df.schema.fields], T.StructField("_error", T.StringType())])

    def run(batches):
        if limit_s is None:
            yield from rows(batches, here)
            return
        limited = LimitedCalls(fn, limit_s)
        try:
            yield from rows(batches, limited)
        finally:
            limited.close()

    def here(records):
        for row in records:
            try:
                yield fn(dict(row))
            except Exception as e:
                yield e

    def rows(batches, calls):
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in both.fields}
            records = batch.astype(object).where(batch.notna(), None).to_dict("records")
            for row, made in zip(records, calls(records), strict=True):
                error = None
                try:
                    if isinstance(made, Exception):
                        raise made
                    if not isinstance(made, dict):
                        raise TypeError(f"expected a dict, got {type(made).__name__}")
                except Exception as e:  # the row's own failure is data
                    if on_error == "abort":
                        raise
                    made, error = {}, str(e) if isinstance(e, RowFailure) else f"{type(e).__name__}: {e}"
                for n in names:
                    out[f"_out_{n}"].append(made.get(n))
                for n, v in row.items():
                    out[f"_in_{n}"].append(v)
                out["_error"].append(error)
            yield pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in out.items()})

    return df.mapInPandas(run, both)


def split_transformed(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """What the function made, and the rows it failed on with the message as _error."""
    good = rows.where("_error is null").select(*[F.col(f"`_out_{f.name}`").alias(f.name) for f in schema.fields])
    bad = rows.where("_error is not null").select(*[F.col(f"`{c}`").alias(c.removeprefix("_in_")) for c in rows.columns if c.startswith("_in_")], "_error")
    return good, bad


def row_transform(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType, on_error: str = "dlq", limit_s: float | None = None) -> tuple[DataFrame, DataFrame]:
    """A Python function of a row given by column name, in Arrow batches. Missing keys become NULL, others are ignored.

    Rows it fails on come back as they were, with the message as _error; on_error="abort" raises instead. Both results run
    the function; save tagged_transform and split that where both are used.
    """
    return split_transformed(tagged_transform(df, fn, schema, on_error, limit_s), schema)
