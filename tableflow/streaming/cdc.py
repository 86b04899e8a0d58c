"""Change capture: rounds over a cursor, and streams whose batches are appended or merged."""

from __future__ import annotations

import json
import threading
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.write import Target, merge_into, path_exists, write_table
from ..operators.versioned import VersionedTable
from ..sources.scans import incremental_scan, up_to

STATE = "task_key string, cursor string, saved_at timestamp"
#: Files of a state table that are rewritten as one.
COMPACT = 200


def task_key(source: str, target: str, table: str) -> str:
    return f"{source}:{target}:{table}"


def load_cursor(spark: SparkSession, path: str, key: str, default: Any = None) -> Any:
    """The last saved cursor of a task, as text; the default without one."""
    if not path_exists(spark, path):
        return default
    row = spark.read.schema(STATE).parquet(path).where(F.col("task_key") == key).agg(F.max_by("cursor", "saved_at").alias("cursor")).first()
    return default if row is None or row["cursor"] is None else row["cursor"]


def save_cursor(spark: SparkSession, path: str, key: str, cursor: Any) -> None:
    """Append the cursor, one tiny file for each round; many of them are rewritten as one row for each task."""
    if path_exists(spark, path) and len(spark.read.schema(STATE).parquet(path).inputFiles()) >= COMPACT:
        latest = spark.read.schema(STATE).parquet(path).groupBy("task_key").agg(F.max_by("cursor", "saved_at").alias("cursor"), F.max("saved_at").alias("saved_at"))
        write_table(latest.coalesce(1), path)
    one = spark.range(1).select(F.lit(key).alias("task_key"), F.lit(str(cursor)).alias("cursor"), F.current_timestamp().alias("saved_at"))
    one.coalesce(1).write.mode("append").parquet(path)


def max_cursor(df: DataFrame, key: str) -> Any:
    """The greatest key of the unmasked source; None for no rows."""
    return df.agg(F.max(key)).first()[0]


@dataclass(frozen=True)
class PollResult:
    rows: int
    cursor: Any


def poll_once(spark: SparkSession, source: DataFrame, key: str, target: str, state: str, name: str, mode: str = "append", merge_keys: list[str] | None = None, initial_cursor: Any = None, lateness: Any = None) -> PollResult:
    """One round: rows past the cursor, write, then save the new cursor. Run again after a crash, a merge gives the same table.

    lateness (a number, or a timedelta for times) also reads rows that far behind the cursor: those that came late are loaded by the next round. Rows
    are known by merge_keys: an append takes none whose key the target has in that stretch, a merge takes them by the
    order of their keys, so one that came late does not overwrite a newer one. With a target ``versioned:`` and its folder the cursor is kept in the table's log, in the commit of its rows: each row is loaded once, whenever a
    round dies and whoever else polls; state is not used. Rows without a key are loaded by the first round that finds a key and had no cursor yet; later ones take no row without one.
    """
    table = VersionedTable(spark, target.removeprefix("versioned:")) if target.startswith("versioned:") else None
    saved = table.cursor(name) if table else None
    cursor = (initial_cursor if saved is None else saved) if table else load_cursor(spark, state, name, initial_cursor)
    new = incremental_scan(source, key, cursor, lateness if cursor is not None else None)
    if lateness is not None and cursor is not None:
        if not merge_keys:
            raise ValueError("late rows are known by merge_keys")
        new = new_rows(new, Target(spark, target).read(), key, cursor, lateness, merge_keys, mode)
    bound = new.agg(F.max(key).alias("hi"), F.count("*").alias("n")).first()
    if bound["hi"] is None:
        return PollResult(0, cursor)
    reached = bound["hi"]
    if lateness is not None and cursor is not None:  # late rows alone do not move the cursor back
        past = incremental_scan(new, key, cursor).agg(F.max(key)).first()[0]
        reached = cursor if past is None else past
    new = up_to(new, key, bound["hi"], cursor is None)  # rows that arrive meanwhile wait for the next round
    if table:
        done = (name, saved, reached)
        table.merge(new, merge_keys or [], [key], cursor=done) if mode == "merge" else table.append(new, cursor=done)
        return PollResult(bound["n"], reached)
    if mode == "merge":
        merge_into(spark, target, new, merge_keys or [], [key])
    else:
        write_table(new, target, "append")
    save_cursor(spark, state, name, reached)
    return PollResult(bound["n"], reached)


def new_rows(rows: DataFrame, target: DataFrame, key: str, cursor: Any, lateness: Any, keys: list[str], mode: str) -> DataFrame:
    """Of the rows read again from so far behind the cursor those that the target does not have: by their keys, in a merge also those that are newer than its own."""
    held = incremental_scan(target, key, cursor, lateness).groupBy(*keys).agg(F.max(key).alias("_held"))
    if mode != "merge":
        return rows.join(held, keys, "left_anti")
    older = target.join(rows.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.max(key).alias("_held"))
    return rows.join(older, keys, "left").where(F.col("_held").isNull() | (F.col(key) > F.col("_held"))).select(*rows.columns)


def cdc_stream(stream: DataFrame, target: str, checkpoint: str, mode: str = "append", keys: list[str] | None = None, order_by: list[str] | None = None, interval: str | None = None) -> StreamingQuery:
    """A stream into a Parquet table. Without an interval it takes what there is and stops.

    append writes through the file sink, whose log makes it exactly once. merge upserts each batch by key, the last
    row of a key winning; a batch that is repeated after a failure changes nothing more.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    if mode == "append":
        return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if not keys or not order_by:
        raise ValueError("a merging stream needs keys and an order")

    def upsert(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # read once, used several times
        if not batch.isEmpty():
            merge_into(batch.sparkSession, target, batch, keys, order_by)
        batch.unpersist()

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def without_late_repeats(stream: DataFrame, keys: list[str], event_time: str, lateness: str) -> DataFrame:
    """Rows of a stream once for each key within the watermark; a time without a zone is read as UTC."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


PROGRESS = "task string, query_id string, batch_id long, rows long, duration_ms long, status string"


class _Events:
    """Events as they come from the JVM, of which only what a log keeps is fetched: the listener of Spark's own fetches some hundred values for each batch,
    and where many streams run its queue then overflows and loses events."""

    def __init__(self, log: ProgressLog):
        self.log = log

    def onQueryStarted(self, event) -> None:
        self.log.started(event.id().toString())

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress().json())
        self.log.progressed(p["id"], p["batchId"], p["numInputRows"], p["batchDuration"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log.ended(event.id().toString(), event.exception().isDefined())

    class Java:
        implements = ["org.apache.spark.sql.streaming.PythonStreamingQueryListener"]


class ProgressLog(StreamingQueryListener):
    """Every batch of every stream that starts while it is open, as rows of a run log; Spark itself keeps the last hundred only.

    Rows are appended to the table at path in files of FLUSH batches, the rest when the log is closed or the stream ends. A batch
    that fails ends its stream; it is a row with status failed and no batch number.
    """

    FLUSH = 1000

    def __init__(self, spark: SparkSession, task: str, path: str):
        self.spark, self.task, self.path = spark, task, path
        self.rows: list[tuple] = []
        self.open: set[str] = set()
        self.changed = threading.Condition()

    @property
    def _jlistener(self):
        if not hasattr(self, "_made"):
            self._made = self.spark._jvm.PythonStreamingQueryListenerWrapper(_Events(self))
        return self._made

    def started(self, query: str) -> None:
        with self.changed:
            self.open.add(query)

    def progressed(self, query: str, batch: int, rows: int, duration: int) -> None:
        self._add((self.task, query, batch, rows, duration, "ok"), self.FLUSH)

    def ended(self, query: str, failed: bool) -> None:
        if failed:
            self._add((self.task, query, None, 0, None, "failed"), self.FLUSH)
        with self.changed:
            self.open.discard(query)
            self.changed.notify_all()

    def onQueryStarted(self, event) -> None:
        self.started(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.progressed(str(p.id), p.batchId, p.numInputRows, p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended(str(event.id), bool(event.exception))

    def _add(self, row: tuple | None, most: int) -> None:
        with self.changed:
            if row:
                self.rows.append(row)
                self.changed.notify_all()
            full, self.rows = (self.rows, []) if len(self.rows) >= most else ([], self.rows)
        if full:
            self.spark.createDataFrame(full, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        # events come later than the batches that they tell of; many streams' events take a while, but then some come each minute
        with self.changed:
            while self.open and self.changed.wait(timeout=60):
                pass
        self.spark.streams.removeListener(self)
        self._add(None, 1)
        if not path_exists(self.spark, self.path):
            self.spark.createDataFrame([], PROGRESS).write.parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)
