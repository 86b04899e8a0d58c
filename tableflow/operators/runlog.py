"""Audit rows of task runs, and what is counted from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The columns of an audit row.
HISTORY = (
    "id string, config_hash string, started_at timestamp, finished_at timestamp, task_name string, source_db string, target_db string, mode string, "
    "rows_processed long, rows_failed long, validation_result string, error_message string, version string"
)
#: Upper bounds of the duration histogram, in milliseconds.
BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000)


def record_history(spark: SparkSession, row: dict, path: str) -> None:
    """Append one finished run."""
    names = [f.split()[0] for f in HISTORY.split(", ")]
    spark.createDataFrame([tuple(row.get(n) for n in names)], HISTORY).coalesce(1).write.mode("append").parquet(path)


def recent_history(logs: list[DataFrame], n: int = 10, by: str = "started_at", tie: str = "id") -> DataFrame:
    """The latest runs over several logs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs).orderBy(F.col(by).desc(), F.col(tie).desc()).limit(n)


def run_summary(log: DataFrame, status: str = "status", rows: str = "rows", duration: str = "duration_ms") -> DataFrame:
    """One row: tasks, those that failed and succeeded, rows and time."""
    failed = F.col(status) == "failed"
    return log.agg(
        F.count("*").alias("total"), F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed"), F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(duration), F.lit(0)).alias("duration_ms"),
    )


def run_counters(log: DataFrame, keys: list[str], status: str = "status", rows: str = "rows") -> DataFrame:
    """For each task (and source and target): batches by outcome, rows and dead letters."""
    failed = F.col(status) == "failed"
    return log.groupBy(*keys).agg(
        F.count_if(~failed).alias("batches_ok"), F.count_if(failed).alias("batches_failed"), F.coalesce(F.sum(F.when(~failed, F.col(rows))), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(failed, F.col(rows))), F.lit(0)).cast("long").alias("n_dead_letters"),
    )


def duration_histogram(log: DataFrame, keys: list[str], duration: str = "duration_ms", bounds: tuple[int, ...] = BOUNDS) -> DataFrame:
    """For each key and bound the number of durations up to it (cumulative), with the key's count; the last bound is NULL for all."""
    d = F.col(duration)
    place = reduce(lambda c, i: c.when(d <= bounds[i], i), range(1, len(bounds)), F.when(d <= bounds[0], 0)).otherwise(len(bounds))
    counted = log.groupBy(*keys, place.alias("place")).agg(F.count("*").alias("n"))
    every = counted.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(len(bounds)))).alias("place"))
    bound = F.element_at(F.array(*map(F.lit, bounds), F.lit(None).cast("int")), F.col("place") + 1)
    up_to = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    filled = every.join(counted, [*keys, "place"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.select(*keys, F.col("place").cast("int").alias("place"), bound.cast("long").alias("le_ms"), F.sum("n").over(up_to).alias("n_runs"))
