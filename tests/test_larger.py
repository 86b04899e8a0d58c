"""Registered queries on tables that are larger than the given ones in what their SQL depends on."""

import os
import time

import duckdb
from pyspark.sql import functions as F

from tableflow import queries
from tableflow.operators import deadletter, profile, write
from tableflow.streaming import cdc


def same_as_sql(spark, folder, *names):
    duck = duckdb.connect()
    for t in sorted(folder.glob("*.parquet")):
        duck.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}/*.parquet'")
    for name in names:
        df, found = queries.QUERIES[name](spark, str(folder)), duck.execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in found.description]
        assert sorted(map(tuple, df.select(*columns).collect())) == sorted(found.fetchall()), name


def test_new_keys_of_a_larger_table_are_new(spark, tmp_path):
    """Keys up to a million and more: rows that the other version has under new keys meet none, so its keys stay unique and each is target_only."""
    o = spark.range(999_900, 1_000_600).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"))
    o.unionByName(o.withColumn("o_orderkey", F.col("o_orderkey") - 999_900)).write.parquet(str(tmp_path / "orders.parquet"))
    target = queries._perturbed(spark, str(tmp_path))[1]
    assert target.select("o_orderkey").distinct().count() == target.count()
    same_as_sql(spark, tmp_path, "diff_rows", "diff_summary", "diff_mismatch", "diff_by_column", "diff_source_only", "diff_target_only", "detect_deletes_orders", "tree_diff_orders", "diff_report_orders")


def test_digest_of_two_levels(spark, tmp_path):
    """More rows than one group holds, three of them twice."""
    o = spark.range(100_100).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (F.col("id") / 4).alias("o_totalprice"), F.lit("2024-01-02").cast("timestamp_ntz").alias("o_orderdate"))
    o.unionByName(o.where("o_orderkey < 3")).write.parquet(str(tmp_path / "orders.parquet"))
    same_as_sql(spark, tmp_path, "digest_orders")


def test_files_of_a_number_of_rows(spark, tmp_path):
    """Rows in uneven partitions; every file but the last is full, whatever the task that writes it."""
    df = spark.range(100, numPartitions=3).unionByName(spark.range(100, 113, numPartitions=2)).withColumn("number0", F.lit("x"))
    assert write.write_files_of(df, str(tmp_path / "t"), 10, 4) == 4
    sizes = [(r["part"], r["n"]) for r in spark.read.parquet(str(tmp_path / "t")).groupBy("part", F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sorted(n for _, n in sizes) == [3] + [10] * 11 and {p for p, _ in sizes} == {0, 1, 2, 3}
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "t")).select("id").collect()) == list(range(113))
    assert write.write_files_of(df.limit(0), str(tmp_path / "none"), 10, 4) == 1


def test_limited_rows_need_no_message_each(tmp_path):
    """Rows before and after ones that hang, are slow, end their process or fail: each is begun once, and the others cost microseconds."""
    began = tmp_path / "began"

    def change(row):
        with open(began, "a") as f:
            f.write(f"{row['i']}\n")
        if row["i"] == 1500:
            time.sleep(60)
        if row["i"] == 2600:
            os._exit(1)
        if row["i"] == 2601:
            raise ValueError("no")
        if row["i"] == 2602:
            return {"text": "x" * 300_000}
        return {"i": row["i"]}

    calls = deadletter.LimitedCalls(change, 0.5)
    got = list(calls([{"i": i} for i in range(3000)]))
    sent = len(got)
    assert sent == 3000 and [int(x) for x in began.read_text().split()] == list(range(3000))
    assert {i: str(x) for i, x in enumerate(got) if isinstance(x, Exception)} == {1500: "TimeoutError: no result within 0.5 s", 2600: "RuntimeError: the function ended its process", 2601: "ValueError: no"}
    assert len(got[2602]["text"]) == 300_000 and all(got[i] == {"i": i} for i in range(3000) if i not in (1500, 2600, 2601, 2602))
    calls.close()
    quick = deadletter.LimitedCalls(lambda row: row, 5)
    list(quick([{"i": 0}]))
    start = time.perf_counter()
    assert len(list(quick([{"i": i} for i in range(100_000)]))) == 100_000
    assert time.perf_counter() - start < 3  # 100,000 answers that are waited for one by one take longer
    quick.close()


def test_quantiles_are_exact(spark):
    """Values of many rows and of one, NULL, and a column without values, against those of sorted lists."""
    df = spark.range(30_000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("b"), (F.pow("id", F.lit(2)) / 7).alias("c"), F.lit(None).cast("long").alias("d"))
    shares = [0.0001, 0.3, 0.5, 0.62, 1.0]
    found = profile.exact_quantiles(df, {c: shares for c in df.columns})
    for c in "abc":
        own = sorted(r[0] for r in df.select(c).collect() if r[0] is not None)
        assert found[c] == [next(v for i, v in enumerate(own, 1) if i >= len(own) * s) for s in shares]
    assert found["d"] == [None] * 5


def test_streams_side_by_side(spark, tmp_path):
    """Each of several streams has its part of the files, and all their batches are in the log."""
    spark.range(7_600).select(F.col("id").alias("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    started = []
    own = cdc.cdc_stream
    try:
        cdc.cdc_stream = lambda *a: started.append(own(*a)) or started[-1]
        same_as_sql(spark, tmp_path, "stream_progress_events")
    finally:
        cdc.cdc_stream = own
    assert len(started) == 4
