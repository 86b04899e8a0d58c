"""Tables along a space-filling curve."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableflow.operators import curve, write
from tableflow.plans.spec import TaskSpec
from tableflow.plans.task import run_task


def test_the_curve_visits_all_cells_and_never_jumps(spark):
    for n, bits in ((2, 4), (3, 2), (4, 2), (2, 1)):
        cells = 1 << n * bits
        columns = [F.shiftright("id", k * bits).bitwiseAND(F.lit((1 << bits) - 1)).alias(f"c{k}") for k in range(n)]
        df = spark.range(cells).select(*columns)
        made = df.select(*df.columns, curve.curve_place(df, [c.upper() for c in df.columns], bits).alias("z")).orderBy("z").collect()
        assert [r["z"] for r in made] == list(range(cells))
        assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(made, made[1:]))


def test_ranks_are_even_whatever_the_values(spark):
    df = spark.range(4000).select(F.pow(F.lit(1.01), F.col("id")).alias("x"), F.concat(F.lit("same beginning "), F.lpad("id", 5, "0")).alias("t"), F.expr("date'2024-01-01' + cast(id % 700 as int)").alias("d"))
    for c in df.columns:
        sizes = [r["n"] for r in df.groupBy(curve.curve_place(df, [c], 3).alias("z")).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8


def test_either_column_skips_files(spark, tmp_path):
    df = spark.range(20000).select("id", ((F.col("id") * 7919) % 20011).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 104729) % 20021, 5, "0")).alias("b"))
    write.write_table(df, str(tmp_path / "t"), cluster=["hilbert(a, b)"])
    curve.curve_ordered(df, ["a", "b"], 64).write.parquet(str(tmp_path / "z"))
    filters = {"a": (1000, 1100), "b": ("k10000", "k10100")}
    found = {r["column"]: r for r in curve.file_skipping(spark.read.parquet(str(tmp_path / "z")), filters).collect()}
    for c, (low, high) in filters.items():
        assert found[c]["n_files"] == 64 and found[c]["n_read"] < 20 and found[c]["n_rows"] == df.where(F.col(c).between(low, high)).count()
    for name in ("t", "z"):
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / name)).collect())) == sorted(map(tuple, df.collect()))
    one = df.repartitionByRange(64, "a")
    one.write.parquet(str(tmp_path / "one"))  # an order by one column leaves every file to the other
    assert {r["column"]: r["n_read"] for r in curve.file_skipping(spark.read.parquet(str(tmp_path / "one")), filters).collect()}["b"] > 50


def test_nulls_ties_repeats_and_clashing_names(spark):
    third = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), F.lit(None).cast("string").alias("b"), F.lit(1).alias("_place0"), F.create_map(F.lit("k"), F.col("id") % 2).alias("m"))
    out = curve.curve_ordered(third.repartition(8), ["a", "b"], 16)
    assert out.columns == third.columns and out.count() == 3000
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 600  # NULL holds a third of the rows, and is dealt over several tasks
    same = curve.curve_ordered(spark.range(4000).select(F.lit(5).alias("a")).repartition(16), ["a"], 8)
    assert len([1 for r in same.groupBy(F.spark_partition_id()).count().collect()]) > 2
    assert curve.curve_ordered(third.limit(0), ["a", "b"]).count() == 0


def test_what_is_refused(spark):
    df = spark.createDataFrame([(1, [1])], "a int, b array<int>")
    for columns in (["b"], ["a", "A"], []):
        with pytest.raises((TypeError, ValueError)):
            curve.curve_place(df, columns)
    with pytest.raises(ValueError):
        TaskSpec("t", "versioned:/tmp/x", df, cluster=["hilbert(a)"])


def test_task_along_a_curve(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 37 % 500)) for i in range(500)], "id long, at timestamp")
    result = run_task(spark, TaskSpec("t", str(tmp_path / "t"), df, cluster=["hilbert(id, at)"], validate="checksum"))
    assert (result.rows, result.validation) == (500, "passed")
