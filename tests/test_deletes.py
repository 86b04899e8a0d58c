import pytest
from pyspark.sql import functions as F

from tableflow.operators import deletes, write
from tableflow.operators.versioned import VersionedTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_changes_in_any_order(spark, tmp_path):
    """Every order of the same changes gives the same live rows; a delete before a late insert holds, a newer insert brings the row back."""
    ddl = "id long, v string, at int, op string"
    changes = [[(1, "a", 1, "put"), (2, "b", 1, "put")], [(1, None, 3, "del"), (3, None, 3, "del")], [(1, "late", 2, "put"), (3, "late", 2, "put"), (2, "b2", 2, "put")], [(3, "back", 4, "put")]]
    for n, order in enumerate(([0, 1, 2, 3], [3, 1, 2, 0])):
        t = VersionedTable(spark, str(tmp_path / f"t{n}"))
        for i in order:
            deletes.apply_changes(t, spark.createDataFrame(changes[i], ddl), ["id"], ["at"], "op = 'del'")
        assert rows(deletes.live(t).select("id", "v")) == [(2, "b2"), (3, "back")]
        assert rows(t.read().where("_deleted").select("id", "v", "at")) == [(1, None, 3)]
        deletes.compact(t, "at < 3")
        assert t.read().count() == 3
        deletes.compact(t, "at <= 3")
        assert t.read().count() == 2 and [r["operation"] for r in t.history().orderBy("version").collect()][-2:] == ["compact", "compact"]
    with pytest.raises(Exception, match="without a key"):
        deletes.apply_changes(t, spark.createDataFrame([(None, "x", 9, "put")], ddl), ["id"], ["at"], "op = 'del'")


def test_rows_that_the_source_lacks(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(100).select("id", F.lit(1).alias("at"), F.lit("a").alias("v"), F.lit(False).alias(deletes.MARK)), ["id"], parts=10)
    before = set(t.snapshot().files)
    deletes.delete_missing(t, spark.range(100).where("id not in (3, 55)"), ["ID"])
    assert deletes.live(t).count() == t.read().count() == 98 and len(before - set(t.snapshot().files)) == 2
    deletes.delete_missing(t, spark.range(90), ["id"], {"at": 5})
    assert deletes.live(t).count() == 88 and t.read().count() == 98
    deletes.apply_changes(t, spark.createDataFrame([(95, 4, "too late"), (96, 6, "new")], "id long, at int, v string"), ["id"], ["at"], "false")
    assert rows(deletes.live(t).where("id >= 90")) == [(96, 6, "new")]
    deletes.delete_missing(t, spark.range(200), ["id"])  # nothing is missing
    assert deletes.live(t).count() == 89


def test_merge_newest(spark):
    target = spark.createDataFrame([(1, 5, "held"), (2, None, "no age"), (3, 5, "same")], "k long, at int, v string")
    source = spark.createDataFrame([(1, 4, "older"), (1, None, "oldest"), (2, 1, "newer"), (3, 5, "again"), (4, 1, "new"), (4, 2, "newest")], "k long, at int, v string")
    assert rows(write.merge_newest(target, source, ["k"], ["at"])) == [(1, 5, "held"), (2, 1, "newer"), (3, 5, "again"), (4, 2, "newest")]


def test_merge_newest_reads_each_side_once(spark, tmp_path):
    """Repeated and missing keys, columns that the source lacks, and no join: the source is scanned once, the target once."""
    spark.createDataFrame([(1, 5, "a", "x"), (1, 9, "b", "y"), (2, 5, "c", "z"), (None, 1, "n", "n")], "k long, at int, v string, w string").write.parquet(str(tmp_path / "target"))
    spark.createDataFrame([(1, 6, "new"), (2, 4, "old"), (3, 1, "first"), (3, 2, "second")], "k long, at int, v string").write.parquet(str(tmp_path / "source"))
    target, source = spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "source"))
    merged = write.upsert_newest(target, source, ["k"], ["at"])
    assert rows(merged) == sorted([(1, 6, "new", "x"), (1, 6, "new", "y"), (2, 5, "c", "z"), (3, 2, "second", None), (None, 1, "n", "n")], key=repr)
    assert rows(write.merge_newest(target.drop("w"), source, ["k"], ["at"])) == sorted([(1, 6, "new"), (2, 5, "c"), (3, 2, "second"), (None, 1, "n")], key=repr)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Join" not in plan
    plan = write.merge_newest(target, source, ["k"], ["at"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 4  # 28 when it was a merge after a join; two are for rows without a key
