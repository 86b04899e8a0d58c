import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions import values
from tableflow.operators import deadletter, join, profile, project, quality, reconcile, runlog, write
from tableflow.operators.quality import Rule
from tableflow.sources import scans


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_mapping(spark):
    df = spark.createDataFrame([(1, "alice"), (2, "bob")], "id long, name string")
    out = project.map_columns(df, [("name", "user_name"), ("ID", "user_id")])
    assert out.columns == ["user_name", "user_id"] and rows(out) == [("alice", 1), ("bob", 2)]
    assert project.map_columns(df, []).columns == df.columns
    for pairs in ([("none", "x")], [("id", "x"), ("name", "X")]):
        with pytest.raises(ValueError):
            project.map_columns(df, pairs)


@pytest.mark.parametrize(("low", "high", "n"), [(1, 100, 4), (0, 3, 10), (5, 5, 3), (-7, 12, 5)])
def test_integer_shards_hold_every_key_once(spark, low, high, n):
    df = spark.range(low, high + 1)
    ranges = scans.shard_ranges(df, "id", n).orderBy("shard").collect()
    assert ranges[0]["lower"] == low and ranges[-1]["upper"] == high and ranges[-1]["last_inclusive"]
    counts = scans.with_shard(df, "id", n).groupBy("id").agg(F.count("*").alias("n"), F.count("shard").alias("s")).where("n <> 1 or s <> 1").count()
    assert counts == 0
    parts = [scans.shard_filter(df, "id", r["lower"], r["upper"], r["last_inclusive"]).count() for r in ranges]
    assert sum(parts) == high - low + 1


def test_other_shards(spark):
    floats = spark.createDataFrame([(5.0,), (6.0,), (8.0,)], "k double")
    assert [tuple(r)[1:] for r in scans.shard_ranges(floats, "k", 3).orderBy("shard").collect()] == [(5.0, 6.0, False), (6.0, 7.0, False), (7.0, 8.0, True)]
    times = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (dt.datetime(2026, 1, 5),)], "k timestamp_ntz")
    got = scans.shard_ranges(times, "k", 2).orderBy("shard").collect()
    assert (got[0]["lower"], got[1]["upper"], len(got)) == (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 5), 2)
    assert scans.shard_ranges(spark.range(0), "id", 4).count() == 0
    assert len(scans.shard_ranges(floats.limit(1), "k", 3).collect()) == 1
    with pytest.raises(ValueError):
        scans.shard_ranges(floats, "k", 1)
    with pytest.raises(TypeError):
        scans.shard_ranges(spark.createDataFrame([("a",)], "k string"), "k", 2)


def test_incremental_is_strict_and_pushed_down(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = scans.incremental_scan(spark.read.parquet(str(tmp_path / "t")), "id", "41")
    assert df.count() == 58
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,41)]" in df._jdf.queryExecution().toString()
    assert scans.incremental_scan(spark.range(10), "id", 5, lateness=2).count() == 6


def test_joins(spark):
    orders = spark.createDataFrame([(1, 101, 100.0), (2, 102, 200.0), (3, None, 300.0), (4, 999, 50.0)], "order_id long, user_id long, amount double")
    users = spark.createDataFrame([(101, "alice"), (102, "bob"), (103, "carol"), (None, "nobody")], "user_id long, user_name string")
    assert join.federated_join(orders, users, ["user_id"]).columns == ["user_id", "order_id", "amount", "user_name"]
    assert rows(join.federated_join(orders, users, ["user_id"])) == [(101, 1, 100.0, "alice"), (102, 2, 200.0, "bob")]
    assert join.federated_join(orders, users, ["user_id"], "left").count() == 4
    right = join.federated_join(orders, users, ["user_id"], "right")
    assert right.columns == ["user_id", "user_name", "order_id", "amount"] and right.where("order_id is null").count() == 2
    text = users.withColumn("user_id", F.col("user_id").cast("string"))
    assert join.federated_join(orders, text, ["user_id"]).count() == 2
    with pytest.raises(ValueError, match="amount"):
        join.federated_join(orders, users.withColumn("AMOUNT", F.lit(1)), ["user_id"])
    with pytest.raises(ValueError):
        join.federated_join(orders, users, ["user_id"], "outer")


def test_diff(spark):
    source = spark.createDataFrame([(1, 100, "pending"), (2, 200, "pending"), (3, 300, "done"), (None, 1, "x")], "id long, amount long, status string")
    target = spark.createDataFrame([(2, 200, "shipped"), (3, 300, "done"), (4, 400, "pending"), (None, 1, "x")], "ID long, amount long, status string")
    d = reconcile.diff(source, target, ["id"])
    assert rows(d.source_only) == [(1, 100, "pending")] and rows(d.target_only) == [(4, 400, "pending")]
    assert [(r["id"], r["diff_cols"]) for r in d.mismatch.collect()] == [(2, ["status"])]
    assert tuple(d.summary.first()) == (4, 4, 1, 1, 1)
    assert tuple(reconcile.diff(source, source, ["id"]).summary.first())[2:] == (0, 0, 0)
    with pytest.raises(ValueError):
        reconcile.diff(source, target, [])


def test_diff_and_deletes_shuffle_each_side_once(spark):
    a = spark.range(100).withColumn("v", F.lit("x"))
    b = spark.range(50, 150).withColumn("v", F.lit("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (reconcile.diff(a, b, ["id"]).rows, join.detect_deletes(b, a, ["id"])):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_deletes_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id long, v string")
    source = spark.createDataFrame([(1,), (None,)], "ID int")
    assert rows(join.detect_deletes(target, source, ["id"])) == [(3, "c")]


def test_keys_of_other_types(spark):
    """Numbers by value, numbers against text, text that is no number."""
    whole = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    for ddl, keys in (("k double, w string", [1.0, 2.5, None]), ("k string, w string", ["1", "x", None]), ("k decimal(10,2), w string", [D("1.00"), D("2.50"), None]), ("k int, w string", [1, 7, None])):
        other = spark.createDataFrame([(k, "w") for k in keys], ddl)
        assert rows(join.federated_join(whole, other, ["k"]).select("v", "w")) == [("a", "w")], ddl
        assert rows(join.federated_join(other, whole, ["k"]).select("v", "w")) == [("a", "w")], ddl
        assert rows(join.detect_deletes(whole, other, ["k"])) == [(2, "b")], ddl
        assert tuple(reconcile.diff(whole, other, ["k"]).summary.first())[2:4] == (1, 1), ddl
    floats = spark.createDataFrame([(1.0,), (1e20,)], "k double")
    assert join.federated_join(floats, spark.createDataFrame([("1", 0)], "k string, w int"), ["k"]).count() == 1


def test_strict_keys(spark):
    one, two = spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(1,), (1,)], "id long")
    assert tuple(reconcile.diff(one, one, ["id"], strict_keys=True).summary.first()) == (2, 2, 0, 0, 0)
    for pair in ((one, two), (two, one)):
        with pytest.raises(ValueError, match="repeated keys"):
            reconcile.diff(*pair, ["id"], strict_keys=True)


def test_checksums_tell_different_tables_apart(spark):
    def passed(a, b, ddl):
        return reconcile.validate_checksum(spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl)).first()["passed"]

    t = dt.datetime(2024, 1, 1)
    different = [
        ([("a|b", "c")], [("a", "b|c")], "x string, y string"), ([(None,)], [("NULL",)], "x string"), ([(None, "a")], [("a", None)], "x string, y string"), ([(1e-8,)], [(2e-8,)], "x double"),
        ([(t,)], [(t.replace(microsecond=800_000),)], "x timestamp"), ([(1e40,)], [(2e40,)], "x double"), ([(float("nan"),)], [(None,)], "x double"), ([(float("inf"),)], [(float("-inf"),)], "x double"), ([("",)], [(None,)], "x string"),
        ([(1,), (1,)], [(1,)], "x int"), ([([1, None],)], [([1],)], "x array<int>"), ([((None, 1),)], [((1, None),)], "x struct<a:int,b:int>"), ([(D("0.00000001"),)], [(D("0.00000002"),)], "x decimal(20,8)"),
    ]
    for a, b, ddl in different:
        assert not passed(a, b, ddl) and passed(a, a, ddl) and passed(b, b, ddl), (a, b)
    assert passed([(0.0,)], [(-0.0,)], "x double")
    whole, part = spark.createDataFrame([(1,), (100,)], "x int"), spark.createDataFrame([(1.0,), (100.0,)], "x double")
    assert reconcile.validate_checksum(whole, part).first()["passed"]


def test_digest_of_many_groups(spark, monkeypatch):
    df = spark.range(3000).withColumn("v", F.col("id") % 7)
    plain = reconcile.table_digest(df).first()[0]
    monkeypatch.setattr(reconcile, "DIGEST_ROWS", 10)
    parts = reconcile.table_digest(df.repartition(5)).first()[0]
    assert parts != plain and parts == reconcile.table_digest(df.orderBy(F.desc("id"))).first()[0]
    assert parts != reconcile.table_digest(df.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v")))).first()[0]
    assert len(parts) == 32 and reconcile.table_digest(df.limit(0)).first()[0] == reconcile.table_digest(df.limit(0)).first()[0]


def test_views_of_the_session_stay(spark):
    spark.range(3).createOrReplaceTempView("mine")
    assert scans.query_scan(spark, "SELECT * FROM mine, other", {"mine": spark.range(5).withColumnRenamed("id", "a"), "other": spark.range(2).withColumnRenamed("id", "b")}).count() == 10
    assert spark.table("mine").count() == 3 and not spark.catalog.tableExists("other")
    spark.catalog.dropTempView("mine")


def test_sharded_scans(spark, tmp_path):
    spark.range(1, 101).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for shards, cursor, n in ((4, None, 100), (3, 40, 60), (5, 100, 0), (7, 99, 1)):
        out = scans.sharded_scan(df, "id", shards, cursor)
        assert (out.count(), out.distinct().count()) == (n, n)
    assert scans.sharded_scan(df, "id", 4, 40)._jdf.queryExecution().toString().count("GreaterThan(id,40)") >= 4


def test_diff_reports(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(2, "z"), (3, "y")], "id long, v string")
    d = reconcile.diff(a, b, ["id"])
    for fmt in ("json", "csv"):
        d.write(str(tmp_path / fmt), fmt)
        assert {p.name for p in (tmp_path / fmt).iterdir()} == {"source_only", "target_only", "mismatch", "summary"}
    assert spark.read.json(str(tmp_path / "json" / "mismatch")).first()["diff_cols"] == ["v"]


def test_digests(spark):
    df = spark.createDataFrame([(1, "alice", None), (2, "bob", 1.5)], "id long, name string, x double")
    assert rows(reconcile.fingerprint(df)) == rows(reconcile.fingerprint(df.orderBy(F.desc("id"))))
    assert rows(reconcile.fingerprint(df)) != rows(reconcile.fingerprint(df.unionByName(df.limit(1))))
    assert rows(reconcile.table_digest(df)) == rows(reconcile.table_digest(df.repartition(3)))
    assert reconcile.validate_checksum(df, df).first()["passed"]
    assert reconcile.same_rows(df, df).first()["passed"] and not reconcile.same_rows(df, df.unionByName(df)).first()["passed"]
    empty = df.limit(0)
    assert reconcile.validate_checksum(empty, empty).first()["passed"] and reconcile.same_rows(empty, empty).first()["passed"]


def test_sample(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id")))
    a, b = (rows(reconcile.random_sample(df, 50, ["id"], 3)) for _ in range(2))
    assert a == b and len(a) == 50
    missing, counts = reconcile.validate_sample(df, df.where("id % 10 <> 0"), 1000, ["id"])
    assert tuple(counts.first()) == (1000, 100, False) and [r["id"] for r in missing.collect()] == [0, 10, 20, 30, 40]


def test_rules(spark):
    df = spark.createDataFrame([(1, "alice", 100.0), (2, "bob", 200.0), (3, None, 300.0)], "id long, name string, amount double")
    rules = [Rule("not_null", column="name"), Rule("range", column="amount", min=0, max=250), Rule("in_set", column="name", values=("alice",)), Rule("unique", columns=("id",)), Rule("max_length", column="name", length=4)]
    assert {r["rule"]: r["violations"] for r in quality.assert_report(df, rules).collect()} == {"not_null": 1, "range": 1, "in_set": 1, "unique": 0, "max_length": 1}
    good, bad = quality.quarantine(df, rules)
    assert good.count() + bad.count() == 3 and good.count() == 0
    assert quality.violating_rows(df, rules[:1]).first()["_error"] == "assertion failed: not_null(name)"
    with pytest.raises(quality.AssertionFailed, match="not_null"):
        quality.enforce(quality.assert_report(df, rules))
    assert quality.enforce(quality.assert_report(df, [Rule("not_null", column="name", on_fail="dlq"), Rule("range", column="amount", max=1, on_fail="warn")])) == ["not_null(name)"]
    repeated = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert quality.quarantine(repeated, [Rule("unique", columns=("k",))])[1].count() == 4
    assert rows(quality.unique_violations(repeated, ["k"])) == [(1, 2)]
    for broken in ({"rule": "range", "column": "a"}, {"rule": "in_set", "column": "a"}, {"rule": "nothing"}, {"rule": "not_null", "column": "a", "on_fail": "x"}):
        with pytest.raises(ValueError):
            Rule(**broken)


def test_split_loadable_keeps_every_row(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b_dup"), ("x", "c"), ("2", "much too long"), ("3", None), ("9", "known")], "id string, name string")
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), False, {"maxLength": 6})])
    good, bad = deadletter.split_loadable(df, schema, ["id"], spark.createDataFrame([(9,)], "id long"), ["name"])
    assert rows(good) == [(1, "a")]
    assert dict((r["id"], r["_error"]) for r in bad.collect() if r["id"] != "1") == {"x": "id: not a bigint", "2": "name: longer than 6", "3": "name: missing", "9": "key exists"}
    assert good.count() + bad.count() == df.count()


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_dead_letters_come_back(spark, tmp_path, fmt):
    bad = spark.createDataFrame([(1, "a", "e1"), (2, None, "e2")], "id long, name string, _error string")
    letters = deadletter.dead_letters_json(bad, "task", "t") if fmt == "json" else deadletter.dead_letters_csv(bad, "t")
    deadletter.write_dead_letters(letters, str(tmp_path / "d"), fmt, by_date=True)
    back = deadletter.read_dead_letters(spark, str(tmp_path / "d"), T.StructType.fromDDL("id long, name string"), fmt)
    assert rows(back) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        deadletter.write_dead_letters(letters, str(tmp_path / "e"), "xml")


def test_row_function(spark):
    df = spark.createDataFrame([(1, "alice"), (2, "bob"), (3, None)], "id long, name string")
    def fn(r):
        if r["name"] == "bob":
            raise RuntimeError("no bob")
        return {"id": r["id"], "extra": 1} if r["id"] == 1 else r
    good, bad = deadletter.row_transform(df, fn, T.StructType.fromDDL("id long, name string"))
    assert rows(good) == [(1, None), (3, None)] and rows(bad) == [(2, "bob", "RuntimeError: no bob")]
    with pytest.raises(Exception, match="no bob"):
        deadletter.row_transform(df, fn, T.StructType.fromDDL("id long"), "abort")[0].collect()


def test_merge_and_changes(spark):
    target = spark.createDataFrame([(1, "old"), (2, "b"), (5, "e")], "id long, name string")
    source = spark.createDataFrame([(1, "x", 1), (1, "new", 2), (2, "b", 1), (3, "c", 1)], "id long, name string, n int")
    merged = write.merge(target, source, ["id"], ["n"])
    assert rows(merged) == [(1, "new"), (2, "b"), (3, "c"), (5, "e")]
    assert rows(write.merge(merged, source, ["id"], ["n"])) == rows(merged)
    last = write.latest_per_key(source, ["id"], ["n"])
    assert rows(write.merge_changes(target, last, ["id"])) == [(1, "update"), (2, "unchanged"), (3, "insert"), (5, "keep")]
    with pytest.raises(ValueError):
        write.merge(target, source, [])


def test_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        write.write_table(spark.range(3), path, must_exist=True)
    write.write_table(spark.range(3), path)
    write.write_table(spark.read.parquet(path).where("id > 0"), path)  # reads what it replaces
    write.write_table(spark.range(5, 7), path, "append")
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (5,), (6,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(ValueError):
        write.write_table(spark.range(1), path, "other")


def test_merge_into_keeps_every_row(spark, tmp_path):
    """Keys of other types, repeated and NULL keys, new columns, a plain table, another number of folders, a run that died."""
    path = str(tmp_path / "m")
    write.merge_into(spark, path, spark.range(200).withColumn("v", F.lit("a")), ["id"], buckets=8)
    for name, source in (("int", spark.range(50).select(F.col("id").cast("int").alias("ID"), F.lit("b").alias("v"))), ("text", spark.range(50, 60).select(F.col("id").cast("string").alias("id"), F.lit("c").alias("v")))):
        write.merge_into(spark, path, source, ["id"])
        got = write.merge_table(spark, path)
        assert (got.count(), got.select("id").distinct().count(), dict(got.dtypes)) == (200, 200, {"id": "bigint", "v": "string"}), name
    assert write.merge_table(spark, path).groupBy("v").count().where("v = 'b'").first()["count"] == 50
    with pytest.raises(Exception, match="does not fit"):
        write.merge_into(spark, path, spark.createDataFrame([("x", "d")], "id string, v string"), ["id"])
    for keys, n in ((["id"], 16), (["v"], 8)):
        with pytest.raises(ValueError):
            write.merge_into(spark, path, spark.range(1).withColumn("v", F.lit("e")), keys, buckets=n)
    assert write.merge_table(spark, path).where("v in ('a', 'b', 'c')").count() == 200
    twice = spark.createDataFrame([(7, "x"), (7, "y"), (None, "n"), (None, "n")], "id long, v string")
    write.merge_into(spark, path, twice, ["id"])
    got = write.merge_table(spark, path)
    assert got.where("id = 7").count() == 1 and got.where("id is null").count() == 2 and got.count() == 202
    wide = spark.createDataFrame([(8, "z", 1.5), (900, "z", 2.5)], "id long, v string, more double")
    write.merge_into(spark, path, wide, ["id"])
    assert write.merge_table(spark, path).columns == ["id", "v"]
    write.merge_into(spark, path, wide, ["id"], evolve=True)
    got = write.merge_table(spark, path)
    assert rows(got.where("more is not null")) == [(8, "z", 1.5), (900, "z", 2.5)] and got.count() == 203
    folder = next(p for p in sorted((tmp_path / "m").iterdir()) if p.name.startswith("key_bucket"))
    (tmp_path / "m" / "_old_x").mkdir()
    folder.rename(tmp_path / "m" / "_old_x" / folder.name)
    write.merge_into(spark, path, spark.createDataFrame([(900, "again")], "id long, v string"), ["id"])
    got = write.merge_table(spark, path)
    assert got.count() == 203 and not list((tmp_path / "m").glob("_old_*"))
    assert rows(got.where("id = 900")) == [(900, "again", 2.5)]  # a column that the source lacks keeps its value
    plain = str(tmp_path / "plain")
    write.write_table(spark.range(20).withColumn("v", F.lit("a")), plain)
    write.merge_into(spark, plain, spark.range(15, 25).withColumn("v", F.lit("b")), ["id"])
    assert {r["v"]: r["count"] for r in write.merge_table(spark, plain).groupBy("v").count().collect()} == {"a": 15, "b": 10}
    assert [p.name for p in tmp_path.iterdir() if "staging" in p.name] == []


def test_merge_into_rewrites_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "m")
    write.merge_into(spark, path, spark.range(200).withColumn("v", F.lit("a")), ["id"], buckets=8)
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "m").iterdir() if p.is_dir()}
    write.merge_into(spark, path, spark.createDataFrame([(7, "b"), (1000, "b")], "id long, v string"), ["id"], buckets=8)
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "m").iterdir() if p.is_dir()}
    table = spark.read.parquet(path)
    assert table.count() == 201 and table.where("v = 'b'").count() == 2
    assert 1 <= sum(before[k] != after.get(k) for k in before) <= 2


def test_evolution_profiles_and_order(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([(2, True)], "ID long, flag boolean")
    assert rows(write.evolve_append(a, b)) == [(1, "x", None), (2, None, True)]
    df = spark.createDataFrame([(1, True, dt.datetime(2024, 1, 2, 3, 4, 5), [1], b"x")], "i int, b boolean, t timestamp, a array<int>, y binary")
    assert tuple(write.conform_types(df, "sqlite").first()) == (1, 1, "2024-01-02 03:04:05", "[1]", bytearray(b"x"))
    assert dict(write.conform_types(df, "postgres").dtypes)["b"] == "boolean"
    assert write.parse_order(["a:ASC", "b:-1", "c"]) == [("a", True), ("b", False), ("c", True)]
    with pytest.raises(ValueError):
        write.parse_order(["a:up"])
    parts = write.clustered(spark.range(100), ["id:DESC"], 4).rdd.glom().map(lambda p: [r[0] for r in p]).collect()
    assert all(p == sorted(p, reverse=True) for p in parts)


def test_values(spark):
    equal = lambda a, b, x, y: spark.range(1).select(values.values_equal(F.lit(a).cast(x), F.lit(b).cast(y), x, y)).first()[0]
    n, d, s, t, b = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType(), T.BinaryType()
    assert equal(None, None, n, n) and not equal(None, 1, n, n) and equal(1, 1.0, n, d) and not equal(1, 2, n, n)
    assert equal(1, "1", n, s) and not equal("2024-01-01", "2024-01-01", t, s) and not equal("x", "x", b, s) and equal("x", "x", b, b)
    df = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "x long, y string, z string")
    assert len({r[0] for r in df.select(values.row_md5(df)).collect()}) == 2
    assert df.limit(1).select(values.row_preview(df)).first()[0] == "{x:1, y:NULL, z:a}"
    times = ["2024-01-02 03:04:05", "2024-01-02T03:04:05Z", "2024-01-02", "nothing", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in times], "c string").select(values.parse_time(F.col("c"))).collect()]
    assert [g is None for g in got] == [False, False, False, True, True]


def test_run_logs(spark, tmp_path):
    path = str(tmp_path / "h")
    for i in range(3):
        runlog.record_history(spark, {"id": str(i), "task_name": "t", "started_at": dt.datetime(2024, 1, i + 1), "rows_processed": i}, path)
    assert [r["id"] for r in runlog.recent_history([spark.read.parquet(path)], 2).collect()] == ["2", "1"]
    log = spark.createDataFrame([("a", "ok", 5, 0.5), ("a", "failed", 2, 7.0), ("b", "ok", 1, 20000.0)], "task string, status string, rows long, duration_ms double")
    assert tuple(runlog.run_summary(log).first())[:4] == (3, 2, 1, 8)
    assert rows(runlog.run_counters(log, ["task"])) == [("a", 1, 1, 5, 2), ("b", 1, 0, 1, 0)]
    hist = {(r["task"], r["le_ms"]): r["n_runs"] for r in runlog.duration_histogram(log, ["task"]).collect()}
    assert (hist["a", 1], hist["a", 10], hist["a", None], hist["b", 10000], hist["b", None]) == (1, 2, 2, 0, 1)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "é")], "k long, s string")
    assert tuple(profile.size_estimate(df).first()) == (3, 52)
    got = {r["key_columns"]: (r["n_null"], r["is_key"]) for r in profile.suggest_merge_keys(df, [["k"], ["s"], ["k", "s"]]).collect()}
    assert got == {"k": (1, False), "s": (0, False), "k,s": (1, False)}


def test_jdbc_round_trip(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(1, 101).withColumn("name", F.concat(F.lit("event_"), "id")).write.jdbc(url, "events", properties=props)
    df = scans.range_scan(spark, url, "events", "id", 4, props)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert scans.jdbc_scan(spark, url, 'SELECT * FROM events WHERE "id" > 90;', props).count() == 10
    late = scans.jdbc_scan(spark, url, "SELECT * FROM events;", props, key="id", cursor=60, shards=3)
    assert late.rdd.getNumPartitions() == 3 and rows(late.select("id")) == rows(spark.range(61, 101))
    assert scans.jdbc_scan(spark, url, "SELECT * FROM events", props, key="id", cursor=100, shards=3).count() == 0


def test_a_repeated_merge_adds_nothing(spark, tmp_path):
    """Rows with a NULL in their key: as often as the target lacks them, whatever the rest of them is."""
    ddl = "k long, l string, v string"
    source = spark.createDataFrame([(None, "a", "n"), (None, "a", "n"), (1, None, "m"), (1, "a", "x"), (None, None, None)], ddl)
    target = spark.createDataFrame([(None, "a", "n"), (None, "a", "other"), (1, "a", "old"), (2, "b", "kept")], ddl)
    once = write.merge(target, source, ["k", "l"])
    assert rows(once) == sorted([(None, "a", "n"), (None, "a", "n"), (None, "a", "other"), (1, None, "m"), (1, "a", "x"), (2, "b", "kept"), (None, None, None)], key=repr)
    assert rows(write.merge(once, source, ["k", "l"])) == rows(once)
    assert write.inserted_keys(target, source, ["k", "l"]) == 3 and write.inserted_keys(once, source, ["k", "l"]) == 0
    assert [r["action"] for r in write.merge_changes(once, source, ["k", "l"]).where("k is null or l is null").collect()] == ["keep"] * 5
    path = str(tmp_path / "m")
    for _ in range(3):
        write.merge_into(spark, path, source, ["k", "l"], buckets=4)
    assert rows(write.merge_table(spark, path)) == rows(source)
    maps = spark.createDataFrame([(None, {"b": 1, "a": 2})], "k long, m map<string,int>")
    swapped = spark.createDataFrame([(None, {"a": 2, "b": 1})], "k long, m map<string,int>")
    assert write.merge(maps, swapped, ["k"]).count() == 1


def test_digest_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "DIGEST_ROWS", 1000)
    equal = spark.range(2_000_000).select(F.lit("same").alias("v"))
    digest = reconcile.table_digest(equal).first()[0]
    assert digest == reconcile.table_digest(equal.repartition(7)).first()[0] != reconcile.table_digest(equal.limit(1_999_999)).first()[0]
    bars = [spark.createDataFrame([r], "x string, y string") for r in (("a|b", "c"), ("a", "b|c"))]
    assert len({reconcile.table_digest(b).first()[0] for b in bars}) == 2


def test_equal_maps_are_equal(spark):
    ddl = "m map<string,int>, s struct<n:map<int,array<map<string,string>>>>"
    a = spark.createDataFrame([({"x": 1, "y": 2}, ({1: [{"p": "q", "r": None}], 2: None},)), (None, None)], ddl)
    b = spark.createDataFrame([({"y": 2, "x": 1}, ({2: None, 1: [{"r": None, "p": "q"}]},)), (None, None)], ddl)
    assert reconcile.validate_checksum(a, b).first()["passed"]
    c = spark.createDataFrame([({"y": 1, "x": 2}, ({2: None, 1: [{"r": None, "p": "q"}]},)), (None, None)], ddl)
    assert not reconcile.validate_checksum(a, c).first()["passed"]


@pytest.mark.parametrize("kind", ["number", "double", "time", "text", "two columns"])
def test_equal_shards(spark, tmp_path, kind):
    """Nine tenths of the rows in a hundredth of the range, NULL keys, repeated keys: every row once, no shard over twice its share."""
    n, skewed = 8, F.when(F.col("id") % 10 > 0, F.col("id") % 997).otherwise(F.col("id") * 1000)
    key = {"number": skewed, "double": skewed / 7, "time": F.timestamp_seconds(skewed), "text": F.concat(F.lit("key "), skewed.cast("string")), "two columns": F.when(F.col("id") % 10 > 0, 5).otherwise(F.col("id"))}[kind]
    df = spark.range(20_000).select(F.when(F.col("id") % 100 > 0, key).alias("k"), "id")
    keys = ["k", "id"] if kind == "two columns" else ["k"]
    shards = scans.equal_shards(df, keys, n)
    counts = [scans.in_shard(df, keys, s).count() for s in shards]
    assert sum(counts) == 20_000 and counts[-1] == 200 and max(counts[:-1]) <= 2 * 19_800 / n and len(counts) == n + 1
    assert scans.equal_scan(df, keys, n).distinct().count() == 20_000
    later = spark.createDataFrame([(None, -5), (None, 10**9)], "k string, id long").select(F.col("k").cast(df.schema["k"].dataType).alias("k"), "id")
    assert sum(scans.in_shard(df.unionByName(later), keys, s).count() for s in shards) == 20_002
    df.write.parquet(str(tmp_path / "t"))
    assert "GreaterThanOrEqual(k," in scans.in_shard(spark.read.parquet(str(tmp_path / "t")), keys, shards[3])._jdf.queryExecution().toString()
    assert scans.equal_scan(df.limit(0), keys, 3).count() == 0
    with pytest.raises(ValueError):
        scans.equal_shards(df, keys, 1)


def test_equal_ranges_of_a_database(spark, tmp_path):
    url, props = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(1000).select(F.when(F.col("id") % 5 > 0, F.when(F.col("id") < 900, F.col("id") % 90).otherwise(F.col("id") * 1000)).alias("k"), "id")
    df.write.jdbc(url, "skewed", properties=props)
    got = scans.equal_range_scan(spark, url, "skewed", "k", 4, props)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert got.count() == got.select("id").distinct().count() == 1000 and max(r["count"] for r in sizes) <= 400
    assert scans.equal_range_scan(spark, url, "skewed", "k", 4, props, cursor=80).where("k <= 80 or k is null").count() == 0


def test_find_keys(spark):
    df = spark.range(3000).select((F.col("id") / 10).cast("int").alias("a"), (F.col("id") % 10).alias("b"), F.lit("x").alias("c"), F.when(F.col("id") > 0, F.col("id")).alias("with_null"), F.col("id").cast("string").alias("s"), F.array("id").alias("list"))
    keys = lambda *a, **k: [r["key_columns"] for r in profile.find_keys(*a, **k).collect()]
    assert keys(df, 2) == ["s", "a,b"] and keys(df.drop("s"), 1) == [] and keys(df.drop("s"), 3) == ["a,b"]
    nearly = df.select("a", "b").unionByName(df.select("a", "b").limit(1))  # one repeated row: the estimate is near, the count is not
    assert keys(nearly, 2) == []
    three = spark.range(1000).select((F.col("id") % 10).alias("x"), (F.col("id") / 10).cast("int").alias("yz")).select("x", (F.col("yz") % 10).alias("y"), (F.col("yz") / 10).cast("int").alias("z"))
    assert keys(three, 2) == [] and keys(three, 3) == ["x,y,z"] and keys(three, 3, columns=["x", "y"]) == []
    assert all(r["is_key"] and r["n_null"] == 0 for r in profile.find_keys(df, 2).collect())
