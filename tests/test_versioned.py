import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableflow.operators import versioned, write
from tableflow.operators.versioned import Conflict, StaleCursor, VersionedTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.append(spark.range(5))
    pinned = t.read()
    t.append(spark.range(5, 8))
    t.replace(t.read().where("id > 3"))  # reads what it replaces
    wide = spark.createDataFrame([(9, "x")], "ID long, more string")
    t.append(wide)
    t.append(wide, evolve=True)
    assert [t.read(v).count() for v in range(5)] == [5, 8, 4, 5, 6] and pinned.count() == 5
    assert t.read(3).columns == ["id"] and rows(t.read().where("id = 9")) == [(9, "x"), (9, None)]
    assert [r["operation"] for r in t.history().orderBy("version").collect()] == ["replace", "append", "replace", "append", "append"]
    with pytest.raises(ValueError):
        t.read(9)


def test_long_logs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "FULL", 3)
    t = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(8):
        t.append(spark.range(i, i + 1), cursor=("load", None if i == 0 else i - 1, i))
    assert rows(t.read()) == [(i,) for i in range(8)] and t.cursor("load") == "7"
    assert [t.snapshot(v).cursors["load"] for v in range(8)] == [str(i) for i in range(8)]


def test_a_load_is_finished_once(spark, tmp_path):
    """The cursor is in the same commit as the rows: a run that died before it left nothing, one that repeats a round is refused."""
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.append(spark.range(3), cursor=("load", None, 2))
    t._files(spark.range(3, 6), ())  # a run that wrote its files and died
    assert t.read().count() == 3 and t.cursor("load") == "2"
    t.append(spark.range(3, 6), cursor=("load", 2, 5))
    with pytest.raises(StaleCursor):
        t.append(spark.range(3, 6), cursor=("load", 2, 5))
    with pytest.raises(StaleCursor):
        t.merge(spark.range(3, 6), ["id"], cursor=("load", 2, 5))
    assert t.read().count() == 6 and t.cursor("other", 1) == 1


def test_two_writers_lose_no_rows(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(100).withColumn("v", F.lit("a")), ["id"], parts=4)
    base = t.snapshot()
    t._commit(base, "append", base.schema, [], [], [], base.keys, {})
    with pytest.raises(Conflict):
        t._commit(base, "append", base.schema, [], [], [], base.keys, {})
    errors = []

    def work(n):
        try:
            for i in range(3):
                own = VersionedTable(spark, str(tmp_path / "t"))
                own.merge(spark.range(n * 10 + i, 100 + n, 40).withColumn("v", F.lit(f"{n}")), ["id"])
                own.append(spark.range(1000 + 10 * n + i, 1001 + 10 * n + i).withColumn("v", F.lit("new")))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(3)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    got = t.read()
    assert not errors and got.where("v = 'new'").count() == 9
    assert got.where("id < 100").count() == 100 == got.where("id < 100").select("id").distinct().count()


def test_a_reader_sees_whole_versions(spark, tmp_path):
    """While merges raise all rows together, no reader meets rows of two versions."""
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(50).withColumn("n", F.lit(0)), ["id"], parts=3)
    seen, stop = set(), threading.Event()

    def watch():
        while not stop.is_set():
            r = VersionedTable(spark, str(tmp_path / "t")).read().agg(F.count("*"), F.min("n"), F.max("n")).first()
            seen.add(tuple(r))

    watcher = threading.Thread(target=watch)
    watcher.start()
    for n in range(1, 5):
        t.merge(spark.range(50).withColumn("n", F.lit(n)), ["id"])
    stop.set()
    watcher.join()
    assert seen and all(count == 50 and low == high for count, low, high in seen)


def test_merge_as_the_plain_one(spark, tmp_path):
    """Same rows as write.merge: repeated keys, NULL keys, two key columns, missing and new columns, other types; again changes nothing."""
    ddl = "k long, l string, v string, w int"
    first = spark.createDataFrame([(i % 7, f"l{i % 11}", "a", i) for i in range(70)] + [(None, "x", "n", 1), (3, None, "n", 2)], ddl)
    t, plain = VersionedTable(spark, str(tmp_path / "t")), write.one_row_per_key(first, ["k", "l"], ["w"])
    t.merge(first, ["K", "l"], ["w"])
    assert rows(t.read()) == rows(plain)
    for source, keys in ((spark.createDataFrame([(3, "l3", "b"), (3, "l3", "c"), (50, "new", "d"), (None, "x", "other")], "k int, l string, v string"), ["k", "l"]), (first.where("k < 3"), ["l", "k"]), (spark.createDataFrame([("4", "l4")], "k string, l string"), ["k", "l"])):
        plain = write.merge(plain, source, keys).persist()
        for _ in range(2 if source.count() == 4 else 1):
            t.merge(source, keys)
            assert rows(t.read()) == rows(plain)
    with pytest.raises(ValueError):
        t.merge(first, ["k"])
    t.merge(spark.createDataFrame([(50, "new", 1.5)], "k long, l string, more double"), ["k", "l"], evolve=True)
    assert rows(t.read().where("more is not null")) == [(50, "new", "d", None, 1.5)]


@pytest.mark.parametrize("spread", [False, True])
def test_few_keys_rewrite_few_files(spark, tmp_path, monkeypatch, spread):
    """Ten keys into hundreds of files: bounds and filters leave few to look at, and only those with a key are written again."""
    t = VersionedTable(spark, str(tmp_path / "t"))
    df = spark.range(6000).select((F.xxhash64("id") if spread else F.col("id")).alias("k"), F.lit("a").alias("v"))
    t.replace(df, ["k"], parts=300)
    before = t.snapshot()
    keys = df.orderBy(F.xxhash64("k")).limit(10).withColumn("v", F.lit("b"))
    assert len(t.candidates(before, keys.select("k"))) <= 12
    t.merge(keys.unionByName(spark.createDataFrame([(10**12, "b")], "k long, v string")), ["k"])
    after = t.snapshot()
    assert 280 <= len(before.files) and len(set(before.files) - set(after.files)) <= 10
    assert t.read().where("v = 'b'").count() == 11 and t.read().count() == 6001
    t.merge(spark.createDataFrame([(10**12 + 1, "c")], "k long, v string"), ["k"])  # a new key rewrites nothing
    assert set(after.files) < set(t.snapshot().files)
    monkeypatch.setattr(versioned, "ASKED", 5)  # more keys than the filters are asked about
    many = t.snapshot()
    t.merge(keys.withColumn("v", F.lit("d")), ["k"])
    assert t.read().where("v = 'd'").count() == 10 and len(set(many.files) - set(t.snapshot().files)) <= 10


def test_bloom():
    rng = np.random.default_rng(1)
    held, others = (rng.integers(-(2**63), 2**63 - 1, 20_000) for _ in range(2))
    made = versioned.bloom(held)
    assert versioned.may_hold(made, held).all() and versioned.may_hold(made, others).mean() < 0.02
    assert not versioned.may_hold(versioned.bloom(held[:0]), others[:50]).any()


def test_vacuum(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(4):
        t.replace(spark.range(10 + i), ["id"], parts=2)
    t._files(spark.range(5), ())
    assert t.vacuum(keep=2) == 0  # too young to be nobody's
    assert t.vacuum(keep=2, older_s=-60) >= 3
    assert [t.read(v).count() for v in (2, 3)] == [12, 13]
    t.merge(spark.range(100, 101), ["id"])
    assert t.read().count() == 14


def test_tasks_and_rounds_into_versioned_tables(spark, tmp_path, monkeypatch):
    from tableflow.plans.spec import TaskSpec
    from tableflow.plans.task import run_task
    from tableflow.streaming import cdc

    target = f"versioned:{tmp_path}/t"
    spec = lambda n, **more: TaskSpec("load", target, spark.range(n), mode="append", resume_key="id", state="target", validate="row_count", **more)
    assert [run_task(spark, spec(n)).rows for n in (5, 5, 8)] == [5, 0, 3]
    merged = run_task(spark, TaskSpec("m", target, spark.range(6, 12), mode="merge", merge_keys=["id"], validate="checksum"))
    assert merged.validation == "passed" and rows(VersionedTable(spark, str(tmp_path / "t")).read()) == [(i,) for i in sorted(range(12), key=lambda i: repr((i,)))]
    with pytest.raises(ValueError):
        TaskSpec("x", "folder", spark.range(1), state="target", resume_key="id")
    args = (f"versioned:{tmp_path}/p", "", "poll")
    assert cdc.poll_once(spark, spark.range(4), "id", *args).rows == 4
    real = VersionedTable._commit

    def dies(*a):
        raise OSError("killed")

    monkeypatch.setattr(VersionedTable, "_commit", dies)
    with pytest.raises(OSError):
        cdc.poll_once(spark, spark.range(7), "id", *args)
    monkeypatch.setattr(VersionedTable, "_commit", real)
    assert cdc.poll_once(spark, spark.range(7), "id", *args) == cdc.PollResult(3, 6) and cdc.poll_once(spark, spark.range(7), "id", *args).rows == 0
    assert VersionedTable(spark, str(tmp_path / "p")).read().count() == 7
