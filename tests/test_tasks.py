import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.masks import MaskRule
from tableflow.operators import write
from tableflow.operators.quality import AssertionFailed, Rule
from tableflow.plans.spec import TaskSpec
from tableflow.plans.task import cdc_sync, run_task
from tableflow.streaming import cdc


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_with_everything(spark, tmp_path):
    users = spark.createDataFrame([(1, "13800138000", "a"), (2, None, "b"), (3, "138123", "c")], "id long, phone string, name string")
    spec = TaskSpec(
        "users", str(tmp_path / "out"), users, columns=[("id", "user_id"), ("phone", "phone"), ("name", "name")], masks=[MaskRule("phone", "phone_cn")], transforms={"name": "upper(?)"},
        rules=[Rule("not_null", column="id"), Rule("not_null", column="phone", on_fail="dlq")], dead_letters=str(tmp_path / "dlq"), validate="checksum", history=str(tmp_path / "history"), cluster=["user_id"],
    )
    result = run_task(spark, spec)
    assert (result.rows, result.failed, result.validation) == (3, 1, "passed")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(1, "138****8000", "A"), (2, None, "B"), (3, "1****3", "C")]
    audit = spark.read.parquet(str(tmp_path / "history")).first()
    assert (audit["rows_processed"], audit["rows_failed"], audit["validation_result"]) == (3, 1, "passed")


def test_abort_leaves_the_target_alone(spark, tmp_path):
    spec = TaskSpec("t", str(tmp_path / "out"), spark.range(3), rules=[Rule("range", column="id", max=1)], history=str(tmp_path / "h"))
    with pytest.raises(AssertionFailed):
        run_task(spark, spec)
    assert not (tmp_path / "out").exists()
    assert "range" in spark.read.parquet(str(tmp_path / "h")).first()["error_message"]


def test_resume_append_then_merge(spark, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    df = spark.range(1, 6).withColumn("v", F.lit("a"))
    first = run_task(spark, TaskSpec("e", target, df, mode="append", resume_key="id", state=state, validate="row_count"))
    second = run_task(spark, TaskSpec("e", target, df.unionByName(spark.range(6, 9).withColumn("v", F.lit("b"))), mode="append", resume_key="id", state=state, validate="row_count"))
    assert (first.rows, first.cursor, second.rows, second.cursor, second.validation) == (5, 5, 3, 8, "passed")
    merged = str(tmp_path / "merged")
    for v in ("x", "y"):
        result = run_task(spark, TaskSpec("m", merged, spark.range(4).withColumn("v", F.lit(v)), mode="upsert", merge_keys=["id"], validate="sample"))
    assert result.validation == "passed" and rows(spark.read.parquet(merged).select("id", "v")) == [(i, "y") for i in range(4)]


def test_evolution_template_and_row_function(spark, tmp_path):
    target = str(tmp_path / "out")
    run_task(spark, TaskSpec("a", target, spark.range(2)))
    run_task(spark, TaskSpec("a", target, spark.range(2, 4).withColumn("more", F.lit("m")), mode="append", schema_evolution=True))
    assert rows(spark.read.option("mergeSchema", True).parquet(target)) == [(0, None), (1, None), (2, "m"), (3, "m")]
    spec = TaskSpec(
        "f", str(tmp_path / "f"), "SELECT id FROM src WHERE id > :last_value", views={"src": spark.range(10)}, resume_key="id", initial_cursor=6, mode="append",
        transform_row=lambda r: {"twice": r["id"] * 2} if r["id"] != 8 else None, transform_schema=T.StructType.fromDDL("twice long"), dead_letters=str(tmp_path / "d"),
    )
    result = run_task(spark, spec)
    assert (result.rows, result.failed) == (2, 1) and rows(spark.read.parquet(str(tmp_path / "f"))) == [(14,), (18,)]


@pytest.mark.parametrize("broken", [{"mode": "x"}, {"mode": "merge"}, {"state": "s"}, {"schema_evolution": True}, {"validate": "y"}, {"rules": [Rule("not_null", column="a", on_fail="dlq")]}, {"target": ""}])
def test_bad_specs(broken):
    with pytest.raises(ValueError):
        TaskSpec(**({"name": "n", "target": "t", "source": "SELECT 1"} | broken))


def test_poll_rounds(spark, tmp_path):
    args = (str(tmp_path / "t"), str(tmp_path / "s"), cdc.task_key("a", "b", "t"))
    e = spark.createDataFrame([(1, "a", 100), (2, "b", 200), (3, "c", 300), (4, "d", 400)], "id long, name string, at long")
    assert cdc.poll_once(spark, e.where("at <= 200"), "at", *args) == cdc.PollResult(2, 200)
    assert cdc.poll_once(spark, e, "at", *args) == cdc.PollResult(2, 400)
    assert cdc.poll_once(spark, e, "at", *args).rows == 0
    assert spark.read.parquet(args[0]).count() == 4


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_streams_restart_without_repeats(spark, tmp_path, mode):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "id long, k long, v string"
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 1, "c")], schema).coalesce(1).write.parquet(source)
    def run():
        q = cdc.cdc_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), target, check, mode, ["k"], ["id"])
        q.awaitTermination(120)
        return q
    with cdc.ProgressLog(spark, "t", str(tmp_path / "log")) as log:
        run()
    assert rows(log.read().where("rows > 0").select("task", "rows", "status")) == [("t", 3, "ok")]
    spark.createDataFrame([(4, 2, "d"), (5, 3, "e")], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    got = rows(spark.read.parquet(target).select("id", "k", "v"))
    assert got == ([(3, 1, "c"), (4, 2, "d"), (5, 3, "e")] if mode == "merge" else [(1, 1, "a"), (2, 2, "b"), (3, 1, "c"), (4, 2, "d"), (5, 3, "e")])


def test_rows_pass_the_function_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(r):
        seen.add(1)
        return r if r["id"] % 10 else None

    spec = TaskSpec("o", str(tmp_path / "out"), spark.range(100), transform_row=once, transform_schema=T.StructType.fromDDL("id long"), transforms={"id": "? * 2"}, rules=[Rule("not_null", column="id"), Rule("range", column="id", max=150, on_fail="dlq")], dead_letters=str(tmp_path / "d"), validate="checksum")
    result = run_task(spark, spec)
    assert (seen.value, result.rows, result.failed, result.validation) == (100, 90, 10 + 22, "passed")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d", "out"]


@pytest.mark.parametrize("validate", ["row_count", "checksum", "sample"])
def test_merges_are_validated(spark, tmp_path, validate, monkeypatch):
    target = str(tmp_path / "m")
    for ids, ddl, rows_after in ((range(200), "long", 200), (range(150, 300), "int", 300), ([7, 7, 301], "string", 301)):
        df = spark.createDataFrame([(i,) for i in ids], "i long").select(F.col("i").cast(ddl).alias("id"), F.lit(ddl).alias("v"))
        result = run_task(spark, TaskSpec("m", target, df, mode="merge", merge_keys=["id"], validate=validate))
        assert result.validation == "passed" and spark.read.parquet(target).count() == rows_after
    wide = spark.createDataFrame([(5, "w", 1)], "id long, v string, n int")
    assert run_task(spark, TaskSpec("m", target, wide, mode="merge", merge_keys=["id"], validate=validate, schema_evolution=True)).validation == "passed"
    real = write.merge_into
    monkeypatch.setattr(write, "merge_into", lambda spark, path, source, *a, **k: real(spark, path, source.where("id <> 1000"), *a, **k))
    lost = run_task(spark, TaskSpec("m", target, spark.createDataFrame([(1000, "x", 1)], "id long, v string, n int"), mode="merge", merge_keys=["id"], validate=validate))
    assert lost.validation not in ("", "passed")


def test_appends_are_validated_as_multisets(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "a")
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert [run_task(spark, TaskSpec("a", target, df, mode="append", validate="checksum")).validation for _ in range(2)] == ["passed", "passed"]
    real = write.write_table
    monkeypatch.setattr(write, "write_table", lambda df, *a, **k: real(df.distinct(), *a, **k))
    assert run_task(spark, TaskSpec("a", target, df, mode="append", validate="checksum")).validation.startswith("checksum")


def test_catalog_and_database_targets(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    to_db = {"target": url, "options": {"dbtable": "results", **props}, "staging": str(tmp_path / "stage")}
    first = run_task(spark, TaskSpec("j", source=spark.range(1, 41), validate="checksum", **to_db))
    second = run_task(spark, TaskSpec("j", source=spark.range(41, 51), mode="append", validate="row_count", **to_db))
    assert (first.rows, first.validation, second.rows, second.validation) == (40, "passed", 10, "passed")
    source = {"url": url, "query": "SELECT * FROM results;", "properties": props}
    spec = TaskSpec("c", "catalog:from_db", source, mode="append", resume_key="id", initial_cursor=20, shards=3, validate="checksum", rules=[Rule("not_null", column="id")])
    try:
        assert (result := run_task(spark, spec)).rows == 30 and result.validation == "passed"
        more = TaskSpec("c", "catalog:from_db", spark.createDataFrame([("x", 99)], "more string, id long"), mode="append", schema_evolution=True)
        run_task(spark, more)
        assert rows(spark.table("from_db").where("id > 49")) == [(50, None), (99, "x")]
        run_task(spark, TaskSpec("c", "catalog:from_db", spark.range(2)))
        assert rows(spark.table("from_db")) == [(0,), (1,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS from_db")
    for broken in ({"mode": "merge", "merge_keys": ["id"], "target": "jdbc:x", "options": {"dbtable": "t"}, "schema_evolution": True}, {"target": "jdbc:x"}, {"shards": 2}):
        with pytest.raises(ValueError):
            TaskSpec(**({"name": "n", "target": "t", "source": spark.range(1)} | broken))


def test_rounds_of_several_tasks(spark, tmp_path):
    """Two tasks with an interval and one without: a first run of all, then rounds of the two at the smaller interval."""
    source = str(tmp_path / "src")
    spark.range(5).write.parquet(source)
    waited = []

    def more(seconds):
        waited.append(seconds)
        n = spark.read.parquet(source).count()
        spark.range(n, n + 3).write.mode("append").parquet(source)

    table = lambda: f"SELECT * FROM parquet.`{source}` WHERE id > :last_value"
    specs = [TaskSpec(n, str(tmp_path / n), table(), mode="append", resume_key="id", initial_cursor=-1, state=str(tmp_path / "state"), interval=s) for n, s in (("a", 5.0), ("b", 2.0))]
    specs.append(TaskSpec("once", str(tmp_path / "once"), spark.range(2)))
    results = cdc_sync(spark, specs, rounds=2, wait=more)
    assert waited == [2.0, 2.0] and [[r.rows for r in x] for x in results] == [[5, 5, 2], [3, 3], [3, 3]]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 11
    with pytest.raises(ValueError):
        cdc_sync(spark, [TaskSpec("x", str(tmp_path / "x"), spark.range(1), interval=1.0)], 1)


def test_hooks_run_in_order(spark, tmp_path):
    spark.sql(f"CREATE TABLE hooks (n INT, what STRING) USING parquet LOCATION '{tmp_path}/hooks'")
    try:
        run_task(spark, TaskSpec("h", str(tmp_path / "out"), spark.range(3), pre_sql=["INSERT INTO hooks VALUES (1, 'before');"], post_sql=["INSERT INTO hooks SELECT count(*), 'after' FROM parquet.`" + str(tmp_path / "out") + "`"]))
        assert rows(spark.table("hooks")) == [(1, "before"), (3, "after")]
        with pytest.raises(Exception, match="nothing_here"):
            run_task(spark, TaskSpec("h", str(tmp_path / "no"), spark.range(3), pre_sql=["DROP TABLE nothing_here"]))
        assert not (tmp_path / "no").exists()
    finally:
        spark.sql("DROP TABLE hooks")


def test_state_tables_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cdc, "COMPACT", 4)
    path = str(tmp_path / "s")
    for i in range(12):
        cdc.save_cursor(spark, path, "ab"[i % 2], i)
    assert (cdc.load_cursor(spark, path, "a"), cdc.load_cursor(spark, path, "b")) == ("10", "11")
    assert len(list((tmp_path / "s").glob("*.parquet"))) <= 4


@pytest.mark.parametrize("how", [{"state": True}, {"shards": 4}, {"state": True, "shards": 3}, {}])
def test_rows_without_a_resume_key_are_loaded_once(spark, tmp_path, how):
    df = spark.range(100).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("k"), "id")
    target, state = str(tmp_path / "t"), {"state": str(tmp_path / "s")} if "state" in how else {}
    spec = lambda source: TaskSpec("n", target, source, mode="append", resume_key="k", shards=how.get("shards", 1), validate="row_count", **state)
    assert (first := run_task(spark, spec(df))).rows == 100 and first.validation == "passed"
    assert spark.read.parquet(target).distinct().count() == 100
    if state:
        more = df.unionByName(spark.range(100, 120).select(F.col("id").alias("k"), "id"))
        assert run_task(spark, spec(more)).rows == 20 and spark.read.parquet(target).distinct().count() == spark.read.parquet(target).count() == 120


def test_rows_without_a_key_wait_for_a_cursor(spark, tmp_path):
    keyless = spark.range(3).select(F.lit(None).cast("long").alias("k"), "id")
    spec = lambda source: TaskSpec("w", str(tmp_path / "t"), source, mode="append", resume_key="k", state=str(tmp_path / "s"))
    args = (str(tmp_path / "p"), str(tmp_path / "ps"), "p")
    assert [run_task(spark, spec(keyless)).rows for _ in range(2)] == [0, 0] and [cdc.poll_once(spark, keyless, "k", *args).rows for _ in range(2)] == [0, 0]
    both = keyless.unionByName(spark.range(10, 12).select(F.col("id").alias("k"), "id"))
    assert [run_task(spark, spec(both)).rows for _ in range(2)] == [5, 0] and [cdc.poll_once(spark, both, "k", *args).rows for _ in range(2)] == [5, 0]


def test_streams_are_logged_whole(spark, tmp_path):
    """More batches than Spark's own progress keeps; then a stream that fails."""
    source = str(tmp_path / "in")
    spark.range(105).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(source)
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    with cdc.ProgressLog(spark, "t", str(tmp_path / "log")) as log:
        stream().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = log.read().where("rows > 0")
    assert got.count() == got.select("batch_id").distinct().count() == 105 and got.agg(F.sum("rows")).first()[0] == 105
    with cdc.ProgressLog(spark, "f", str(tmp_path / "flog")) as log:
        q = stream().select(F.raise_error(F.lit("broken")).alias("x")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "fc")).trigger(availableNow=True).start()
        with pytest.raises(Exception, match="broken"):
            q.awaitTermination()
    assert rows(log.read().select("task", "status")) == [("f", "failed")]


def test_catalog_tables_replaced_from_themselves(spark, tmp_path):
    kept = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = kept()
    try:
        run_task(spark, TaskSpec("a", "catalog:self_made", spark.range(10)))
        for n in (9, 8):
            run_task(spark, TaskSpec("a", "catalog:self_made", spark.table("self_made").where(f"id < {n}"), rules=[Rule("not_null", column="id")], validate="checksum"))
            assert spark.table("self_made").count() == n
        assert kept() <= before
    finally:
        spark.sql("DROP TABLE IF EXISTS self_made")


@pytest.mark.parametrize("target", ["{}/t", "versioned:{}/t"])
@pytest.mark.parametrize("mode", ["append", "merge"])
def test_late_rows_are_loaded_once(spark, tmp_path, target, mode):
    """Rows behind the cursor within the lateness are taken by the next round, once; older ones are not, and none overwrites a newer one."""
    target = target.format(tmp_path)
    args = ("at", target, str(tmp_path / "s"), "late", mode, ["id"])
    made = lambda rows: spark.createDataFrame(rows, "id long, at long, v string")
    first = [(1, 10, "a"), (2, 20, "b"), (3, 30, "c")]
    assert cdc.poll_once(spark, made(first), *args, lateness=15) == cdc.PollResult(3, 30)
    late = [*first, (4, 18, "late"), (5, 12, "too late"), (4, 18, "late")] if mode == "merge" else [*first, (4, 18, "late"), (5, 12, "too late")]
    assert int(cdc.poll_once(spark, made(late), *args, lateness=15).cursor) == 30
    assert cdc.poll_once(spark, made(late), *args, lateness=15).rows == 0
    newer = [*late, (6, 40, "new")] + ([(3, 28, "older")] if mode == "merge" else [])
    assert cdc.poll_once(spark, made(newer), *args, lateness=15) == cdc.PollResult(1, 40)
    got = write.Target(spark, target).read()
    assert rows(got.select("id", "v")) == [(1, "a"), (2, "b"), (3, "c"), (4, "late"), (6, "new")]
    with pytest.raises(ValueError):
        cdc.poll_once(spark, made(newer), *args[:5], lateness=15)


def test_late_repeats_of_a_stream(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long, at timestamp"
    stamp = "timestamp'2026-01-01 00:00:00'"
    batches = ["(1, 0), (2, 60)", "(1, 0), (3, 30)", "(2, 60), (3, 30), (4, 90)"]
    for b in batches:
        spark.sql(f"SELECT CAST(id AS BIGINT) AS id, {stamp} + make_interval(0, 0, 0, 0, 0, m) AS at FROM VALUES {b} t(id, m)").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        cdc.cdc_stream(cdc.without_late_repeats(stream, ["id"], "at", "3 hours"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id")) == [(1,), (2,), (3,), (4,)]


def test_slow_rows_are_dead_letters(spark, tmp_path):
    """One row sleeps, one never ends, one ends the process: three letters, all others load; and quickly."""
    import os
    import time

    def change(r):
        if r["id"] == 500:
            time.sleep(600)
        if r["id"] == 501:
            os._exit(3)
        while r["id"] == 502:
            pass
        return {"id": r["id"], "twice": 2 * r["id"]}

    spec = TaskSpec("slow", str(tmp_path / "t"), spark.range(1000), transform_row=change, transform_schema=T.StructType.fromDDL("id long, twice long"), transform_limit=0.5, dead_letters=str(tmp_path / "d"))
    began = time.time()
    result = run_task(spark, spec)
    assert (result.rows, result.failed) == (997, 3) and time.time() - began < 120
    letters = spark.read.schema("row array<string>, error string").json(str(tmp_path / "d"))
    assert {r["row"][0]: r["error"].split(":")[0] for r in letters.collect()} == {"500": "TimeoutError", "501": "RuntimeError", "502": "TimeoutError"}
    with pytest.raises(Exception, match="TimeoutError"):
        run_task(spark, TaskSpec("slow", str(tmp_path / "u"), spark.range(498, 501), transform_row=change, transform_schema=T.StructType.fromDDL("id long"), transform_limit=0.2))


@pytest.mark.parametrize(("mode", "target"), [("append", "{}/a"), ("replace", "{}/r"), ("append", "versioned:{}/v"), ("replace", "versioned:{}/w"), ("append", "catalog:counted_by_the_write"), ("replace", "catalog:replaced_and_counted")])
def test_writes_count_their_rows_without_a_scan(spark, tmp_path, monkeypatch, mode, target):
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    scans, frame = [], type(spark.range(1))
    for kind in (frame.count, frame.isEmpty):
        monkeypatch.setattr(frame, kind.__name__, lambda df, kind=kind: scans.append(1) or kind(df))
    spec = TaskSpec("n", target.format(tmp_path), spark.range(120).mapInArrow(looked, "id long"), mode=mode)
    assert [run_task(spark, spec).rows for _ in range(2)] == [120, 120] and seen.value == 240 and not scans
    assert run_task(spark, TaskSpec("none", spec.target, spark.range(120).where("id < 0"), mode=mode)).rows == 0
    monkeypatch.undo()
    checked = TaskSpec("n", spec.target, spark.range(120, 200).mapInArrow(looked, "id long"), mode=mode, validate="row_count")
    result = run_task(spark, checked)
    assert (result.rows, result.validation, seen.value) == (80, "passed", 320)
    spark.sql("DROP TABLE IF EXISTS counted_by_the_write")
    spark.sql("DROP TABLE IF EXISTS replaced_and_counted")
