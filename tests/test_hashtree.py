import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tableflow.operators import hashtree, reconcile


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def unequal(d):
    return rows(d.rows.where("state <> 'equal'"))


@pytest.fixture
def pair(spark, tmp_path):
    """Two tables in order of their key that differ in three of 50,000 keys: a value, a row too few, a row too many."""
    base = spark.range(50_000).select((F.col("id") * 3).alias("id"), (F.col("id") % 100).alias("v"), F.concat(F.lit("n"), "id").alias("name"))
    other = base.where("id <> 60000").withColumn("v", F.when(F.col("id") == 30_000, -1).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(100_001, 1, "new")], "id long, v long, name string"))
    for name, df in (("a", base), ("b", other)):
        df.repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))


def test_only_ranges_that_differ_are_read(spark, pair, tmp_path):
    a, b = pair
    tree = hashtree.build(a, ["ID"], leaves=500)
    tree.save(str(tmp_path / "tree"))
    kept = hashtree.load_tree(spark, str(tmp_path / "tree"))
    other = hashtree.build(b, ["id"], kept.cuts)
    leaves = hashtree.differing(kept, other)
    assert len(leaves) == 3
    seen = Observation("seen")
    read = hashtree.rows_of(a, kept, leaves).observe(seen, F.count("*").alias("n"))
    assert read.count() == seen.get["n"] < 0.05 * 50_000
    found = hashtree.tree_diff(a, b, kept, other)
    assert unequal(found) == unequal(reconcile.diff(a, b, ["id"]))
    assert rows(hashtree.summary(found, kept, other)) == rows(reconcile.diff(a, b, ["id"]).summary)
    plan = hashtree.rows_of(a, kept, leaves)._jdf.queryExecution().toString()
    assert plan.count("GreaterThanOrEqual(id,") >= 3 and plan.count("LessThanOrEqual(id,") >= 3
    assert hashtree.differing(kept, kept) == [] and hashtree.tree_diff(a, a, kept, kept).rows.isEmpty()
    with pytest.raises(ValueError):
        hashtree.differing(kept, hashtree.build(b, ["id"], leaves=7))


def test_a_tree_is_the_fingerprint_and_grows(spark, pair):
    a, b = pair
    tree = hashtree.build(a, ["id"], leaves=40)
    whole = reconcile.fingerprint(a).first()
    assert tree.total() == (whole["n_rows"], int(whole["hash_sum"]), whole["hash_xor"])
    more = b.where("id > 149000").withColumn("id", F.col("id") + 1_000_000)
    grown, anew = tree.plus(more), hashtree.build(a.unionByName(more), ["id"], tree.cuts)
    assert hashtree.differing(grown, anew) == [] and rows(grown.nodes) == rows(anew.nodes) and grown.total()[0] == 50_000 + more.count()


def test_odd_keys(spark):
    """NULL and repeated keys, texts, two columns, empty tables: the same rows as the whole comparison."""
    ddl = "k string, l int, v string"
    one = [(f"k{i % 90:02d}", i % 7, str(i)) for i in range(400)] + [(None, 1, "a"), (None, None, "b"), ("k05", None, "c")]
    a = spark.createDataFrame(one, ddl)
    for b in (spark.createDataFrame([r for r in one if r[2] not in ("17", "b")] + [(None, 1, "a2"), ("zz", 9, "z"), ("", 0, "first")], ddl), a.limit(0), a.repartition(3)):
        for x, y in ((a, b), (b, a)):
            tree = hashtree.build(x, ["k", "l"], leaves=16)
            found = hashtree.tree_diff(x, y, tree, hashtree.build(y, ["k", "l"], tree.cuts))
            whole = reconcile.diff(x, y, ["k", "l"])
            assert unequal(found) == unequal(whole)
            counts = hashtree.summary(found, tree, hashtree.build(y, ["k", "l"], tree.cuts)).first()
            assert tuple(counts) == (x.count(), y.count(), *tuple(whole.summary.first())[2:])
    empty = hashtree.build(a.limit(0), ["k"])
    assert empty.total() == (0, 0, 0) and hashtree.differing(empty, empty) == []


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(12,3)", "string", "int"])
def test_keys_of_any_kind(spark, tmp_path, kind):
    """Every row is in the leaf whose range holds it, also after the tree was saved."""
    k = {"timestamp": "timestamp_seconds(id * 7777)", "timestamp_ntz": "timestamp_seconds(id * 7777)", "date": "date_from_unix_date(int(id) * 3)", "double": "id / 7", "decimal(12,3)": "id / 8", "string": "concat('\"key\" ', id)", "int": "id * 5"}[kind]
    df = spark.range(300).select(F.expr(k).cast(kind).alias("k"), "id")
    tree = hashtree.build(df, ["k"], leaves=9)
    tree.save(str(tmp_path / "t"))
    kept = hashtree.load_tree(spark, str(tmp_path / "t"))
    counts = {r["node"]: r["n_rows"] for r in kept.nodes.where("level = 0").collect()}
    assert len(kept.cuts) == 8 and {i: hashtree.rows_of(df, kept, [i]).count() for i in counts} == counts and sum(counts.values()) == 300
    changed = df.withColumn("id", F.when(F.col("id") == 123, -1).otherwise(F.col("id")))
    assert len(hashtree.differing(kept, hashtree.build(changed, ["k"], kept.cuts))) == 1
