"""Registered queries of the table operators, each beside the SQL that gives the same rows.

The given tables hold no NULL and no second version of themselves, so both sides derive them by arithmetic on keys.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import masks, values
from .functions.masks import MaskRule
from .operators import curve, dbmerge, deadletter, deletes, hashtree, join, profile, project, quality, reconcile, runlog, versioned, write
from .operators.quality import Rule
from .plans.spec import TaskSpec
from .plans.task import cdc_sync, prepared, run_task
from .sources import scans
from .streaming import cdc
from .streaming.cdc import max_cursor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, projections -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status, o_custkey AS customer FROM orders WHERE o_totalprice > 200000")
def query_scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.query_scan(spark, "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_custkey AS customer FROM o WHERE o_totalprice > 200000;", {"o": table(spark, sf_dir, "orders")})


@query("SELECT o_orderstatus AS state, o_orderkey AS id, o_orderkey AS id_again FROM orders")
def map_columns_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.map_columns(table(spark, sf_dir, "orders"), [("O_ORDERSTATUS", "state"), ("o_orderkey", "id"), ("o_orderkey", "id_again")])


@query("SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS c_acctbal FROM customer")
def transform_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return project.transform_columns(df, {"c_mktsegment": "lower(?)", "c_acctbal": "cast(round(? * 100) as bigint)"})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 25")
def where_limit_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.where_limit(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderstatus = 'F'", 25, ["o_orderkey"]).drop("o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 7000 ORDER BY o_orderkey")
def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.order_by_cursor(scans.incremental_scan(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 7000), "o_orderkey")


@query("SELECT event_id, event_type FROM events WHERE event_id > 4321 AND event_type <> 'click'")
def templated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.templated_scan(spark, "SELECT event_id, event_type FROM ev WHERE event_id > :last_value AND event_type <> 'click'", 4321, key="event_id", views={"ev": table(spark, sf_dir, "events")})


_RANGES = """
    WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
    s AS (SELECT i AS shard, lo, hi, greatest((hi - lo) // 7, 1) AS step FROM b, range(7) t(i)),
    r AS (SELECT shard, lo + shard * step AS lower, CASE WHEN shard = 6 THEN hi ELSE least(lo + (shard + 1) * step, hi) END AS upper, hi FROM s)"""


@query(_RANGES + " SELECT CAST(shard AS INTEGER) AS shard, lower, upper, upper = hi AS last_inclusive FROM r WHERE lower < hi OR shard = 0")
def shard_ranges_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.shard_ranges(table(spark, sf_dir, "orders"), "o_orderkey", 7)


@query(_RANGES + " SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n_rows FROM orders JOIN r ON o_orderkey >= lower AND (o_orderkey < upper OR shard = 6 AND o_orderkey <= upper) GROUP BY shard")
def shard_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.with_shard(table(spark, sf_dir, "orders"), "o_orderkey", 7).groupBy("shard").agg(F.count("*").alias("n_rows"))


@query(_RANGES + " SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 999")
def sharded_scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows past a cursor, read as five ranges of the key with filters of their own."""
    return scans.sharded_scan(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, 999)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 150000")
def shard_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.shard_filter(table(spark, sf_dir, "orders"), "o_totalprice", 100000.0, 150000.0, False).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS n_rows, min(event_id) AS min_key, max(event_id) AS max_key FROM events")
def key_range_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.counts_and_range(table(spark, sf_dir, "events"), "event_id")


@query("SELECT count(*) AS n_rows FROM lineitem WHERE l_returnflag = 'R'")
def row_count_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.row_count(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"))


@query("SELECT page_id, url FROM pages")
def text_decode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.text_decode(table(spark, sf_dir, "pages").select("page_id", F.col("url").cast("binary").alias("url")), ["url"])


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CAST(o_orderkey % 3 = 0 AS BIGINT) AS is_third FROM orders")
def conform_sqlite_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", (F.col("o_orderkey") % 3 == 0).alias("is_third"))
    return write.conform_types(df, "sqlite")


# --- joins --------------------------------------------------------------------------------------------------------


def _orders_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("custkey"))


def _some_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("custkey"), "c_name")


_FED = """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS custkey FROM orders),
    c AS (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_custkey % 5 <> 0)"""


@query(_FED + " SELECT custkey, o_orderkey, c_name FROM o JOIN c USING (custkey)")
def fed_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join.federated_join(_orders_with_null_keys(spark, sf_dir), _some_customers(spark, sf_dir), ["custkey"])


@query(_FED + " SELECT o.custkey, o_orderkey, c_name FROM o LEFT JOIN c ON o.custkey = c.custkey")
def fed_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join.federated_join(_orders_with_null_keys(spark, sf_dir), _some_customers(spark, sf_dir), ["custkey"], "left")


@query(_FED + " SELECT c.custkey, c_name, o_orderkey FROM o RIGHT JOIN c ON o.custkey = c.custkey")
def fed_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = scans.federated_scan(spark, {"o": _orders_with_null_keys(spark, sf_dir), "c": _some_customers(spark, sf_dir)})
    return join.federated_join(sources["o"], sources["c"], ["custkey"], "right")


@query("""
    SELECT l.l_orderkey AS orderkey, l.l_linenumber AS linenumber, l.l_partkey, r.note FROM lineitem l
    JOIN (SELECT l_orderkey, l_linenumber, l_suppkey AS note FROM lineitem WHERE l_suppkey % 10 = 0) r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber""")
def fed_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    left = lines.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), "l_partkey")
    right = lines.where("l_suppkey % 10 = 0").select(F.col("l_orderkey").cast("string").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_suppkey").alias("note"))
    return join.federated_join(left, right, ["orderkey", "linenumber"])


_MIXED = "WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN o_custkey + 0.5::DOUBLE ELSE o_custkey::DOUBLE END AS custkey FROM orders), c AS (SELECT c_custkey, c_name FROM customer)"


def _half_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer's number is a double, in some rows no whole one."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, F.col("o_custkey") + 0.5).otherwise(F.col("o_custkey").cast("double")).alias("custkey"))


@query(_MIXED + " SELECT l.custkey, o_orderkey, c_name FROM l JOIN c ON l.custkey = c.c_custkey")
def fed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double keys against whole numbers."""
    return join.federated_join(_half_keys(spark, sf_dir), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name"), ["custkey"])


@query(_MIXED + " SELECT l.custkey, o_orderkey, c_name FROM l JOIN c ON l.custkey = c.c_custkey WHERE c_custkey % 4 <> 0")
def fed_numbers_and_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double keys against texts, some of which are no number."""
    key = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("no. "), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string"))
    return join.federated_join(_half_keys(spark, sf_dir), table(spark, sf_dir, "customer").select(key.alias("custkey"), "c_name"), ["custkey"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 6 = 0 OR o_orderkey % 7 = 0")
def detect_deletes_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers against texts: a number that the source spells otherwise is gone."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    source = o.where("o_orderkey % 6 <> 0").select(F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("order "), F.col("o_orderkey"))).otherwise(F.col("o_orderkey").cast("string")).alias("o_orderkey"))
    return join.detect_deletes(o, source, ["o_orderkey"])


@query("SELECT a.o_orderkey, a.o_orderstatus, b.o_orderstatus AS other_status, 'columns on both sides: o_orderstatus; rename one side with an alias' AS message FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey + 1")
def fed_conflict_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join that is refused, and after the alias that the refusal asks for."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    after = o.select((F.col("o_orderkey") + 1).alias("o_orderkey"), "o_orderstatus")
    try:
        join.federated_join(o, after, ["o_orderkey"])
        message = "no refusal"
    except ValueError as e:
        message = str(e)
    return join.federated_join(o, after.withColumnRenamed("o_orderstatus", "other_status"), ["o_orderkey"]).withColumn("message", F.lit(message))


# --- merge, append, evolve ----------------------------------------------------------------------------------------


def _merge_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0").withColumn("cents", F.col("cents") + F.when(F.col("o_orderkey") % 4 == 0, 0).otherwise(1))


_MERGE = """
    WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    t AS (SELECT * FROM o WHERE o_orderkey % 2 = 0),
    s AS (SELECT o_orderkey, o_orderstatus, cents + CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS cents FROM o WHERE o_orderkey % 3 = 0)"""


@query(_MERGE + " SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_pair(spark, sf_dir)
    return write.merge(target, source, ["o_orderkey"])


@query(_MERGE + """ SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
    CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.cents = s.cents AND t.o_orderstatus = s.o_orderstatus THEN 'unchanged' ELSE 'update' END AS action
    FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey""")
def merge_changes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_pair(spark, sf_dir)
    return write.merge_changes(target, source, ["o_orderkey"])


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT c_custkey, c_name, NULL::VARCHAR AS c_tier FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name, 'tier' || (c_custkey % 3) FROM customer WHERE c_custkey % 2 = 1")
def append_evolved_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = c.where("c_custkey % 2 = 1").select("c_name", F.col("c_custkey").alias("C_CUSTKEY"), F.concat(F.lit("tier"), F.col("c_custkey") % 3).alias("c_tier"))
    return write.evolve_append(c.where("c_custkey % 2 = 0"), new)


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_union_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.append_union([project.map_columns(table(spark, sf_dir, "customer"), [("c_custkey", "id"), ("c_name", "name")]), project.map_columns(table(spark, sf_dir, "supplier"), [("s_suppkey", "id"), ("s_name", "name")])])


# --- reconciliation -----------------------------------------------------------------------------------------------


def _perturbed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and a version of them with rows gone, values changed and rows under new keys: a million on, or as far as no key of a larger table lies."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = o.where("o_orderkey % 11 <> 0").withColumns({"o_orderstatus": F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")), "o_custkey": F.col("o_custkey") + F.when(F.col("o_orderkey") % 9 == 0, 1).otherwise(0)})
    far = o.agg(F.greatest(F.max("o_orderkey") - F.min("o_orderkey") + 1, F.lit(1000000)).alias("far")).first()["far"]
    return o, changed.unionByName(o.where("o_orderkey % 13 = 0").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(far).cast("long")))


_DIFF = """
    WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
    t AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM s WHERE o_orderkey % 11 <> 0
          UNION ALL SELECT o_orderkey + (SELECT greatest(max(o_orderkey) - min(o_orderkey) + 1, 1000000) FROM s), o_custkey, o_orderstatus FROM s WHERE o_orderkey % 13 = 0),
    j AS (SELECT s.o_orderkey AS sk, t.o_orderkey AS tk, s.o_custkey AS sc, t.o_custkey AS tc, s.o_orderstatus AS ss, t.o_orderstatus AS ts,
          CASE WHEN t.o_orderkey IS NULL THEN 'source_only' WHEN s.o_orderkey IS NULL THEN 'target_only' WHEN s.o_custkey <> t.o_custkey OR s.o_orderstatus <> t.o_orderstatus THEN 'mismatch' ELSE 'equal' END AS state
          FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey)"""


def _orders_diff(spark: SparkSession, sf_dir: str, **more) -> reconcile.Diff:
    return reconcile.diff(*_perturbed(spark, sf_dir), ["o_orderkey"], **more)


@query(_DIFF + " SELECT coalesce(sk, tk) AS o_orderkey, state FROM j")
def diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir).rows.select(F.coalesce("source.o_orderkey", "target.o_orderkey").alias("o_orderkey"), "state")


@query(_DIFF + """ SELECT count(*) FILTER (WHERE sk IS NOT NULL) AS source_total, count(*) FILTER (WHERE tk IS NOT NULL) AS target_total, count(*) FILTER (WHERE state = 'source_only') AS source_only,
    count(*) FILTER (WHERE state = 'target_only') AS target_only, count(*) FILTER (WHERE state = 'mismatch') AS mismatch FROM j""")
def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir, unique_keys=True).summary


@query(_DIFF + """ SELECT sk AS o_orderkey, sc AS source_custkey, tc AS target_custkey, concat_ws(',', CASE WHEN sc <> tc THEN 'o_custkey' END, CASE WHEN ss <> ts THEN 'o_orderstatus' END) AS diff_cols FROM j WHERE state = 'mismatch'""")
def diff_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir).mismatch.select("o_orderkey", F.col("source.o_custkey").alias("source_custkey"), F.col("target.o_custkey").alias("target_custkey"), F.concat_ws(",", "diff_cols").alias("diff_cols"))


@query(_DIFF + " SELECT 'o_custkey' AS column_name, count(*) AS n_rows FROM j WHERE sc <> tc UNION ALL SELECT 'o_orderstatus', count(*) FROM j WHERE ss <> ts")
def diff_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir).by_column


@query(_DIFF + " SELECT sk AS o_orderkey, sc AS o_custkey, ss AS o_orderstatus FROM j WHERE state = 'source_only'")
def diff_source_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir).source_only


@query(_DIFF + " SELECT tk AS o_orderkey, tc AS o_custkey, ts AS o_orderstatus FROM j WHERE state = 'target_only'")
def diff_target_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_diff(spark, sf_dir).target_only


@query(_DIFF + " SELECT o_orderkey, o_custkey, o_orderstatus FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def detect_deletes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _perturbed(spark, sf_dir)
    return join.detect_deletes(target, source, ["o_orderkey"])


@query("""SELECT user_id, count(*) FILTER (WHERE event_id % 2 = 0) > 0 AS paired, greatest(count(*) FILTER (WHERE event_id % 2 = 0) - 1, 0) AS extra, count(*) FILTER (WHERE event_id % 2 = 0) = 0 AS missing FROM events GROUP BY user_id""")
def diff_repeated_keys_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys on both sides, some without a row in the target: one pair, the target's others, or a missing key."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    rows = reconcile.diff(e, e.where("event_id % 2 = 0").withColumn("event_id", F.col("event_id") + 1), ["user_id"]).rows
    state = F.col("state")
    return rows.groupBy(F.coalesce("source.user_id", "target.user_id").alias("user_id")).agg((F.count_if(state.isin("equal", "mismatch")) == 1).alias("paired"), F.count_if(state == "target_only").alias("extra"), (F.count_if(state == "source_only") == 1).alias("missing"))


@query("SELECT user_id, count(*) FILTER (WHERE n > 1) AS extra FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) GROUP BY user_id")
def diff_repeated_keys_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    rows = reconcile.diff(e, e, ["user_id"]).rows
    key = F.coalesce("source.user_id", "target.user_id")
    return rows.groupBy(key.alias("user_id")).agg(F.count_if(F.col("state") == "target_only").alias("extra"))


_H = "md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END, 'NULL'), o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')))"


def _hashable(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate")


@query(f"SELECT o_orderkey, {_H} AS h FROM orders")
def row_md5_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _hashable(spark, sf_dir)
    return df.select("o_orderkey", values.row_md5(df, strict=False).alias("h"))


_TEXTS = ["CAST(o_orderkey AS VARCHAR)", "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END", "o_orderstatus", "regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '')", "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')"]
_STRICT = f"md5({' || '.join(f"coalesce(length({t}) || ':' || {t}, 'n')" for t in _TEXTS)})"


@query(f"SELECT o_orderkey, {_STRICT} AS h FROM orders")
def row_md5_strict_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _hashable(spark, sf_dir)
    return df.select("o_orderkey", values.row_md5(df).alias("h"))


@query(f"""WITH h AS (SELECT ('0x' || substr({_STRICT}, 1, 15))::BIGINT AS h FROM orders) SELECT count(*) AS n_rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM h""")
def fingerprint_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.fingerprint(_hashable(spark, sf_dir)).withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query(f"""WITH h AS (SELECT o_orderkey % 16 AS bucket, ('0x' || substr({_STRICT}, 1, 15))::BIGINT AS h FROM orders) SELECT bucket, count(*) AS n_rows, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM h GROUP BY bucket""")
def fingerprint_buckets_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.fingerprint(_hashable(spark, sf_dir), bucket=F.col("o_orderkey") % 16).withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query(f"""WITH RECURSIVE n AS (SELECT {_H} AS h, count(*) AS n FROM orders GROUP BY h),
    l(digits, h) AS (SELECT (SELECT min(d) FROM range(12) t(d) WHERE (SELECT count(*) FROM orders) <= {reconcile.DIGEST_ROWS} * (1::BIGINT << (4 * d))), CASE WHEN n > 1 THEN h || ':' || n ELSE h END FROM n
        UNION ALL SELECT digits - 1, left(h, digits) || md5(string_agg(h, chr(10) ORDER BY h)) FROM l WHERE digits >= 0 GROUP BY digits, left(h, digits))
    SELECT coalesce(max(h) FILTER (WHERE digits = -1), md5('')) AS digest FROM l""")
def digest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group up to DIGEST_ROWS rows; beyond them groups by the first digits of the hashes, sixteen digests of which are one of the next level."""
    return reconcile.table_digest(_hashable(spark, sf_dir), strict=False)


@query("SELECT md5(string_agg(h, chr(10) ORDER BY h)) AS digest FROM (SELECT md5(concat_ws('|', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR))) AS h FROM nation)")
def digest_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.table_digest(table(spark, sf_dir, "nation"), strict=False)


@query("""SELECT (SELECT count(*) FROM orders) AS source_n_rows, (SELECT count(*) FROM orders WHERE o_orderkey % 100 <> 0) AS target_n_rows, (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 0) = 0 AS passed""")
def validate_checksum_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _hashable(spark, sf_dir)
    return reconcile.validate_checksum(df, df.where("o_orderkey % 100 <> 0")).select("source_n_rows", "target_n_rows", "passed")


@query(f"""WITH h AS (SELECT o_orderkey, ('0x' || substr({_STRICT}, 1, 15))::BIGINT AS h FROM orders), v(version, expected) AS (VALUES ('same', TRUE), ('one price', FALSE), ('two swapped', FALSE), ('one twice', FALSE))
    SELECT version, (SELECT count(*) FROM h) AS source_n_rows, (SELECT CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) FROM h) AS source_hash_sum, expected AS passed FROM v""")
def validate_checksum_changes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of equal length: the same one, one with one value changed by a cent, one with two statuses exchanged, one with a row for another."""
    df = _hashable(spark, sf_dir)
    low = df.agg(F.min("o_orderkey").alias("first"), F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("f"), F.min(F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))).alias("o")).first()
    other = F.when(F.col("o_orderkey") == low["f"], "O").when(F.col("o_orderkey") == low["o"], "F").otherwise(F.col("o_orderstatus"))
    versions = {
        "same": df.orderBy(F.desc("o_orderkey")), "one price": df.withColumn("o_totalprice", F.when(F.col("o_orderkey") == low["first"], F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))),
        "two swapped": df.withColumn("o_orderstatus", other), "one twice": df.where(F.col("o_orderkey") != low["f"]).unionByName(df.where(F.col("o_orderkey") == low["o"])),
    }
    rows = [reconcile.validate_checksum(df, v).select(F.lit(name).alias("version"), "source_n_rows", F.col("source_hash_sum").cast("string").alias("source_hash_sum"), "passed") for name, v in versions.items()]
    return write.append_union(rows)


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS only_left, (SELECT count(*) FROM orders WHERE o_orderkey % 15 = 0) AS only_right, (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) = 0 AS passed")
def same_rows_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return reconcile.same_rows(o, o.where("o_orderkey % 10 <> 0").unionByName(o.where("o_orderkey % 15 = 0").withColumn("o_orderstatus", F.lit("twice"))))


_SAMPLE = "SELECT * FROM orders ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '7')), o_orderkey LIMIT 500"


@query(f"SELECT o_orderkey, o_orderstatus FROM ({_SAMPLE})")
def random_sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.random_sample(table(spark, sf_dir, "orders"), 500, ["o_orderkey"], 7).select("o_orderkey", "o_orderstatus")


@query(f"WITH s AS ({_SAMPLE}) SELECT 500::BIGINT AS sampled, count(*) FILTER (WHERE o_orderkey % 11 = 0 OR o_orderkey % 5 = 0) AS missing, count(*) FILTER (WHERE o_orderkey % 11 = 0 OR o_orderkey % 5 = 0) = 0 AS passed FROM s")
def validate_sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return reconcile.validate_sample(o, target, 500, ["o_orderkey"], 7)[1]


@query(f"WITH s AS ({_SAMPLE}) SELECT o_orderkey, o_orderstatus FROM s WHERE o_orderkey % 11 = 0 OR o_orderkey % 5 = 0 ORDER BY o_orderkey LIMIT 5")
def first_k_differences_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return reconcile.validate_sample(o, target, 500, ["o_orderkey"], 7)[0]


@query("""SELECT p_partkey, '{p_partkey:' || p_partkey || ', p_name:' || CASE WHEN length(p_name || p_type || p_brand) > 20 THEN left(p_name || p_type || p_brand, 17) || '...' ELSE p_name || p_type || p_brand END || '}' AS preview FROM part""")
def row_preview_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", "p_type", "p_brand").alias("p_name"))
    return df.select("p_partkey", values.row_preview(df).alias("preview"))


@query("""SELECT event_id, event_id % 3 <> 0 AS same_number, event_id % 4 = 0 AS same_null, event_id % 5 <> 0 AS same_text, event_id % 2 = 0 AS same_time FROM events""")
def values_equal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, key = table(spark, sf_dir, "events"), F.col("event_id")
    double = F.when(key % 3 == 0, key + 1).otherwise(key).cast("double")
    text = F.when(key % 5 == 0, F.concat(F.lit("0"), key)).otherwise(key.cast("string"))
    late = F.when(key % 2 == 0, F.col("ts")).otherwise(F.col("ts") + F.expr("interval 1 microsecond"))
    return e.select(
        "event_id", values.values_equal(key, double, T.LongType(), T.DoubleType()).alias("same_number"), values.values_equal(F.when(key % 4 != 0, key), F.lit(None).cast("long"), T.LongType(), T.LongType()).alias("same_null"),
        values.values_equal(key, text, T.LongType(), T.StringType()).alias("same_text"), values.values_equal(F.col("ts"), late, T.TimestampNTZType(), T.TimestampNTZType()).alias("same_time"),
    )


@query(_MERGE + """ SELECT count(*) FILTER (WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS inserted, TRUE AS passed, FALSE AS passed_short, 'row count: target grew by ' || count(*) FILTER (WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t))
    || ', expected ' || count(*) AS message FROM s""")
def validate_row_count_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge grows its target by the inserted keys, not by the rows written."""
    target, source = _merge_pair(spark, sf_dir)
    before, after, inserted = target.count(), write.merge(target, source, ["o_orderkey"]).count(), write.inserted_keys(target, source, ["o_orderkey"])
    good, short = reconcile.validate_row_count(before, after, inserted), reconcile.validate_row_count(before, after, source.count())
    return spark.createDataFrame([(inserted, good[0], short[0], short[1])], "inserted long, passed boolean, passed_short boolean, message string")


# --- quality ------------------------------------------------------------------------------------------------------

ORDER_RULES = [
    Rule("not_null", column="o_custkey"),
    Rule("range", column="o_totalprice", min=1000, max=400000),
    Rule("in_set", column="o_orderstatus", values=("F", "O")),
    Rule("unique", columns=("o_custkey", "o_orderstatus")),
    Rule("regex", column="o_orderpriority", pattern="^[1-4]-", on_fail="warn"),
    Rule("min_length", column="o_orderpriority", length=6),
    Rule("max_length", column="o_orderpriority", length=10, on_fail="dlq"),
]
_Q = "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)"


def _checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(_Q + """, r(rule, column_name, violations, on_fail) AS (
    SELECT 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL), 'abort' FROM o
    UNION ALL SELECT 'range', 'o_totalprice', count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000), 'abort' FROM o
    UNION ALL SELECT 'in_set', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')), 'abort' FROM o
    UNION ALL SELECT 'unique', 'o_custkey,o_orderstatus', (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)), 'abort'
    UNION ALL SELECT 'regex', 'o_orderpriority', count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-')), 'warn' FROM o
    UNION ALL SELECT 'min_length', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) < 6), 'abort' FROM o
    UNION ALL SELECT 'max_length', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 10), 'dlq' FROM o)
    SELECT rule, column_name, violations, violations = 0 AS passed, on_fail FROM r""")
def assert_report_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_report(_checked_orders(spark, sf_dir), ORDER_RULES).drop("description")


_V = [Rule("not_null", column="seg"), Rule("range", column="c_acctbal", min=0), Rule("regex", column="seg", pattern="^[A-M]")]
_CUST = "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS seg, c_acctbal FROM customer)"


def _checked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("seg"), "c_acctbal")


@query(_CUST + """ SELECT c_custkey, 'assertion failed: not_null(seg)' AS message FROM c WHERE seg IS NULL UNION ALL SELECT c_custkey, 'assertion failed: range(c_acctbal, 0, )' FROM c WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, 'assertion failed: regex(seg, ^[A-M])' FROM c WHERE NOT regexp_matches(seg, '^[A-M]')""")
def assert_violations_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violating_rows(_checked_customers(spark, sf_dir), _V).select("c_custkey", F.col("_error").alias("message"))


@query(_CUST + " SELECT c_custkey, seg FROM c WHERE seg IS NOT NULL AND c_acctbal >= 0 AND regexp_matches(seg, '^[A-M]')")
def quarantine_good_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantine(_checked_customers(spark, sf_dir), _V)[0].select("c_custkey", "seg")


@query("SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query(_Q + " SELECT o_custkey, count(*) AS n_rows FROM o WHERE o_custkey IS NOT NULL AND o_orderstatus = 'F' GROUP BY o_custkey HAVING count(*) > 1")
def unique_partial_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_violations(_checked_orders(spark, sf_dir), ["o_custkey"], "o_orderstatus = 'F'")


@query("""SELECT r[1] AS key_columns, CAST(r[2] AS BIGINT) AS n_rows, CAST(r[3] AS BIGINT) AS n_distinct, 0::BIGINT AS n_null, r[2] = r[3] AS is_key FROM (SELECT unnest([
    ['conv_id', (SELECT count(*) FROM conversations)::VARCHAR, (SELECT count(DISTINCT conv_id) FROM conversations)::VARCHAR], ['turn', (SELECT count(*) FROM conversations)::VARCHAR, (SELECT count(DISTINCT turn) FROM conversations)::VARCHAR],
    ['conv_id,turn', (SELECT count(*) FROM conversations)::VARCHAR, (SELECT count(DISTINCT (conv_id, turn)) FROM conversations)::VARCHAR]]) AS r)""")
def suggest_keys_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.suggest_merge_keys(table(spark, sf_dir, "conversations"), [["conv_id"], ["turn"], ["conv_id", "turn"]])


@query("""WITH d AS (SELECT count(*) AS n, count(DISTINCT conv_id) AS c, count(DISTINCT turn) AS t, count(DISTINCT role) AS r, count(DISTINCT text) AS x, count(DISTINCT (conv_id, turn)) AS ct, count(DISTINCT (conv_id, role)) AS cr,
    count(DISTINCT (conv_id, text)) AS cx, count(DISTINCT (turn, role)) AS tr, count(DISTINCT (turn, text)) AS tx, count(DISTINCT (role, text)) AS rx FROM conversations)
    SELECT key_columns, n AS n_rows FROM d, (VALUES ('conv_id'), ('turn'), ('role'), ('text'), ('conv_id,turn'), ('conv_id,role'), ('conv_id,text'), ('turn,role'), ('turn,text'), ('role,text')) k(key_columns)
    WHERE CASE key_columns WHEN 'conv_id' THEN c = n WHEN 'turn' THEN t = n WHEN 'role' THEN r = n WHEN 'text' THEN x = n WHEN 'conv_id,turn' THEN ct = n AND c < n AND t < n WHEN 'conv_id,role' THEN cr = n AND c < n AND r < n
      WHEN 'conv_id,text' THEN cx = n AND c < n AND x < n WHEN 'turn,role' THEN tr = n AND t < n AND r < n WHEN 'turn,text' THEN tx = n AND t < n AND x < n ELSE rx = n AND r < n AND x < n END""")
def find_keys_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least keys of up to two columns, unaided."""
    return profile.find_keys(table(spark, sf_dir, "conversations"), 2).select("key_columns", "n_rows")


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey * 10 + l_linenumber) AS n_distinct, 9 AS shards, true AS fair FROM lineitem")
def equal_shards_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of two columns where nine tenths of the rows lie in a hundredth of the range, and some have none: eight shards and one for NULL hold every row once, none much over its share."""
    base = F.when(F.col("l_orderkey") % 10 > 0, F.col("l_orderkey")).otherwise(F.col("l_orderkey") * 1000)
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 50 > 0, base).alias("k"), "l_linenumber", "l_orderkey")
    shards = scans.equal_shards(rows, ["k", "l_linenumber"], 8)
    parts = write.append_union([scans.in_shard(rows, ["k", "l_linenumber"], s).withColumn("shard", F.lit(i)) for i, s in enumerate(shards)])
    by = parts.groupBy("shard").agg(F.count("*").alias("n"))
    most = by.agg(F.max("n").alias("m"), F.sum("n").alias("s"), F.count("*").alias("c")).select((F.col("m") <= 2 * F.col("s") / 8).alias("fair"), F.col("c").cast("int").alias("shards"))
    counts = parts.agg(F.count("*").alias("n_rows"), F.countDistinct(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n_distinct"))
    return reconcile.beside(counts, most.select("shards"), most.select("fair"))


@query("SELECT event_id, user_id FROM events")
def late_rows_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds over a source whose rows come up to 400 keys late, and some twice: each is loaded once, by appends and by merges."""
    folder, e = scratch(spark), table(spark, sf_dir, "events").select("event_id", "user_id")
    late = F.pmod(F.col("event_id"), F.lit(7)) == 0
    half = e.agg(F.max("event_id").alias("m")).first()["m"] // 2
    steps = [e.where((F.col("event_id") <= half) & (~late | (F.col("event_id") <= half - 400))), e, e]
    for source in steps:
        cdc.poll_once(spark, source, "event_id", f"{folder}/appended", f"{folder}/a", "late", merge_keys=["event_id"], lateness=400)
        cdc.poll_once(spark, source, "event_id", f"{folder}/merged", f"{folder}/m", "late", "merge", ["event_id"], lateness=400)
    both = spark.read.parquet(f"{folder}/appended").unionByName(write.merge_table(spark, f"{folder}/merged"))
    return both.groupBy("event_id", "user_id").agg(F.count("*").alias("n")).where("n = 2").drop("n")


@query("SELECT event_id, user_id FROM events")
def late_rows_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which every row comes twice, the second time in a later batch: the keys of the watermark's stretch are kept as state, so each is loaded once."""
    folder, e = scratch(spark), table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    for step in range(2):
        e.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    cdc.cdc_stream(cdc.without_late_repeats(stream, ["event_id"], "ts", "10000 days"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id")


@query("SELECT count(*) AS n_rows, CAST(sum(octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source)) + 32) AS BIGINT) AS size_bytes FROM documents")
def size_estimate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.size_estimate(table(spark, sf_dir, "documents"))


# --- masks --------------------------------------------------------------------------------------------------------


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 13 != 0, F.left(F.lpad(k, 11, "1"), (F.col("c_custkey") % 12).cast("int"))).alias("phone"),
        F.when(F.col("c_custkey") % 4 == 0, k).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("x@d"), k)).otherwise(F.concat(F.lit("u"), k, F.lit("@d"), k, F.lit(".com"))).alias("email"),
        F.left(F.lpad(k, 18, "9"), (F.col("c_custkey") % 19).cast("int")).alias("idcard"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("("), F.lpad(k, 3, "4"), F.lit(") 555-"), F.lpad(k, 4, "7"))).otherwise(F.concat(F.lit("12"), k)).alias("us"),
    )


_PEOPLE = """WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN left(lpad(c_custkey::VARCHAR, 11, '1'), (c_custkey % 12)::INT) END AS phone,
    CASE WHEN c_custkey % 4 = 0 THEN c_custkey::VARCHAR WHEN c_custkey % 4 = 1 THEN 'x@d' || c_custkey ELSE 'u' || c_custkey || '@d' || c_custkey || '.com' END AS email,
    left(lpad(c_custkey::VARCHAR, 18, '9'), (c_custkey % 19)::INT) AS idcard,
    CASE WHEN c_custkey % 3 = 0 THEN '(' || lpad(left(c_custkey::VARCHAR, 3), 3, '4') || ') 555-' || lpad(left(c_custkey::VARCHAR, 4), 4, '7') ELSE '12' || c_custkey END AS us FROM customer)"""


@query(_PEOPLE + """ SELECT c_custkey, CASE WHEN length(phone) <= 3 THEN repeat('*', length(phone)) WHEN length(phone) <= 7 THEN left(phone, 1) || repeat('*', length(phone) - 2) || right(phone, 1) ELSE left(phone, 3) || '****' || right(phone, 4) END AS phone FROM p""")
def mask_phone_cn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.phone_cn(F.col("phone")).alias("phone"))


@query(_PEOPLE + r""" SELECT c_custkey, CASE WHEN length(regexp_replace(us, '\D', '', 'g')) = 10 THEN '(' || left(regexp_replace(us, '\D', '', 'g'), 3) || ') ***-' || right(regexp_replace(us, '\D', '', 'g'), 4)
    WHEN length(us) <= 4 THEN repeat('*', length(us)) ELSE left(us, length(us) - 4) || '****' END AS us FROM p""")
def mask_phone_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.phone_us(F.col("us")).alias("us"))


@query(_PEOPLE + """ SELECT c_custkey, CASE WHEN email NOT LIKE '%@%' THEN CASE WHEN length(email) = 1 THEN '*' ELSE left(email, 1) || repeat('*', length(email) - 1) END WHEN email LIKE 'x@%' THEN email ELSE left(email, 1) || '***@' || split_part(email, '@', 2) END AS email FROM p""")
def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.email(F.col("email")).alias("email"))


@query(_PEOPLE + """ SELECT c_custkey, CASE WHEN length(idcard) <= 6 THEN repeat('*', length(idcard)) ELSE left(idcard, 3) || repeat('*', length(idcard) - 7) || right(idcard, 4) END AS idcard FROM p""")
def mask_id_card_cn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.id_card_cn(F.col("idcard")).alias("idcard"))


@query(_PEOPLE + """ SELECT c_custkey, CASE WHEN length(idcard) <= 1 THEN repeat('*', length(idcard)) ELSE left(idcard, 1) || repeat('*', length(idcard) - 1) END AS first_kept,
    CASE WHEN length(idcard) <= 4 THEN repeat('*', length(idcard)) ELSE left(idcard, 2) || repeat('*', length(idcard) - 4) || right(idcard, 2) END AS ends_kept FROM p""")
def mask_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.all_but_first(F.col("idcard")).alias("first_kept"), masks.keep_ends(F.col("idcard"), 2, 2).alias("ends_kept"))


@query(_PEOPLE + """ SELECT c_custkey, CASE WHEN phone IS NOT NULL THEN lower(lpad(to_hex(list_reduce(list_concat([14695981039346656037::UHUGEINT], list_transform(range(1, length(phone) + 1), lambda i: ascii(phone[i])::UHUGEINT)),
    lambda h, b: (xor(h, b) * 1099511628211::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT), 16, '0')) END AS h FROM p""")
def mask_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("c_custkey", masks.fnv1a_64(F.col("phone")).alias("h"))


@query("SELECT c_custkey, 'hidden' AS c_name, 7.5::DOUBLE AS c_acctbal, NULL::VARCHAR AS c_mktsegment FROM customer")
def mask_fixed_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").drop("c_nationkey")
    return masks.mask_table(df, [MaskRule("c_name", "fixed_value", {"value": "hidden"}), MaskRule("C_ACCTBAL", "fixed_value", {"value": "7.5"}), MaskRule("c_mktsegment", "fixed_value", {"value": "NULL"}), MaskRule("nowhere", "email")])


@query("SELECT count(*) AS n_rows, count(*) AS in_range, count(*) AS dates_in_range, count(*) AS names_fit FROM customer")
def mask_pseudonym_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_name", "c_acctbal", "c_mktsegment", "c_custkey")
    df = df.withColumns({"c_mktsegment": F.concat("c_mktsegment", "c_custkey"), "again": F.col("c_name")})
    out = masks.mask_table(df, [MaskRule("c_name", "name_cn"), MaskRule("again", "name_cn"), MaskRule("c_acctbal", "random_numeric", {"low": 100, "high": 0}), MaskRule("c_mktsegment", "random_date", {"until": "2024-01-01"})], seed=5)
    return out.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("c_acctbal").between(0, 100)).alias("in_range"), F.count_if((F.col("c_mktsegment") >= "1970-01-01") & (F.col("c_mktsegment") < "2024-01-01")).alias("dates_in_range"),
        F.count_if(F.char_length("c_name").isin(2, 3) & (F.col("c_name") == F.col("again"))).alias("names_fit"),
    )


@query("SELECT doc_id, CASE WHEN length(source) <= 2 THEN repeat('*', length(source)) ELSE left(source, 1) || repeat('*', length(source) - 2) || right(source, 1) END AS source, left(lang, 1) || '*' AS lang FROM documents")
def mask_table_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.mask_table(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), [MaskRule("source", "mask_value_length", {"prefix": 1, "suffix": 1}), MaskRule("lang", "email")])


# --- dead letters, user code --------------------------------------------------------------------------------------

_EVENT = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("k", T.IntegerType(), False), T.StructField("event_type", T.StringType(), True, {"maxLength": 6})])
_DIRTY = """WITH d AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'bad' ELSE json_extract_string(props, '$.k') END AS k, event_type FROM events),
    a AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE event_id % 19 = 0),
    r AS (SELECT *, k = 'bad' OR length(event_type) > 6 AS wrong, row_number() OVER (PARTITION BY event_id) AS n FROM a)"""


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 17 == 0, "bad").otherwise(F.get_json_object("props", "$.k")).alias("k"), "event_type")
    return e.unionByName(e.where("event_id % 19 = 0"))


@query(_DIRTY + " SELECT event_id, CAST(k AS INTEGER) AS k, event_type FROM r WHERE NOT wrong AND n = 1")
def split_loadable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletter.split_loadable(_dirty_events(spark, sf_dir), _EVENT, ["event_id"])[0]


@query(_DIRTY + """ SELECT CAST(event_id AS VARCHAR) AS event_id, k, event_type, CASE WHEN wrong THEN concat_ws('; ', CASE WHEN k = 'bad' THEN 'k: not a int' END, CASE WHEN length(event_type) > 6 THEN 'event_type: longer than 6' END) ELSE 'duplicate key' END AS _dlq_error, 'events_clean' AS _dlq_table_name
    FROM r WHERE wrong OR n > 1""")
def dead_letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletter.dead_letters_csv(deadletter.split_loadable(_dirty_events(spark, sf_dir), _EVENT, ["event_id"])[1], "events_clean").drop("_dlq_timestamp")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey = 70 THEN 'TimeoutError: no result within 0.5 s' WHEN c_custkey = 71 THEN 'RuntimeError: the function ended its process' WHEN c_custkey = 72 THEN 'ValueError: no' END AS error FROM customer")
def limited_plugin_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row function with a limit for each row: one row hangs, one ends its process, one fails, the others pass."""

    def change(row: dict) -> dict:
        if row["c_custkey"] == 70:
            while True:
                pass
        if row["c_custkey"] == 71:
            os._exit(1)
        if row["c_custkey"] == 72:
            raise ValueError("no")
        return {"id": row["c_custkey"]}

    # a row function costs more than a shuffle of a key, and a file of a few MB is a task or two
    spread = table(spark, sf_dir, "customer").select("c_custkey").repartition(2 * spark.sparkContext.defaultParallelism)
    rows = deadletter.tagged_transform(spread, change, T.StructType.fromDDL("id long"), limit_s=0.5)
    return rows.select(F.coalesce("_out_id", "_in_c_custkey").alias("id"), F.col("_error").alias("error"))


@query("SELECT c_custkey AS id, c_custkey * 2 AS twice, c_name || '!' AS name FROM customer WHERE c_custkey % 10 <> 3")
def plugin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plugin(spark, sf_dir)[0]


@query("SELECT c_custkey, 'ValueError: key ' || c_custkey AS _error FROM customer WHERE c_custkey % 10 = 3")
def plugin_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plugin(spark, sf_dir)[1].select("c_custkey", "_error")


def _plugin(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def change(row: dict) -> dict:
        if row["c_custkey"] % 10 == 3:
            raise ValueError(f"key {row['c_custkey']}")
        return {"id": row["c_custkey"], "twice": row["c_custkey"] * 2, "name": row["c_name"] + "!", "ignored": 1}

    return deadletter.row_transform(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), change, T.StructType.fromDDL("id long, twice long, name string"))


@query("SELECT c_custkey AS id, 'C' || right(c_name, 8) AS label, CAST(round(c_acctbal) AS BIGINT) AS balance FROM customer WHERE c_custkey > 99")
def run_task_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TaskSpec(
        "customers", "unused", table(spark, sf_dir, "customer"), columns=[("c_custkey", "id"), ("c_name", "label"), ("c_acctbal", "balance")], mode="append", resume_key="c_custkey", initial_cursor=99,
        transforms={"label": "concat('C', right(?, 8))", "balance": "cast(round(?) as bigint)"},
    )
    return prepared(spark, spec)[0]


# --- change capture, run logs -------------------------------------------------------------------------------------


@query("SELECT event_id, CASE WHEN event_id <= 5000 THEN 1 ELSE 2 END AS round_no, CASE WHEN event_id <= 5000 THEN least(5000, (SELECT max(event_id) FROM events)) ELSE (SELECT max(event_id) FROM events) END AS cursor_after FROM events")
def cdc_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls, the second from the cursor of the first: together all rows, none twice."""
    events = table(spark, sf_dir, "events").select("event_id")
    first = scans.incremental_scan(events.where("event_id <= 5000"), "event_id", None)
    cursor = max_cursor(first, "event_id")
    second = scans.incremental_scan(events, "event_id", cursor)
    last = max_cursor(second, "event_id")
    return first.select("event_id", F.lit(1).alias("round_no"), F.lit(cursor).cast("long").alias("cursor_after")).unionByName(second.select("event_id", F.lit(2).alias("round_no"), F.lit(last).cast("long").alias("cursor_after")))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def cdc_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second round merged into the table that the first left."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    first = write.latest_per_key(e.where("event_id <= 5000"), ["user_id"], ["event_id"])
    return write.merge(first, scans.incremental_scan(e, "event_id", 5000), ["user_id"], ["event_id"])


_RUNS = "WITH r AS (SELECT event_id AS id, event_type AS task, ts AS started_at, user_id AS n, value AS duration_ms, CASE WHEN event_type = 'error' OR event_id % 23 = 0 THEN 'failed' ELSE 'ok' END AS status FROM events)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = (F.col("event_type") == "error") | (F.col("event_id") % 23 == 0)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("task"), F.col("ts").alias("started_at"), F.col("user_id").alias("n"), F.col("value").alias("duration_ms"), F.when(failed, "failed").otherwise("ok").alias("status"))


@query(_RUNS + " SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS succeeded, count(*) FILTER (WHERE status = 'failed') AS failed, CAST(sum(n) AS BIGINT) AS n_rows, CAST(round(sum(duration_ms)) AS BIGINT) AS duration_ms FROM r")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_summary(_runs(spark, sf_dir), rows="n").withColumn("duration_ms", F.round("duration_ms").cast("long"))


@query(_RUNS + """ SELECT task, count(*) FILTER (WHERE status = 'ok') AS batches_ok, count(*) FILTER (WHERE status = 'failed') AS batches_failed, CAST(coalesce(sum(n) FILTER (WHERE status = 'ok'), 0) AS BIGINT) AS n_rows,
    CAST(coalesce(sum(n) FILTER (WHERE status = 'failed'), 0) AS BIGINT) AS n_dead_letters FROM r GROUP BY task""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_counters(_runs(spark, sf_dir), ["task"], rows="n")


@query(_RUNS + """, b AS (SELECT unnest([1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000, NULL])::BIGINT AS le_ms, unnest(range(13))::INTEGER AS place)
    SELECT task, place, le_ms, count(*) FILTER (WHERE le_ms IS NULL OR duration_ms <= le_ms) AS n_runs FROM r, b GROUP BY task, place, le_ms""")
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.duration_histogram(_runs(spark, sf_dir), ["task"])


@query(_RUNS + " SELECT id, task, status FROM r ORDER BY started_at DESC, id DESC LIMIT 15")
def recent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _runs(spark, sf_dir)
    return runlog.recent_history([r.where("id % 2 = 0"), r.where("id % 2 = 1")], 15).select("id", "task", "status")


@query("SELECT event_id, ts AS parsed FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 0")
def parse_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 3 == 0, "no time").when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z")))
    return e.select("event_id", values.parse_time(text).cast("timestamp_ntz").alias("parsed"))


# --- through files: writes, rounds, streams and whole tasks -------------------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that the session names for checkpoints; a session in one process may do without a name."""
    return write.work_folder(spark)


@query("SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'Z', o_custkey FROM orders WHERE o_orderkey % 2 = 1")
def write_modes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, replace from itself, append, in clustered files."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    path = f"{scratch(spark)}/orders"
    write.write_table(o, path, cluster=["o_custkey:ASC", "o_orderkey:DESC"])
    write.write_table(spark.read.parquet(path).where("o_orderkey % 2 = 0"), path)
    write.write_table(o.where("o_orderkey % 2 = 1").withColumn("o_orderstatus", F.lit("Z")), path, "append", must_exist=True)
    return spark.read.parquet(path)


_SPANS = {"o_custkey": "(SELECT quantile_disc(o_custkey, 0.6) AS low, quantile_disc(o_custkey, 0.62) AS high FROM orders)", "o_totalprice": "(SELECT quantile_disc(o_totalprice, 0.3) AS low, quantile_disc(o_totalprice, 0.32) AS high FROM orders)"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, true AS few_read FROM orders, {span} WHERE {c} BETWEEN low AND high" for c, span in _SPANS.items()))
def curve_order_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders along a curve of customer and price in 256 files: a filter on either reads under a quarter of them."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = f"{scratch(spark)}/orders"
    curve.curve_ordered(o, ["o_custkey", "o_totalprice"], 256).write.parquet(path)
    found = profile.exact_quantiles(o, {"o_custkey": [0.6, 0.62], "o_totalprice": [0.3, 0.32]})
    report = curve.file_skipping(spark.read.parquet(path), {c: tuple(span) for c, span in found.items()})
    return report.select("column", "n_rows", (4 * F.col("n_read") < F.col("n_files")).alias("few_read"))


@query(_MERGE + " SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def merge_into_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _merge_pair(spark, sf_dir)
    path = f"{scratch(spark)}/orders"
    write.merge_into(spark, path, target, ["o_orderkey"], buckets=8)
    write.merge_into(spark, path, source, ["o_orderkey"], buckets=8)
    return write.merge_table(spark, path)


@query(_MERGE + """ SELECT o_orderkey, o_orderstatus, cents, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 2 = 0 THEN 'quarter' END AS more FROM
    (SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s) ORDER BY 1""")
def merge_into_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges into a table with long keys: integer keys, every row twice, then text keys and a new column."""
    target, source = _merge_pair(spark, sf_dir)
    path = f"{scratch(spark)}/orders"
    write.merge_into(spark, path, target, ["o_orderkey"], buckets=8)
    twice = source.unionByName(source.withColumn("cents", F.col("cents") - 1)).withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    write.merge_into(spark, path, twice, ["o_orderkey"], ["cents"])
    more = write.merge_table(spark, path).where("o_orderkey % 4 = 0").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.lit("quarter").alias("more"))
    write.merge_into(spark, path, more, ["o_orderkey"], evolve=True)
    return write.merge_table(spark, path)


@query(_MERGE + " SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def merge_into_database_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges, the second one twice, into a table of an embedded database (which lives in one process, so in a local session)."""
    target, source = _merge_pair(spark, sf_dir)
    url, options = f"jdbc:derby:memory:tableflow_{uuid.uuid4().hex};create=true", {"dbtable": "orders", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    sized = {"createTableColumnTypes": "o_orderstatus VARCHAR(1)"}
    target.limit(0).write.format("jdbc").options(url=url, **options, **sized).save()
    for rows in (target, source, source):
        dbmerge.merge_into_database(spark, url, options, rows, ["o_orderkey"])
    return spark.read.format("jdbc").options(url=url, **options).load()


@query(_MERGE + " SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def merge_into_catalog_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a task, into a table of the catalog over a folder; its rows are read from the folder after the table is gone."""
    target, source = _merge_pair(spark, sf_dir)
    folder, name = scratch(spark), f"tableflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{c} {t}' for c, t in target.dtypes)}) USING parquet LOCATION '{folder}/orders'")
    for rows in (target, source, source):
        run_task(spark, TaskSpec("merge", f"catalog:{name}", rows, mode="merge", merge_keys=["o_orderkey"], validate="checksum"))
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(target.schema).parquet(f"{folder}/orders")


@query(_MERGE + " SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def versioned_merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a log of versions: rows in three appends, each with its cursor in the same commit, then a merge, twice."""
    target, source = _merge_pair(spark, sf_dir)
    t = versioned.VersionedTable(spark, f"{scratch(spark)}/orders")
    for i in range(3):
        t.append(target.where(F.pmod("o_orderkey", F.lit(6)) == 2 * i), cursor=("load", None if i == 0 else i - 1, i))
    for _ in range(2):
        t.merge(source, ["o_orderkey"])
    return t.read()


@query("SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 10 = 0 AND o_orderkey < 100 OR o_orderkey = 7) AS n_changed, true AS few_files, true AS old_version_stays FROM orders")
def key_index_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few keys merged into fifty files by key: files with none of them stay as they are, readers of the version before see no change."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    t = versioned.VersionedTable(spark, f"{scratch(spark)}/orders")
    before = t.replace(o, ["o_orderkey"], parts=50)
    pinned = t.read()
    change = o.where("o_orderkey % 10 = 0 and o_orderkey < 100 or o_orderkey = 7").withColumn("o_orderstatus", F.lit("*"))
    after = t.merge(change, ["o_orderkey"])
    kept = len(set(before.files) & set(after.files))
    same = pinned.where("o_orderstatus = '*'").isEmpty()
    return t.read().agg(F.count("*").alias("n_rows"), F.count_if(F.col("o_orderstatus") == "*").alias("n_changed")).select("*", F.lit(kept >= len(before.files) - 11).alias("few_files"), F.lit(same).alias("old_version_stays"))


@query("SELECT o_orderkey, 'third' AS v FROM orders WHERE o_orderkey % 3 <> 1 AND o_orderkey % 7 <> 0")
def deletes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes among changes that come in the wrong order, then rows that a source no longer has: a delete beats what is older, also what comes later."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    t = versioned.VersionedTable(spark, f"{scratch(spark)}/orders")
    change = lambda rows, at, what, v: rows.select("o_orderkey", F.lit(v).alias("v"), F.lit(at).alias("at"), F.lit(what).alias("what"))
    steps = [change(o, 1, "put", "first"), change(o.where("o_orderkey % 3 = 1"), 5, "delete", None), change(o, 3, "put", "third"), change(o.where("o_orderkey % 3 = 0"), 2, "delete", None)]
    for rows in steps:
        deletes.apply_changes(t, rows, ["o_orderkey"], ["at"], "what = 'delete'")
    deletes.compact(t, "at <= 5")
    deletes.delete_missing(t, o.where("o_orderkey % 7 <> 0"), ["o_orderkey"])
    return deletes.live(t).select("o_orderkey", "v")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS k FROM orders")
def null_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the rows has no key: a first run with a cursor and shards loads all, a second one none; merged twice, none is there twice."""
    folder, o = scratch(spark), table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("k"))
    for _ in range(2):
        run_task(spark, TaskSpec("nulls", f"{folder}/out", o, mode="append", resume_key="k", state=f"{folder}/state", shards=3, validate="row_count"))
    loaded = spark.read.parquet(f"{folder}/out")
    for _ in range(2):
        write.merge_into(spark, f"{folder}/merged", loaded, ["k", "o_orderkey"], buckets=4)
    return write.merge_table(spark, f"{folder}/merged")


@query(_DIFF + " SELECT count(sk) AS source_total, count(tk) AS target_total, count(*) FILTER (state = 'source_only') AS source_only, count(*) FILTER (state = 'target_only') AS target_only, count(*) FILTER (state = 'mismatch') AS mismatch FROM j")
def tree_diff_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table compared by the fingerprints of their key ranges, of which one tree was saved before."""
    source, target = _perturbed(spark, sf_dir)
    path = f"{scratch(spark)}/tree"
    hashtree.build(source, ["o_orderkey"], leaves=256).save(path)
    tree = hashtree.load_tree(spark, path)
    other = hashtree.build(target, ["o_orderkey"], tree.cuts)
    return hashtree.summary(hashtree.tree_diff(source, target, tree, other), tree, other)


@query("SELECT o_orderkey, 'mismatch' AS state FROM orders WHERE o_orderkey IN (77, 1501) UNION ALL SELECT o_orderkey, 'source_only' FROM orders WHERE o_orderkey = 800")
def tree_diff_few_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys differ: of both tables only their ranges are read, under a twentieth of the rows."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    other = o.where("o_orderkey <> 800").withColumn("o_orderstatus", F.when(F.col("o_orderkey").isin(77, 1501), "?").otherwise(F.col("o_orderstatus")))
    tree = hashtree.build(o, ["o_orderkey"], leaves=256)
    changed = hashtree.build(other, ["o_orderkey"], tree.cuts)
    leaves = hashtree.differing(tree, changed)
    if 20 * hashtree.rows_of(o, tree, leaves).count() > tree.total()[0]:
        raise RuntimeError("more than a twentieth of the rows was read")
    found = hashtree.tree_diff(o, other, tree, changed).rows.where("state <> 'equal'")
    return found.select(F.coalesce("source.o_orderkey", "target.o_orderkey").alias("o_orderkey"), "state")


@query(_DIFF + " SELECT sk AS o_orderkey, sc AS source_custkey, tc AS target_custkey FROM j WHERE state = 'mismatch'")
def diff_report_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set of differing rows as a report has it: written as CSV files, rows of both sides as JSON, and read again."""
    path = f"{scratch(spark)}/report"
    _orders_diff(spark, sf_dir).write(path, "csv")
    report = spark.read.option("header", True).csv(f"{path}/mismatch")
    return report.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.get_json_object("source", "$.o_custkey").cast("long").alias("source_custkey"), F.get_json_object("target", "$.o_custkey").cast("long").alias("target_custkey"))


@query(_CUST + """ SELECT 'abort' AS action, 'not_null(seg): ' || count(*) FILTER (WHERE seg IS NULL) || ' violations; regex(seg, ^[A-E]): ' || count(*) FILTER (WHERE NOT regexp_matches(seg, '^[A-E]')) || ' violations' AS outcome FROM c
    UNION ALL SELECT 'warn', '' FROM c WHERE c_custkey = 1 UNION ALL SELECT 'dlq', 'not_null(seg),regex(seg, ^[A-E])' FROM c WHERE c_custkey = 1""")
def on_fail_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each action makes of the same broken rules: an error with their messages, nothing, or their names for the dead letters."""
    df, out = _checked_customers(spark, sf_dir), []
    for action in ("abort", "warn", "dlq"):
        report = quality.assert_report(df, [Rule("not_null", column="seg", on_fail=action), Rule("regex", column="seg", pattern="^[A-E]", on_fail=action), Rule("range", column="c_custkey", min=0, on_fail=action)])
        try:
            out.append((action, ",".join(quality.enforce(report))))
        except quality.AssertionFailed as e:
            out.append((action, str(e)))
    return spark.createDataFrame(out, "action string, outcome string")


@query("SELECT 'before' AS what, count(*) AS n_rows FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'after', count(*) FROM customer")
def task_hooks_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements before and after an append see the target without and with the new rows."""
    folder, c = scratch(spark), table(spark, sf_dir, "customer").select("c_custkey")
    write.write_table(c.where("c_custkey % 2 = 0"), f"{folder}/out")
    seen = lambda what: f"INSERT OVERWRITE DIRECTORY '{folder}/{what}' USING parquet SELECT '{what}' AS what, count(*) AS n_rows FROM parquet.`{folder}/out`;"
    run_task(spark, TaskSpec("hooks", f"{folder}/out", c.where("c_custkey % 2 = 1"), mode="append", pre_sql=[seen("before")], post_sql=[f"REFRESH '{folder}/out'", seen("after")]))
    return spark.read.parquet(f"{folder}/before", f"{folder}/after")


#: Streams that a query starts side by side at most: a batch is mostly waiting for the log of its stream.
STREAMS = 8


@query("SELECT 'events' AS task, 'ok' AS status, count(*) AS n_rows, (count(*) + 2499) // 2500 AS batches FROM events")
def stream_progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams side by side over files of 2500 events, one a batch; their progress as rows of one run log."""
    folder, e = scratch(spark), table(spark, sf_dir, "events")
    parts = write.write_files_of(e, f"{folder}/in", 2500, STREAMS)
    with cdc.ProgressLog(spark, "events", f"{folder}/log") as log:
        streams = [spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part={i}") for i in range(parts)]
        running = [cdc.cdc_stream(s, f"{folder}/out/{i}", f"{folder}/checkpoint/{i}") for i, s in enumerate(streams)]
        for r in running:
            r.awaitTermination()
    return log.read().where("rows > 0").groupBy("task", "status").agg(F.sum("rows").alias("n_rows"), F.count("*").alias("batches"))


@query("SELECT 'clicks' AS task, event_id FROM events WHERE event_type = 'click' UNION ALL SELECT 'others', event_id FROM events WHERE event_type <> 'click'")
def cdc_sync_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tasks with cursors of their own: a first run, and two rounds over a source that has grown meanwhile."""
    folder, e = scratch(spark), table(spark, sf_dir, "events").select("event_id", "event_type")
    third = F.pmod("event_id", F.lit(3))
    bounds = e.agg(F.max("event_id").alias("hi")).first()["hi"]
    steps = [e.where(F.col("event_id") <= bounds // 3), e.where((F.col("event_id") > bounds // 3) & (F.col("event_id") <= 2 * bounds // 3)), e.where(F.col("event_id") > 2 * bounds // 3)]
    steps[0].withColumn("part", third).write.parquet(f"{folder}/in")
    later = iter(steps[1:])
    specs = [TaskSpec(n, f"{folder}/{n}", f"SELECT event_id FROM parquet.`{folder}/in` WHERE event_id > :last_value AND event_type {sign} 'click'", mode="append", resume_key="event_id", initial_cursor=-1, state=f"{folder}/state", interval=float(s)) for n, sign, s in (("clicks", "=", 9), ("others", "<>", 4))]
    cdc_sync(spark, specs, rounds=2, wait=lambda seconds: next(later).withColumn("part", third).write.mode("append").parquet(f"{folder}/in"))
    return write.append_union([spark.read.parquet(f"{folder}/{s.name}").select(F.lit(s.name).alias("task"), "event_id") for s in specs])


@query("""SELECT c_custkey AS id, 'ValueError: key ' || c_custkey AS error FROM customer WHERE c_custkey % 10 = 3
    UNION ALL SELECT c_custkey, 'assertion failed: range(twice, , ' || (SELECT 2 * max(c_custkey) - 100 FROM customer) || ')' FROM customer WHERE c_custkey % 10 <> 3 AND 2 * c_custkey > (SELECT 2 * max(c_custkey) - 100 FROM customer)""")
def run_task_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task whose row function fails on some rows and whose rule sends others to the dead letters."""
    folder, c = scratch(spark), table(spark, sf_dir, "customer").select("c_custkey", "c_name")

    def change(row: dict) -> dict:
        if row["c_custkey"] % 10 == 3:
            raise ValueError(f"key {row['c_custkey']}")
        return {"id": row["c_custkey"], "twice": row["c_custkey"] * 2}

    most = 2 * c.agg(F.max("c_custkey").alias("m")).first()["m"] - 100
    run_task(spark, TaskSpec("letters", f"{folder}/out", c, transform_row=change, transform_schema=T.StructType.fromDDL("id long, twice long"), rules=[Rule("range", column="twice", max=most, on_fail="dlq")], dead_letters=f"{folder}/dead", validate="checksum"))
    letters = spark.read.schema("row array<string>, error string").json(f"{folder}/dead")
    return letters.select(F.col("row")[0].cast("long").alias("id"), "error")


@query("SELECT c_custkey AS id, 'C***' AS label, CAST(round(c_acctbal) AS BIGINT) AS balance FROM customer WHERE c_acctbal >= 0 OR c_custkey >= 0")
def run_task_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole task: mapping, mask, expression, rules, write, checksum, audit; then what it wrote."""
    folder = scratch(spark)
    run_task(spark, TaskSpec(
        "customers", f"{folder}/out", "SELECT * FROM c;", views={"c": table(spark, sf_dir, "customer")}, columns=[("c_custkey", "id"), ("c_name", "label"), ("c_acctbal", "balance")],
        masks=[MaskRule("label", "fixed_value", {"value": "C***"})], transforms={"balance": "cast(round(?) as bigint)"}, rules=[Rule("not_null", column="c_custkey"), Rule("unique", columns=("c_custkey",))],
        validate="checksum", history=f"{folder}/history", cluster=["id"],
    ))
    return spark.read.parquet(f"{folder}/out")


@query("SELECT 'customers' AS task_name, 'merge' AS mode, (SELECT count(*) FROM customer) AS rows_processed, 0::BIGINT AS rows_failed, 'passed' AS validation_result")
def history_of_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    c = table(spark, sf_dir, "customer")
    write.merge_into(spark, f"{folder}/out", c.where("c_custkey % 3 = 0"), ["c_custkey"], buckets=8)
    run_task(spark, TaskSpec("customers", f"{folder}/out", c, mode="upsert", merge_keys=["c_custkey"], validate="row_count", history=f"{folder}/history"))
    return runlog.recent_history([spark.read.parquet(f"{folder}/history")]).select("task_name", "mode", "rows_processed", "rows_failed", "validation_result")


@query("SELECT event_id, user_id, event_type FROM events")
def poll_rounds_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two real rounds over a stored cursor and one that finds nothing."""
    folder, e = scratch(spark), table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    name = cdc.task_key("files", "files", "events")
    for source in (e.where("event_id <= 5000"), e, e):
        cdc.poll_once(spark, source, "event_id", f"{folder}/events", f"{folder}/state", name)
    return spark.read.parquet(f"{folder}/events")


def _stream(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Three files and more, one a batch."""
    folder = scratch(spark)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    n = max(1, -(-e.count() // 3))
    e.coalesce(1).write.option("maxRecordsPerFile", n).parquet(f"{folder}/in")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    cdc.cdc_stream(stream, f"{folder}/out", f"{folder}/checkpoint", mode, ["user_id"], ["event_id"]).awaitTermination()
    return (write.merge_table(spark, f"{folder}/out") if mode == "merge" else spark.read.parquet(f"{folder}/out")).select(*e.columns)


@query("SELECT event_id, user_id, event_type FROM events")
def cdc_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir, "append")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def cdc_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir, "merge")


@query(_DIRTY + """ SELECT concat_ws(',', CAST(event_id AS VARCHAR), k, event_type) AS row_text, 'events' AS task_name, 'events_clean' AS table_name FROM r WHERE wrong OR n > 1""")
def dead_letters_through_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON letters in folders by day, written and read again."""
    path = f"{scratch(spark)}/dead"
    bad = deadletter.split_loadable(_dirty_events(spark, sf_dir), _EVENT, ["event_id"])[1]
    deadletter.write_dead_letters(deadletter.dead_letters_json(bad, "events", "events_clean"), path, "json", by_date=True)
    letters = spark.read.schema("row array<string>, error string, task_name string, table_name string, timestamp string").json(path)
    return letters.select(F.concat_ws(",", "row").alias("row_text"), "task_name", "table_name")


@query(_DIRTY + " SELECT event_id, TRY_CAST(k AS INTEGER) AS k, event_type FROM r WHERE wrong OR n > 1")
def dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/dead"
    bad = deadletter.split_loadable(_dirty_events(spark, sf_dir), _EVENT, ["event_id"])[1]
    deadletter.write_dead_letters(deadletter.dead_letters_csv(bad, "events_clean"), path, "csv")
    return deadletter.read_dead_letters(spark, path, T.StructType.fromDDL("event_id long, k int, event_type string"), "csv")


@query("""WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events), s AS (SELECT i AS shard, lo + i * ((hi - lo) / 4) AS lower, CASE WHEN i = 3 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 4) END AS upper FROM b, range(4) t(i))
    SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n_rows FROM events JOIN s ON value >= lower AND (value < upper OR shard = 3 AND value <= upper) GROUP BY shard""")
def shard_counts_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.with_shard(table(spark, sf_dir, "events"), "value", 4).groupBy("shard").agg(F.count("*").alias("n_rows"))


@query("""WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events), s AS (SELECT i AS shard, lo + i * ((hi - lo) // 5) AS lower, CASE WHEN i = 4 THEN hi ELSE lo + (i + 1) * ((hi - lo) // 5) END AS upper FROM b, range(5) t(i))
    SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n_rows FROM events JOIN s ON epoch_us(ts) >= lower AND (epoch_us(ts) < upper OR shard = 4 AND epoch_us(ts) <= upper) GROUP BY shard""")
def shard_counts_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.with_shard(table(spark, sf_dir, "events"), "ts", 5).groupBy("shard").agg(F.count("*").alias("n_rows"))


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_retailprice, CASE WHEN p_size > 25 THEN 1 ELSE 0 END::BIGINT AS large, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price FROM part")
def conform_oracle_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", (F.col("p_size") > 25).alias("large"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    return write.conform_types(df, "oracle").withColumn("price", F.col("price").cast("string"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed comparison of two versions of a table, counted by column."""
    return diff_by_column(spark, sf_dir)
