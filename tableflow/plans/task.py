"""Run one task: scan, map, mask, transform, check, write, validate, audit. Or many, again and again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import mask_table
from ..operators import deadletter, quality, reconcile, runlog, write
from ..operators.join import federated_join
from ..operators.project import map_columns, transform_columns
from ..sources.scans import incremental_scan, jdbc_scan, sharded_scan, templated_scan, up_to
from ..streaming.cdc import load_cursor, max_cursor, save_cursor
from .spec import TaskSpec

VERSION = "0.2"


@dataclass
class TaskResult:
    name: str
    rows: int
    failed: int
    validation: str
    cursor: object = None


def run_sql(spark: SparkSession, statements: list[str]) -> None:
    """Statements in order; the first that fails fails the task."""
    for s in statements:
        spark.sql(s.strip().rstrip(";"))


def _cursor(spark: SparkSession, spec: TaskSpec) -> object:
    if spec.in_target:
        return write.Target(spark, spec.target).versions().cursor(spec.name, spec.initial_cursor)
    return load_cursor(spark, spec.state, spec.name, spec.initial_cursor) if spec.state else spec.initial_cursor


def _source(spark: SparkSession, spec: TaskSpec, cursor: object) -> DataFrame:
    if spec.join:
        left, right, keys, how = spec.join
        return federated_join(left, right, keys, how)
    if isinstance(spec.source, dict):
        return jdbc_scan(spark, **spec.source, key=spec.resume_key, cursor=cursor, shards=spec.shards)
    if isinstance(spec.source, str) and ":last_value" in spec.source:
        return templated_scan(spark, spec.source, cursor, key=spec.resume_key, views=spec.views)
    df = templated_scan(spark, spec.source, views=spec.views) if isinstance(spec.source, str) else spec.source
    if spec.shards > 1 and spec.resume_key:
        return sharded_scan(df, spec.resume_key, spec.shards, cursor)
    return incremental_scan(df, spec.resume_key, cursor) if spec.resume_key else df


def _shaped(spec: TaskSpec, df: DataFrame) -> DataFrame:
    if spec.transforms:
        df = transform_columns(df, spec.transforms)
    return write.conform_types(df, spec.profile) if spec.profile else df


def _masked(spec: TaskSpec, source: DataFrame) -> DataFrame:
    return mask_table(map_columns(source, spec.columns), spec.masks, spec.seed)


def prepared(spark: SparkSession, spec: TaskSpec, source: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows to write and those that the row function failed on; both lazy."""
    df = _masked(spec, _source(spark, spec, _cursor(spark, spec)) if source is None else source)
    bad = None
    if spec.transform_row:
        df, bad = deadletter.row_transform(df, spec.transform_row, spec.transform_schema, "dlq" if spec.dead_letters else "abort", spec.transform_limit)
    return _shaped(spec, df), bad


class _Staging:
    """Tables of one run beside its target, so that what is checked, counted and written are the same rows, made once."""

    def __init__(self, spark: SparkSession, spec: TaskSpec):
        at = spec.staging or (f"{spec.target.rstrip('/')}_task" if write.is_path(spec.target) else None)
        self.spark, self.folder, self.made = spark, f"{at}_{uuid.uuid4().hex}" if at else None, False

    def saved(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The rows as they were staged, and their number."""
        if self.folder is None:
            self.folder = write.work_folder(self.spark)
        rows, written = write.counted(df)
        rows.write.parquet(f"{self.folder}/{name}")
        self.made = True
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}"), written()

    def drop(self) -> None:
        if self.made:
            write.remove(self.spark, self.folder)


def _write_letters(spec: TaskSpec, bad: DataFrame) -> int:
    letters = deadletter.dead_letters_json(bad, spec.name, spec.target) if spec.dead_letter_format == "json" else deadletter.dead_letters_csv(bad, spec.target)
    seen = letters.count()
    if seen:
        deadletter.write_dead_letters(letters, spec.dead_letters, spec.dead_letter_format)
    return seen


def run_task(spark: SparkSession, spec: TaskSpec) -> TaskResult:
    """The whole task. The cursor is saved last, so a failed run is simply run again.

    Where rows are used more than once (rules, checks, a row function, a merge), they are staged first: the source is read and the row
    function called once for each row. The writes count their rows; the target is read again only by what was asked for (validate, rules).
    """
    started, result, error, failed, rows = datetime.now(timezone.utc), "", "", 0, 0
    cursor, staging, staged = None, _Staging(spark, spec), None
    try:
        since = _cursor(spark, spec)
        source = _source(spark, spec, since)
        if spec.state:
            cursor = max_cursor(source, spec.resume_key)
            if cursor is not None:  # rows that arrive meanwhile wait for the next run
                source = up_to(source, spec.resume_key, cursor, since is None)
            elif since is None and spec.mode == "append":  # rows without a key wait for the first that has one; a cursor is saved with them
                source = source.limit(0)
        df = _masked(spec, source)
        if spec.transform_row:
            both, _ = staging.saved(deadletter.tagged_transform(df, spec.transform_row, spec.transform_schema, "dlq" if spec.dead_letters else "abort", spec.transform_limit), "transformed")
            df, bad = deadletter.split_transformed(both, spec.transform_schema)
            if spec.dead_letters:
                failed += _write_letters(spec, bad)
        df = _shaped(spec, df)
        if spec.transforms and spec.transform_row or not spec.transform_row and (spec.rules or spec.validate or spec.mode == "merge"):
            df, staged = staging.saved(df, "rows")
        if spec.rules:
            own = [r.renamed(spec.columns) for r in spec.rules]
            to_letters = quality.enforce(quality.assert_report(df, own))
            if to_letters:
                kept = [r for r in own if r.description in to_letters]
                failed += _write_letters(spec, quality.violating_rows(df, kept))
        target = write.Target(spark, spec.target, spec.options, spec.schema_evolution)
        exists = target.exists()
        old = target.read() if exists and spec.mode != "replace" and spec.validate in ("row_count", "checksum") else None
        before = old.count() if old is not None and spec.validate == "row_count" else 0
        filled = old is not None and spec.validate == "checksum" and not old.isEmpty()
        if staged is None and (spec.validate == "row_count" or spec.mode == "merge"):
            staged = df.count()  # of what the row function gave, which is staged
        grown = rows = staged or 0
        if spec.mode == "merge" and spec.validate == "row_count":
            grown = write.inserted_keys(old, df, spec.merge_keys) if old is not None else write.one_row_per_key(df, spec.merge_keys, None).count()
        had = reconcile.fingerprint(old, df.columns).first() if spec.validate == "checksum" and spec.mode == "append" and filled and not spec.schema_evolution else None
        run_sql(spark, spec.pre_sql)
        written = target.write(df, spec, exists, (spec.name, target.versions().cursor(spec.name), cursor) if spec.in_target and cursor is not None else None)
        rows = rows if written is None else written
        now = target.read()
        after = now.count() if spec.validate == "row_count" else 0
        run_sql(spark, spec.post_sql)
        after_load = [r.renamed(spec.columns) for r in spec.rules if r.on_fail != "dlq"]
        if after_load:
            quality.enforce(quality.assert_report(now, after_load))
        result = _validated(spec, df, now, before, after, grown, had, filled)
        if cursor is not None and not spec.in_target:
            save_cursor(spark, spec.state, spec.name, cursor)
    except Exception as e:
        error = str(e)
        raise
    finally:
        staging.drop()
        if spec.history:
            runlog.record_history(spark, {
                "id": uuid.uuid4().hex, "config_hash": spec.fingerprint(), "started_at": started, "finished_at": datetime.now(timezone.utc), "task_name": spec.name, "source_db": "spark", "target_db": spec.target,
                "mode": spec.mode, "rows_processed": rows, "rows_failed": failed, "validation_result": result, "error_message": error, "version": VERSION,
            }, spec.history)
    return TaskResult(spec.name, rows, failed, result, cursor)


def _validated(spec: TaskSpec, df: DataFrame, target: DataFrame, before: int, after: int, grown: int, had, filled: bool) -> str:
    """passed, or what is wrong; empty when nothing was asked."""
    if spec.validate == "row_count":
        return "passed" if (r := reconcile.validate_row_count(before, after, grown))[0] else r[1]
    if spec.validate == "checksum":
        if spec.mode == "merge":  # of the rows with the keys that were merged, and those without a key among the others
            wanted = write.one_row_per_key(write.in_types(df, target), spec.merge_keys, spec.order_by or None).select(*[c for c in target.columns if c.lower() in {x.lower() for x in df.columns}])
            whole = wanted.dropna(subset=spec.merge_keys)
            same = reconcile.validate_checksum(whole, target.join(whole.select(*spec.merge_keys), spec.merge_keys, "left_semi")).first()["passed"] and reconcile.missing_rows(wanted, target).isEmpty()
        elif had is not None:  # old and new rows together, as often
            a, b = reconcile.fingerprint(write.in_types(df, target), df.columns).first(), reconcile.fingerprint(target, df.columns).first()
            same = (b["n_rows"], b["hash_sum"], b["hash_xor"]) == (a["n_rows"] + had["n_rows"], (a["hash_sum"] or 0) + (had["hash_sum"] or 0), (a["hash_xor"] or 0) ^ (had["hash_xor"] or 0))
        elif filled:
            same = reconcile.missing_rows(df, target).isEmpty()  # the table has other columns now, so older rows hash differently
        else:
            same = reconcile.validate_checksum(df, target).first()["passed"]
        return "passed" if same else "checksum: source and target differ"
    if spec.validate == "sample":
        rows = write.one_row_per_key(df, spec.merge_keys, spec.order_by or None) if spec.mode == "merge" else df
        shared = [c for c in rows.columns if c.lower() in {x.lower() for x in target.columns}]
        _, counts = reconcile.validate_sample(rows.select(*shared), target.select(*shared), spec.sample_size, seed=spec.seed)
        row = counts.first()
        return "passed" if row["passed"] else f"sample: {row['missing']} of {row['sampled']} rows are missing or differ"
    return ""


def cdc_sync(spark: SparkSession, specs: list[TaskSpec], rounds: int, wait: Callable[[float], None] = time.sleep) -> list[list[TaskResult]]:
    """Every task once, then so many rounds of those that have an interval, at the smallest of their intervals.

    A task of a round reads past its stored cursor. Results by round, the initial run first; a task that fails ends the sync.
    """
    again = [s for s in specs if s.interval is not None]
    if any(not s.state for s in again):
        raise ValueError("a task with an interval needs a state table")
    out = [[run_task(spark, s) for s in specs]]
    for _ in range(rounds if again else 0):
        wait(min(s.interval for s in again))
        out.append([run_task(spark, s) for s in again])
    return out
