"""Data-quality rules. Each rule is a predicate on a row or on a key; NULL violates only not_null."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .project import column_named

log = logging.getLogger(__name__)


class AssertionFailed(Exception):
    """Raised for rules that abort; holds all of their messages."""


@dataclass(frozen=True)
class Rule:
    """not_null, range, in_set, unique, regex, min_length or max_length, with what to do on failure: abort, warn or dlq."""

    rule: str
    column: str = ""
    columns: tuple[str, ...] = ()
    min: Any = None
    max: Any = None
    values: tuple[str, ...] = ()
    pattern: str = ""
    length: int = 0
    on_fail: str = "abort"

    def __post_init__(self) -> None:
        needs = {
            "not_null": bool(self.column), "range": bool(self.column) and (self.min is not None or self.max is not None), "in_set": bool(self.column and self.values), "unique": bool(self.columns),
            "regex": bool(self.column and self.pattern), "min_length": bool(self.column) and self.length >= 0, "max_length": bool(self.column) and self.length >= 0,
        }
        if self.rule not in needs:
            raise ValueError(f"unknown rule: {self.rule}")
        if not needs[self.rule]:
            raise ValueError(f"rule {self.rule} lacks a parameter")
        if self.on_fail not in ("abort", "warn", "dlq"):
            raise ValueError(f"unknown on_fail: {self.on_fail}")

    @property
    def description(self) -> str:
        if self.rule == "unique":
            return f"unique({', '.join(self.columns)})"
        if self.rule == "range":
            return f"range({self.column}, {'' if self.min is None else self.min}, {'' if self.max is None else self.max})"
        more = {"in_set": ", ".join(self.values), "regex": self.pattern, "min_length": self.length, "max_length": self.length}.get(self.rule)
        return f"{self.rule}({self.column})" if more is None else f"{self.rule}({self.column}, {more})"

    def renamed(self, pairs: list[tuple[str, str]]) -> Rule:
        """The rule after a column mapping, for a check of the target."""
        names = {s.lower(): t for s, t in pairs}
        from dataclasses import replace

        return replace(self, column=names.get(self.column.lower(), self.column), columns=tuple(names.get(c.lower(), c) for c in self.columns))

    def violated(self, df: DataFrame) -> Column:
        """The row's violation; not for unique."""
        c = F.col(f"`{column_named(df, self.column)}`")
        if self.rule == "not_null":
            return c.isNull()
        if self.rule == "range":
            return reduce(lambda x, y: x | y, [c < F.lit(self.min)] * (self.min is not None) + [c > F.lit(self.max)] * (self.max is not None))
        if self.rule == "in_set":
            return ~c.cast("string").isin(*self.values)
        if self.rule == "regex":
            return ~c.cast("string").rlike(self.pattern)
        return F.char_length(c.cast("string")) < self.length if self.rule == "min_length" else F.char_length(c.cast("string")) > self.length


def duplicate_keys(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their counts; NULLs group together."""
    return (df.where(where) if where else df).groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def unique_violations(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Keys that a unique index would refuse: SQL lets keys with a NULL repeat."""
    return duplicate_keys(df.dropna(subset=list(columns)), columns, where)


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule_no, violations: one pass for all row rules, one grouping for each unique rule."""
    row_rules = [(i, r) for i, r in enumerate(rules) if r.rule != "unique"]
    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(r.violated(df)).alias(f"r{i}") for i, r in row_rules])
        pairs = ", ".join(f"{i}, r{i}" for i, _ in row_rules)
        parts.append(counts.selectExpr(f"stack({len(row_rules)}, {pairs}) as (rule_no, violations)"))
    for i, r in enumerate(rules):
        if r.rule == "unique":
            parts.append(duplicate_keys(df, list(r.columns)).agg(F.count("*").alias("violations")).select(F.lit(i).alias("rule_no"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def assert_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, column_name, description, violations, passed, on_fail: one row for each rule."""
    def named(get) -> Column:
        return F.element_at(F.array(*[F.lit(get(r)) for r in rules]), F.col("rule_no") + 1)

    return violation_counts(df, rules).select(
        named(lambda r: r.rule).alias("rule"), named(lambda r: r.column or ",".join(r.columns)).alias("column_name"), named(lambda r: r.description).alias("description"),
        "violations", (F.col("violations") == 0).alias("passed"), named(lambda r: r.on_fail).alias("on_fail"),
    )


def tagged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows with the messages of all rules they violate; members of repeated keys violate unique."""
    messages = [F.when(r.violated(df), F.lit(f"assertion failed: {r.description}")) for r in rules if r.rule != "unique"]
    out = df
    for i, r in enumerate(r for r in rules if r.rule == "unique"):
        repeated = duplicate_keys(df, list(r.columns)).select(*[F.col(f"`{c}`").alias(f"_u{j}") for j, c in enumerate(r.columns)], F.lit(True).alias(f"_unique{i}"))
        same = reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.col(f"_u{j}")) for j, c in enumerate(r.columns)])
        out = out.join(repeated, same, "left").drop(*[f"_u{j}" for j in range(len(r.columns))])
        messages.append(F.when(F.col(f"_unique{i}"), F.lit(f"assertion failed: {r.description}")))
    return out.withColumn("_messages", F.array_compact(F.array(*messages))).select(*df.columns, "_messages")


def violating_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row for each row and rule it violates, with the message as _error."""
    return tagged(df, rules).select(*df.columns, F.explode("_messages").alias("_error"))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows without a violation, and the others with their messages joined as _error."""
    all_rows = tagged(df, rules)
    return all_rows.where("size(_messages) = 0").drop("_messages"), all_rows.where("size(_messages) > 0").withColumn("_error", F.concat_ws("; ", "_messages")).drop("_messages")


def enforce(report: DataFrame) -> list[str]:
    """Act on a report (one row for each rule): raise for abort, log for warn; returns the descriptions for the dead letters."""
    failed = report.where("not passed").collect()
    text = [f"{r['description']}: {r['violations']} violations" for r in failed if r["on_fail"] == "abort"]
    if text:
        raise AssertionFailed("; ".join(text))
    for r in failed:
        if r["on_fail"] == "warn":
            log.warning("assertion failed: %s: %s violations", r["description"], r["violations"])
    return [r["description"] for r in failed if r["on_fail"] == "dlq"]
