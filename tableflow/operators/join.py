"""Joins of two sources: Catalyst and AQE choose broadcast or sort-merge by size; nothing is capped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import common_type, key_value
from .project import column_named


def _comparable(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> tuple[list[Column], list[Column]]:
    """The keys of both sides in the types they are compared in."""
    kinds = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in pairs]
    wanted = [common_type(x, y) for x, y in kinds]
    own = [key_value(left[f"`{a}`"], x, w) for (a, _), (x, _), w in zip(pairs, kinds, wanted, strict=True)]
    other = [key_value(right[f"`{b}`"], y, w) for (_, b), (_, y), w in zip(pairs, kinds, wanted, strict=True)]
    return own, other


def check_column_conflicts(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    """Non-key columns of one name on both sides are an error."""
    known = {k.lower() for k in keys}
    both = sorted({c.lower() for c in left.columns} & {c.lower() for c in right.columns} - known)
    if both:
        raise ValueError(f"columns on both sides: {', '.join(both)}; rename one side with an alias")


def federated_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join: keys, then the kept side's other columns, then the rest. NULL keys match nothing; duplicates multiply.

    Keys of one type compare natively, numbers by value, other mixed types by their exact text.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unknown join type: {how}")
    check_column_conflicts(left, right, keys)
    pairs = [(column_named(left, k), column_named(right, k)) for k in keys]
    matches = [x == y for x, y in zip(*_comparable(left, right, pairs), strict=True)]
    joined = left.join(right, matches, how)
    own = right if how == "right" else left
    shown = [own[f"`{b if how == 'right' else a}`"].alias(a) for a, b in pairs]
    used_left, used_right = {a for a, _ in pairs}, {b for _, b in pairs}
    rest_left = [left[f"`{c}`"] for c in left.columns if c not in used_left]
    rest_right = [right[f"`{c}`"] for c in right.columns if c not in used_right]
    return joined.select(*shown, *(rest_right + rest_left if how == "right" else rest_left + rest_right))


def detect_deletes(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the target whose key the source no longer has (NULL keys match NULL keys)."""
    pairs = [(column_named(target, k), column_named(source, k)) for k in keys]
    own, other = _comparable(target, source, pairs)
    # as structs, whose NULL fields are equal
    named = lambda columns: F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])
    kept = source.select(named(other).alias("_key"))
    return target.join(kept, named(own) == kept["_key"], "left_anti")
