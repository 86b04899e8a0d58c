"""Deletes that are applied to versioned tables.

A delete that comes as a change leaves a tombstone: a row of the key with its place in the order of changes and nothing else. So a change
that is older than the delete but comes later does not bring the row back. Readers take the live rows; a compaction drops
tombstones that no late change can meet any more. Rows that a source no longer has go at once, or become tombstones too.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .join import detect_deletes
from .project import column_named
from .versioned import Snapshot, VersionedTable

#: The column that says whether a row is a tombstone.
MARK = "_deleted"


def apply_changes(table: VersionedTable, changes: DataFrame, keys: list[str], order_by: list[str], deleted: str) -> Snapshot:
    """Upsert changes in the order of order_by, whenever they come; those for which the condition (SQL) holds are deletes.

    A change with a NULL in its key is refused, as nothing can be told to be its own.
    """
    known = {c.lower() for c in [*(column_named(changes, k) for k in keys), *(column_named(changes, c) for c in order_by)]}
    gone = F.coalesce(F.expr(deleted), F.lit(False))
    missing = F.greatest(F.lit(False), *[F.col(f"`{column_named(changes, k)}`").isNull() for k in keys])
    mark = F.when(missing, F.raise_error(F.lit("a change without a key"))).otherwise(gone)
    # of a deleted row its key and its order alone
    rows = changes.select(*[F.col(f"`{c}`") if c.lower() in known else F.when(~gone, F.col(f"`{c}`")).alias(c) for c in changes.columns], mark.alias(MARK))
    return table.merge(rows, keys, order_by, newest=True)


def live(table: VersionedTable, version: int | None = None) -> DataFrame:
    """The rows that are not deleted."""
    rows = table.read(version)
    return rows.where(~F.coalesce(F.col(MARK), F.lit(False))).drop(MARK) if MARK in rows.columns else rows


def compact(table: VersionedTable, settled: str) -> Snapshot:
    """Drop the tombstones for which the condition (SQL) holds; only files that have one are written anew."""
    return table.delete_where(F.col(MARK) & F.expr(settled), "compact")


def delete_missing(table: VersionedTable, source: DataFrame, keys: list[str], order: dict[str, Any] | None = None) -> Snapshot:
    """Delete the live rows whose key the source no longer has. With an order (a value for each order column) they become tombstones of that place, else they go at once."""
    rows = detect_deletes(live(table), source, keys)
    own = [column_named(rows, k) for k in keys]
    if order is None:
        return table.delete_keys(rows.select(*own), own)
    schema = table.read().schema
    marked = rows.select(*own, *[F.lit(v).cast(schema[c].dataType).alias(c) for c, v in order.items()], *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in (*own, *order, MARK)], F.lit(True).alias(MARK))
    return table.merge(marked, own, list(order), newest=True)
