"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_named(df: DataFrame, name: str) -> str:
    """The column's own spelling; names match without regard to case."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"no column {name}; there are {', '.join(df.columns)}")


def map_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Only the listed columns, in that order, renamed. One source may feed two targets; no pairs leave the table as it is."""
    if not pairs:
        return df
    targets = [t.lower() for _, t in pairs]
    if len(set(targets)) < len(targets):
        raise ValueError("a target column is listed twice")
    return df.select(*[F.col(f"`{column_named(df, s)}`").alias(t) for s, t in pairs])


def transform_columns(df: DataFrame, templates: dict[str, str]) -> DataFrame:
    """SQL expressions of single columns, with ? for the value."""
    return df.withColumns({(own := column_named(df, c)): F.expr(t.replace("?", f"`{own}`")) for c, t in templates.items()})


def where_limit(df: DataFrame, where: str | None = None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """A predicate and a row limit; the limit takes the first rows in a stated order."""
    if where:
        df = df.where(where)
    if limit is None:
        return df
    if not order:
        raise ValueError("a limit needs an order")
    return df.orderBy(*order).limit(limit)
