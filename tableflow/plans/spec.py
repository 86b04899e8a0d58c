"""What one task moves and how."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.masks import MaskRule
from ..operators.quality import Rule


@dataclass
class TaskSpec:
    """One movement of a table.

    source is a DataFrame, SQL over views, or a database: a dict of url, query and properties. With shards a source with a
    resume_key is read in so many ranges of it. transform_limit is the time in seconds that transform_row may take for a row. target is a folder of Parquet files, ``versioned:`` and a folder
    with a log of versions (state "target" keeps the cursor in it), ``catalog:`` and the name of a table, or ``jdbc:`` and the rest of a database's url, with options dbtable and what else the driver needs. interval (seconds)
    marks a task that cdc_sync runs again. Rows are staged beside a folder; for other targets below staging, else in the session's
    folder for checkpoints. Rows whose resume_key is NULL are loaded by the first run, which has no cursor, and by no later one.
    """

    name: str
    target: str
    source: DataFrame | str | dict[str, Any]
    views: dict[str, DataFrame] = field(default_factory=dict)
    join: tuple[DataFrame, DataFrame, list[str], str] | None = None
    mode: str = "replace"
    columns: list[tuple[str, str]] = field(default_factory=list)
    transforms: dict[str, str] = field(default_factory=dict)
    masks: list[MaskRule] = field(default_factory=list)
    seed: int = 0
    transform_row: Callable[[dict], dict] | None = None
    transform_schema: T.StructType | None = None
    transform_limit: float | None = None
    rules: list[Rule] = field(default_factory=list)
    merge_keys: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=list)
    resume_key: str | None = None
    initial_cursor: Any = None
    state: str | None = None
    schema_evolution: bool = False
    must_exist: bool = False
    cluster: list[str] = field(default_factory=list)
    profile: str | None = None
    dead_letters: str | None = None
    dead_letter_format: str = "json"
    validate: str | None = None
    sample_size: int = 1000
    pre_sql: list[str] = field(default_factory=list)
    post_sql: list[str] = field(default_factory=list)
    history: str | None = None
    shards: int = 1
    options: dict[str, str] = field(default_factory=dict)
    staging: str | None = None
    interval: float | None = None

    def __post_init__(self) -> None:
        self.mode = "merge" if self.mode == "upsert" else self.mode
        if not self.name or not self.target:
            raise ValueError("a task needs a name and a target")
        if self.mode not in ("replace", "append", "merge"):
            raise ValueError(f"unknown mode: {self.mode}")
        if self.mode == "merge" and not self.merge_keys:
            raise ValueError("merge needs merge_keys")
        if self.mode == "merge" and self.schema_evolution and self.target.startswith("jdbc:"):
            raise ValueError("a merge into a database adds no columns")
        if self.target.startswith("jdbc:") and "dbtable" not in self.options:
            raise ValueError("a database target needs the option dbtable")
        if self.target.startswith("versioned:") and any("(" in c for c in self.cluster):
            raise ValueError("a versioned table is kept in the order of its keys")
        if self.shards > 1 and not self.resume_key:
            raise ValueError("shards need a resume_key")
        if self.state == "target" and not self.target.startswith("versioned:"):
            raise ValueError("only a versioned target keeps the cursor")
        if self.state and not self.resume_key:
            raise ValueError("a state table needs a resume_key")
        if self.schema_evolution and self.mode == "replace":
            raise ValueError("schema_evolution is for append and merge")
        if self.transform_row and self.transform_schema is None:
            raise ValueError("transform_row needs transform_schema")
        if self.validate not in (None, "row_count", "checksum", "sample"):
            raise ValueError(f"unknown validation: {self.validate}")
        if any(r.on_fail == "dlq" for r in self.rules) and not self.dead_letters:
            raise ValueError("a rule with on_fail dlq needs dead_letters")

    @property
    def in_target(self) -> bool:
        """Whether the cursor is kept in the target's log, committed together with the rows."""
        return self.state == "target" and self.target.startswith("versioned:")

    def fingerprint(self) -> str:
        """A hash of the task's settings for its audit row."""
        plain = {k: v for k, v in vars(self).items() if isinstance(v, (str, int, bool, list, dict, type(None))) and k != "views"}
        return hashlib.sha256(repr(sorted(plain.items())).encode()).hexdigest()[:16]
