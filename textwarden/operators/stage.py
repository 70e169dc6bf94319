"""Verdicts and stages.

A stage looks at one text column and adds ``{name}_result`` (allow, block, modify or
warn), ``{name}_reason`` and ``{name}_metadata``; on modify it rewrites the text column.
Where ``active`` is false the three columns are NULL and the text is left alone.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK, MODIFY, WARN = "allow", "block", "modify", "warn"

Facts = Callable[[Column, dict[str, Column]], dict[str, Column]]


@dataclass(frozen=True)
class Verdict:
    action: Column
    reason: Column
    metadata: Column | None = None
    text: Column | None = None


def result_columns(name: str) -> tuple[str, str, str]:
    return f"{name}_result", f"{name}_reason", f"{name}_metadata"


def pinned(column: Column) -> Column:
    """The same value, computed exactly once, in the projection it stands in.

    Catalyst copies a column's expression into every filter it pushes below it.  For
    regex work, or for a chain in which each stage depends on the ones before, the copies
    multiply.  It leaves alone what it takes for non-deterministic, as the partition
    number is.  Filters on other columns therefore belong before screening, not after.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def add_verdict(
    df: DataFrame, name: str, text_col: str, active: Column | None, verdict: Verdict
) -> DataFrame:
    """Write a verdict into its three columns, and its text where it modifies."""
    on = F.lit(True) if active is None else active
    result, reason, metadata = result_columns(name)
    columns = {
        result: F.when(on, verdict.action),
        reason: F.when(on, verdict.reason),
        metadata: F.when(on, F.lit(None) if verdict.metadata is None else verdict.metadata),
    }
    if verdict.metadata is None:
        columns[metadata] = F.lit(None).cast("string")
    if verdict.text is not None:
        columns[text_col] = F.when(on & (verdict.action == MODIFY), verdict.text).otherwise(
            F.col(text_col)
        )
    return df.withColumns(columns)


class Stage(ABC):
    """One named check on a text column."""

    def __init__(self, name: str):
        self.name = name

    @abstractmethod
    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        """Add this stage's verdict for the rows where ``active`` holds."""

    def __call__(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        return self.apply(df, text_col)

    def output_names(self) -> list[str]:
        """Names under which verdict columns appear, the deciding one last."""
        return [self.name]


class ColumnStage(Stage):
    """A stage made of column expressions only: no shuffle, no Python worker.

    ``facts`` are layers of costly intermediate columns (regex results).  Each layer
    is a projection of its own, so later expressions read a fact instead of computing
    it again, and each is guarded by ``active``, so blocked rows pay nothing.  Facts are
    pinned: filters on verdicts do not drag them along.
    """

    def __init__(
        self,
        name: str,
        decide: Callable[[Column, dict[str, Column]], Verdict],
        facts: Sequence[Facts] = (),
    ):
        super().__init__(name)
        self._decide = decide
        self._facts = tuple(facts)

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        text = F.col(text_col)
        known: dict[str, Column] = {}
        temporary: list[str] = []
        for layer in self._facts:
            new = {}
            for key, expr in layer(text, known).items():
                column = f"__{self.name}_{key}"
                new[column] = pinned(expr if active is None else F.when(active, expr))
                known[key] = F.col(column)
            df = df.withColumns(new)
            temporary += new
        df = add_verdict(df, self.name, text_col, active, self._decide(text, known))
        return df.drop(*temporary)


def custom_stage(
    name: str,
    decide: Callable[[Column], Verdict] | None = None,
    *,
    batch_fn: Callable | None = None,
) -> Stage:
    """A user's own check.

    ``decide`` maps the text column to a ``Verdict`` and stays in the JVM.  ``batch_fn``
    is a ``pandas_udf`` from texts to ``struct<action, reason, text>``; it receives
    NULL for rows an earlier stage has blocked.
    """
    if (decide is None) == (batch_fn is None):
        raise ValueError("give either decide or batch_fn")
    if decide is not None:
        return ColumnStage(name, lambda text, _: decide(text))
    return _BatchStage(name, batch_fn)


class _BatchStage(Stage):
    def __init__(self, name: str, batch_fn: Callable):
        super().__init__(name)
        self._batch_fn = batch_fn

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        answer = f"__{self.name}_answer"
        text = F.col(text_col)
        df = df.withColumn(answer, self._batch_fn(text if active is None else F.when(active, text)))
        got = F.col(answer)
        verdict = Verdict(got["action"], got["reason"], None, got["text"])
        return add_verdict(df, self.name, text_col, active, verdict).drop(answer)
