"""Putting stages together: chains, conditions, routing, rejection messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..session import scratch_folder
from .stage import ALLOW, BLOCK, Stage, Verdict, add_verdict, pinned, result_columns

BLOCKED_BY = "blocked_by"
CONTINUE, REJECT = "continue", "reject"

RowCondition = Column | Callable[[DataFrame], Column]


def _condition(df: DataFrame, condition: RowCondition) -> Column:
    column = condition if isinstance(condition, Column) else condition(df)
    return F.coalesce(column, F.lit(False))


def apply_check(df: DataFrame, stage: Stage, text_col: str = "text") -> DataFrame:
    """Run one stage: its three columns, and the text column rewritten on modify."""
    return stage.apply(df, text_col)


def verdict_flags(df: DataFrame, name: str) -> DataFrame:
    """``{name}_passed`` (allow only) and ``{name}_blocked`` (block only)."""
    result = F.col(result_columns(name)[0])
    return df.withColumns({f"{name}_passed": result == ALLOW, f"{name}_blocked": result == BLOCK})


class Chain:
    """Stages in order; each sees the text as the earlier ones left it.

    A row goes no further once a stage blocks it: later stages have NULL results there
    and do no work on it.  ``blocked_by`` names the blocking stage.
    """

    def __init__(self, stages: Sequence[Stage]):
        self.stages = list(stages)
        names = [n for stage in self.stages for n in stage.output_names()]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"stage names used more than once: {', '.join(twice)}")

    @property
    def names(self) -> list[str]:
        return [stage.name for stage in self.stages]

    def __call__(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        df = df.withColumn(BLOCKED_BY, F.lit(None).cast("string"))
        for position, stage in enumerate(self.stages):
            active = F.lit(True) if position == 0 else F.col(BLOCKED_BY).isNull()
            df = stage.apply(df, text_col, active)
            blocked = F.col(result_columns(stage.name)[0]) == BLOCK
            # Pinned, or a filter on the outcome would unfold all stages into itself.
            df = df.withColumn(
                BLOCKED_BY,
                pinned(F.coalesce(F.col(BLOCKED_BY), F.when(blocked, stage.name))),
            )
        return df


class Conditional(Stage):
    """Run a stage only where a condition holds; allow the other rows.

    The verdict appears under this stage's own name; the inner stage's columns are kept
    as well and are NULL where it did not run.
    """

    def __init__(self, condition: RowCondition, stage: Stage, name: str | None = None):
        super().__init__(name or f"Conditional_{stage.name}")
        self.condition, self.stage = condition, stage

    def output_names(self) -> list[str]:
        return [*self.stage.output_names(), self.name]

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        met_col = f"__{self.name}_met"
        on = F.lit(True) if active is None else active
        df = df.withColumn(met_col, _condition(df, self.condition))
        met = F.col(met_col)
        df = self.stage.apply(df, text_col, on & met)
        action, reason, metadata = (F.col(c) for c in result_columns(self.stage.name))
        verdict = Verdict(
            F.when(met, action).otherwise(ALLOW),
            F.when(met, reason).otherwise(fixed.CONDITION_NOT_MET),
            F.when(met, metadata),
        )
        return add_verdict(df, self.name, text_col, active, verdict).drop(met_col)


class Select(Stage):
    """One of several stages per row: the first whose condition holds, else the default."""

    def __init__(
        self, branches: Sequence[tuple[RowCondition, Stage]], default: Stage, name: str = "Select"
    ):
        super().__init__(name)
        self.branches, self.default = list(branches), default

    def _stages(self) -> list[Stage]:
        return [*(stage for _, stage in self.branches), self.default]

    def output_names(self) -> list[str]:
        return [*(n for stage in self._stages() for n in stage.output_names()), self.name]

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        choice = f"__{self.name}_choice"
        on = F.lit(True) if active is None else active
        chosen = F.lit(len(self.branches))
        for position, (condition, _) in reversed(list(enumerate(self.branches))):
            chosen = F.when(_condition(df, condition), position).otherwise(chosen)
        df = df.withColumn(choice, chosen)
        for position, stage in enumerate(self._stages()):
            df = stage.apply(df, text_col, on & (F.col(choice) == position))
        results = [[F.col(c) for c in result_columns(stage.name)] for stage in self._stages()]
        verdict = Verdict(
            F.coalesce(*[r[0] for r in results]),
            F.coalesce(*[r[1] for r in results]),
            F.coalesce(*[F.to_json(r[2]) if _is_struct(df, r[2]) else r[2] for r in results]),
        )
        return add_verdict(df, self.name, text_col, active, verdict).drop(choice)


def _is_struct(df: DataFrame, column: Column) -> bool:
    return df.select(column.alias("x")).schema["x"].dataType.typeName() == "struct"


class Cascade(Stage):
    """A cheap scoring stage decides; rows scored in a band go to a second stage.

    ``score`` reads the score from the first stage's metadata.  Where the second stage
    ran, its verdict stands, otherwise the first one's.
    """

    def __init__(
        self,
        first: Stage,
        second: Stage,
        score: Callable[[DataFrame], Column] | None = None,
        low: float = fixed.BORDERLINE_LOW,
        high: float = fixed.BORDERLINE_HIGH,
        name: str = "Cascade",
    ):
        super().__init__(name)
        self.first, self.second, self.low, self.high = first, second, low, high
        self.score = score or (
            lambda df: F.col(result_columns(first.name)[2])["similarity_score"]
        )

    def output_names(self) -> list[str]:
        return [*self.first.output_names(), *self.second.output_names(), self.name]

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        on = F.lit(True) if active is None else active
        asked = f"__{self.name}_asked"
        df = self.first.apply(df, text_col, active)
        df = df.withColumn(
            asked, on & F.coalesce(self.score(df).between(self.low, self.high), F.lit(False))
        )
        df = self.second.apply(df, text_col, F.col(asked))
        first, second = result_columns(self.first.name), result_columns(self.second.name)
        verdict = Verdict(
            F.when(F.col(asked), F.col(second[0])).otherwise(F.col(first[0])),
            F.when(F.col(asked), F.col(second[1])).otherwise(F.col(first[1])),
            F.struct(
                F.when(F.col(asked), self.second.name).otherwise(self.first.name).alias("decided_by")
            ),
        )
        return add_verdict(df, self.name, text_col, active, verdict).drop(asked)


# ---- routing -------------------------------------------------------------

def _blocked(names: Sequence[str]) -> Column:
    out = F.lit(False)
    for name in names:
        out = out | F.coalesce(F.col(result_columns(name)[0]) == BLOCK, F.lit(False))
    return out


def route(df: DataFrame, names: Sequence[str], column: str = "route") -> DataFrame:
    """``reject`` where any of the stages blocked, else ``continue``."""
    return df.withColumn(column, F.when(_blocked(names), REJECT).otherwise(CONTINUE))


def split(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows, of one computation (see ``routed``); on a stream, two
    streams of the same plan."""
    if df.isStreaming:
        return df.filter(~_blocked(names)), df.filter(_blocked(names))
    return routed(df, names)


def routed(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of one computation.

    The rows are written once to the shared scratch folder, in a part per route, and both
    halves are read back: a model is asked once, and no row can be in both or neither.
    """
    folder = scratch_folder(df.sparkSession)
    route(df, names, "__route").write.partitionBy("__route").parquet(folder)
    kept = df.sparkSession.read.schema(
        T.StructType([*df.schema.fields, T.StructField("__route", T.StringType())])).parquet(folder)
    halves = [kept.where(F.col("__route") == label).drop("__route") for label in (CONTINUE, REJECT)]
    return halves[0], halves[1]


def rejection(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rejected`` and, for rejected rows, an assistant message with the reason.

    The first blocking stage's reason counts.
    """
    said = F.coalesce(
        *[
            F.when(
                F.col(result_columns(n)[0]) == BLOCK,
                F.concat(
                    F.lit(fixed.REJECTION_PREFIX),
                    F.coalesce(
                        F.col(result_columns(n)[1]), F.lit(fixed.REJECTION_DEFAULT_REASON)
                    ),
                ),
            )
            for n in names
        ],
        F.lit(fixed.REJECTION_WITHOUT_STAGE),
    )
    blocked = _blocked(names)
    return df.withColumns(
        {
            "rejected": blocked,
            "rejection_message": F.when(
                blocked, F.struct(F.lit("assistant").alias("role"), said.alias("content"))
            ),
        }
    )


def replace_on_block(
    df: DataFrame,
    name: str,
    text_col: str = "text",
    apology: str = fixed.RETRY_APOLOGY,
    error: Column | None = None,
    error_apology: str = fixed.ERROR_APOLOGY,
) -> DataFrame:
    """Answer with one fixed apology where processing failed, another where the stage blocked."""
    failed = F.lit(False) if error is None else F.coalesce(error, F.lit(False))
    return df.withColumn(
        text_col,
        F.when(failed, F.lit(error_apology)).when(_blocked([name]), F.lit(apology))
        .otherwise(F.col(text_col)),
    )


def replace_messages_on_block(
    df: DataFrame,
    name: str,
    messages_col: str = "messages",
    apology: str = fixed.RETRY_APOLOGY,
    error: Column | None = None,
    error_apology: str = fixed.ERROR_APOLOGY,
) -> DataFrame:
    """As ``replace_on_block``, on an array of messages (role, content): where the answer is
    replaced, the first message stays and the apology follows; all others go.

    Without a first message (null or empty array) an empty one of the user stands there.
    """
    failed = F.lit(False) if error is None else F.coalesce(error, F.lit(False))
    message = lambda role, content: F.struct(
        F.lit(role).alias("role"), F.lit(content).alias("content"))
    first = F.coalesce(F.get(F.col(messages_col), F.lit(0)), message("user", ""))
    return df.withColumn(
        messages_col,
        F.when(failed, F.array(first, message("assistant", error_apology)))
        .when(_blocked([name]), F.array(first, message("assistant", apology)))
        .otherwise(F.col(messages_col)),
    )


def multi_outcome_route(
    df: DataFrame, labels: Sequence[tuple[str, str]], column: str = "route"
) -> DataFrame:
    """The label of the first listed stage that blocked, else ``continue``.

    ``labels`` pairs stage names with route labels.
    """
    outcome = F.coalesce(*[F.when(_blocked([name]), label) for name, label in labels],
                         F.lit(CONTINUE))
    return df.withColumn(column, outcome)
