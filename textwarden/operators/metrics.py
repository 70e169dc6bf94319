"""Counts over verdicts, and accuracy against labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .stage import ALLOW, BLOCK, MODIFY, result_columns

COUNTS = ("total_checks", "blocked", "modified", "allowed")


def counts(result: Column) -> list[Column]:
    """Rows the stage reached; warn counts as allowed."""
    return [
        F.count(result).alias("total_checks"),
        F.count_if(result == BLOCK).alias("blocked"),
        F.count_if(result == MODIFY).alias("modified"),
        F.count_if(~result.isin(BLOCK, MODIFY)).alias("allowed"),
    ]


def with_rates(df: DataFrame) -> DataFrame:
    total = F.greatest(F.col("total_checks"), F.lit(1))
    return df.withColumns(
        {"block_rate": F.col("blocked") / total, "pass_rate": F.col("allowed") / total}
    )


def stage_metrics(df: DataFrame, name: str) -> DataFrame:
    """One row of counts and rates for one stage."""
    return with_rates(df.agg(*counts(F.col(result_columns(name)[0]))))


def _long(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per row and stage: stage name, position, result and reason."""
    verdicts = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("stage"),
                F.col(result_columns(name)[0]).alias("result"),
                F.col(result_columns(name)[1]).alias("reason"),
            )
            for position, name in enumerate(names)
        ]
    )
    return df.select(*keep, F.inline(verdicts))


def chain_metrics(df: DataFrame, names: Sequence[str], totals: bool = True) -> DataFrame:
    """Counts and rates per stage, and a row ``all`` with their sums.

    Rows a stage did not reach are no checks.  All counters are kept side by side in one
    aggregation over unexpanded rows; only its single result row is turned into rows.
    """
    wide = df.agg(
        *[
            count.alias(f"{position}_{label}")
            for position, name in enumerate(names)
            for label, count in zip(COUNTS, counts(F.col(result_columns(name)[0])))
        ]
    )
    rows = [
        F.struct(F.lit(name).alias("stage"),
                 *[F.col(f"{position}_{label}").alias(label) for label in COUNTS])
        for position, name in enumerate(names)
    ]
    if totals:
        sums = [
            sum((F.col(f"{position}_{label}") for position in range(len(names))), F.lit(0).cast("long"))
            for label in COUNTS
        ]
        rows.append(F.struct(F.lit("all").alias("stage"),
                             *[value.alias(label) for value, label in zip(sums, COUNTS)]))
    return with_rates(wide.select(F.inline(F.array(*rows))))


def trigger_log(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per verdict other than allow, with its reason."""
    return _long(df, names, keep).filter(F.col("result") != ALLOW)


def _correct(result: Column, expected: Column) -> Column:
    return (result == ALLOW) == expected.cast("boolean")


def evaluate(df: DataFrame, name: str, expected: Column) -> DataFrame:
    """Accuracy of a stage: a row is right when it is allowed exactly if expected."""
    correct = _correct(F.col(result_columns(name)[0]), expected)
    return df.agg(
        F.count(correct).alias("total"),
        F.count_if(correct).alias("correct"),
        F.count_if(~correct).alias("incorrect"),
        F.avg(correct.cast("int")).alias("accuracy"),
    )


def compare_methods(
    df: DataFrame, methods: Mapping[str, str], expected: Column
) -> DataFrame:
    """Accuracies of two stages on the same rows and their difference, in one pass.

    ``methods`` maps a label to a stage name; the difference is second minus first.
    """
    if len(methods) != 2:
        raise ValueError("compare exactly two methods")
    (first, _), (second, _) = methods.items()
    accuracies = {
        label: F.avg(_correct(F.col(result_columns(name)[0]), expected).cast("int"))
        for label, name in methods.items()
    }
    return df.agg(
        F.count("*").alias("total"),
        *[value.alias(f"{label}_accuracy") for label, value in accuracies.items()],
    ).withColumn("difference", F.col(f"{second}_accuracy") - F.col(f"{first}_accuracy"))


def threshold_curve(df: DataFrame, score: Column, expected: Column) -> DataFrame:
    """What each threshold would do: one row per distinct score, taken as the threshold.

    A row is allowed when its score reaches the threshold and is right when it is allowed
    exactly if expected.  ``allowed`` rows are ``hits`` (expected) or not; ``missed`` rows are
    expected but below.  Rows without an expectation are left out; rows without a score (NULL
    or NaN) are allowed by no threshold.

    Rows are counted per score before anything else, so a score many rows share is one row.
    The counts are dealt out by ranges of the score and written once; a range then needs only
    the sums of those above it, which are as few as there are ranges.
    """
    truth = expected.cast("boolean")
    value = score.cast("double")
    per_score = df.select(
        # -0.0 and 0.0 are one threshold.
        F.when(~F.isnan(value), value + F.lit(0.0)).alias("threshold"), truth.alias("expected"),
    ).where("expected is not null").groupBy("threshold").agg(
        F.count_if("expected").alias("yes"), F.count_if(~F.col("expected")).alias("no"))
    folder = scratch_folder(df.sparkSession)
    per_score.repartitionByRange("threshold").withColumn(
        "part", F.spark_partition_id()).write.parquet(folder)
    per_score = df.sparkSession.read.parquet(folder)
    scored = per_score.where("threshold is not null")
    sums = scored.groupBy("part").agg(
        F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as partitions: one task, and small enough to send to all.
    offsets = sums.select(
        "part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above")
                  for c in ("yes", "no")])
    totals = per_score.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_all") for c in ("yes", "no")])
    falling = Window.partitionBy("part").orderBy(F.desc("threshold")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    curve = scored.join(F.broadcast(offsets), "part").join(F.broadcast(totals)).select(
        "threshold", "yes_all", "no_all",
        *[(F.sum(c).over(falling) + F.col(f"{c}_above")).alias(c) for c in ("yes", "no")])
    right = F.col("yes") + F.col("no_all") - F.col("no")
    return curve.select(
        "threshold", (F.col("yes") + F.col("no")).alias("allowed"), F.col("yes").alias("hits"),
        (F.col("yes_all") - F.col("yes")).alias("missed"), right.alias("correct"),
        (F.col("yes_all") + F.col("no_all")).alias("total"),
        (right / (F.col("yes_all") + F.col("no_all"))).alias("accuracy"),
        (F.col("yes") / (F.col("yes") + F.col("no"))).alias("precision"),
        F.when(F.col("yes_all") > 0, F.col("yes") / F.col("yes_all")).alias("recall"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of a ``threshold_curve`` with most rows right; ties go to the highest
    threshold, which lets least through.  No row for an empty curve."""
    first = ["correct", "threshold"]
    columns = first + [c for c in curve.columns if c not in first]
    return curve.agg(F.max(F.struct(*columns)).alias("best")).where("best is not null").select(
        *[F.col("best")[c].alias(c) for c in curve.columns])
