"""Triggers and counts of a screened stream, each row counted exactly once.

Every micro-batch is written once as plain verdicts, under a name that holds the batch's
number; its triggers (verdicts other than allow) and its counts per window and stage are made
from what was written, each as a partition of that number.  A batch that runs again after a
failure replaces its own partitions, so nothing is there twice and nothing is lost, and a
model that answers differently the second time cannot split a batch in two.

Counts add up over batches, so they need no state and no watermark: a late row is counted in
its own window like any other.  The folder also holds the stream's progress, because batch
numbers mean something only together with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics as mt
from ..operators.stage import result_columns

_PART = "batch"


def trigger_sink(
    screened: DataFrame,
    names: Sequence[str],
    folder: str,
    *,
    keep: Sequence[str] = (),
    time_col: str | None = None,
    window: str = "1 hour",
    **trigger,
) -> StreamingQuery:
    """Start writing a screened stream's triggers and counts below a shared ``folder``.

    ``keep`` are columns that identify a row in the log.  With ``time_col``, counts are kept
    per ``window`` of it; rows without a time have a window of their own, NULL.  ``trigger``
    goes to the stream writer, ``availableNow=True`` for what is there now.  Calling it again
    with the same folder goes on where the stream stopped.
    """
    verdicts = [c for n in names for c in result_columns(n)[:2]]
    twice = set(keep) & {"stage", "result", "reason", "position", _PART}
    if twice:
        raise ValueError(f"columns of the log itself cannot be kept: {', '.join(sorted(twice))}")
    start = (F.lit(None).cast("timestamp") if time_col is None
             else F.window(F.col(time_col), window)["start"])

    def write(batch: DataFrame, number: int) -> None:
        def replace(rows: DataFrame, kind: str) -> None:
            rows.write.mode("overwrite").parquet(f"{folder}/{kind}/{_PART}={number}")

        spark, pending = batch.sparkSession, f"{folder}/pending"
        # F.window drops rows without a time, so it only sees the others.
        slim = batch.select(*keep, *verdicts, *([time_col] if time_col else []))
        parts = [slim.withColumn("__window", start)] if time_col is None else [
            slim.where(F.col(time_col).isNotNull()).withColumn("__window", start),
            slim.where(F.col(time_col).isNull()).withColumn(
                "__window", F.lit(None).cast("timestamp"))]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rows.write.mode("overwrite").parquet(pending)
        rows = spark.read.schema(rows.schema).parquet(pending)
        replace(mt.trigger_log(rows, names, keep), "triggers")
        replace(_window_counts(rows, names), "counts")

    # So that the tables are there, if empty, before the first batch.
    write(screened.sparkSession.createDataFrame([], screened.schema), -1)
    return (
        screened.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress").trigger(**trigger).start()
    )


def _window_counts(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts per window and stage, kept side by side in one aggregation of partial sums."""
    wide = rows.groupBy("__window").agg(*[
        count.alias(f"{position}_{label}")
        for position, name in enumerate(names)
        for label, count in zip(mt.COUNTS, mt.counts(F.col(result_columns(name)[0])))])
    stages = F.array(*[
        F.struct(F.lit(name).alias("stage"),
                 *[F.col(f"{position}_{label}").alias(label) for label in mt.COUNTS])
        for position, name in enumerate(names)])
    return wide.select(F.col("__window").alias("window"), F.inline(stages)).where(
        "total_checks > 0")


def read_triggers(spark: SparkSession, folder: str) -> DataFrame:
    """The log so far, in the columns of ``trigger_log`` and the batch that wrote each row."""
    return spark.read.option("basePath", f"{folder}/triggers").parquet(f"{folder}/triggers")


def read_counts(spark: SparkSession, folder: str, by: Sequence[str] = ("stage",)) -> DataFrame:
    """Counts and rates so far per stage, or per ``window`` and ``stage``."""
    parts = spark.read.option("basePath", f"{folder}/counts").parquet(f"{folder}/counts")
    sums: list[Column] = [F.sum(label).alias(label) for label in mt.COUNTS]
    return mt.with_rates(parts.groupBy(*by).agg(*sums))
