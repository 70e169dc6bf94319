"""Running screening on streams to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # The file source takes folders and patterns, so the file's name is given as one.
    return spark.readStream.schema(schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def run_available(stream: DataFrame, output_mode: str = "append") -> DataFrame:
    """Process all available input into a table in the shared scratch folder; read it.

    What a trigger has shuffled is removed when its rows are written.  Spark keeps the plans of
    a stream, and with them the shuffles of all its triggers, until the stream has ended.
    """
    spark = stream.sparkSession
    folder = scratch_folder(spark)
    parts = []

    def write(batch: DataFrame, number: int) -> None:
        # A trigger that is run again replaces its rows, and the whole table replaces the last.
        path = f"{folder}/out/{number if output_mode == 'append' else 0}"
        batch.write.mode("overwrite").parquet(path)
        if path not in parts:
            parts.append(path)
        _remove_shuffles(batch)

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(*parts) if parts else spark.createDataFrame(
        [], stream.schema)


def _remove_shuffles(batch: DataFrame) -> None:
    """Remove the shuffles that the rows of a trigger came from."""
    cleaner = batch.sparkSession.sparkContext._jsc.sc().cleaner()
    if not cleaner.isDefined():
        return
    seen, left, found = set(), [batch._jdf.queryExecution().toRdd()], set()
    while left:
        rdd = left.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        needs = rdd.dependencies()
        for i in range(needs.size()):
            need = needs.apply(i)
            if need.getClass().getSimpleName() == "ShuffleDependency":
                found.add(need.shuffleId())
            left.append(need.rdd())
    for shuffle in found:
        cleaner.get().doCleanupShuffle(shuffle, False)
