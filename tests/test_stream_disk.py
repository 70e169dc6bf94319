"""What a stream leaves on the disks."""

from pyspark.sql import functions as F

from textwarden.streaming.runs import run_available


def _shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffles_of_a_trigger_go_when_it_is_written(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    counted = stream.groupBy(F.pmod("id", F.lit(7)).alias("k")).agg(F.count("*").alias("n"))
    before = _shuffles(spark)
    totals = run_available(counted, "complete")
    kept = run_available(stream.repartition(3, "id").withColumn("twice", F.col("id") * 2))
    assert _shuffles(spark) <= before
    assert {r["k"]: r["n"] for r in totals.collect()} == {0: 5, 1: 5, **dict.fromkeys(range(2, 7), 4)}
    assert sorted((r["id"], r["twice"]) for r in kept.collect()) == [(i, 2 * i) for i in range(30)]


def test_a_stream_without_files_is_an_empty_table(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "none"))
    assert run_available(stream).collect() == []
