"""The trigger sink over streams that stop, fail and go on."""

import datetime

import pytest
from pyspark.sql import functions as F

from textwarden.operators import metrics as mt
from textwarden.operators import validators as va
from textwarden.operators.compose import Chain
from textwarden.streaming.triggers import read_counts, read_triggers, trigger_sink

SCHEMA = "id long, at timestamp, text string"
CHAIN = Chain([va.input_length(2), va.pii_screen(), va.keyword_safety()])
TEXTS = ["mail a@b.co", "kill", "x", "the tea", None, "", "call me", "kill a@b.co"]


def rows(first, n):
    start = datetime.datetime(2024, 5, 1)
    return [(i, None if i % 7 == 0 else start + datetime.timedelta(minutes=25 * (i % 11)),
             TEXTS[i % len(TEXTS)]) for i in range(first, first + n)]


def add(spark, tmp_path, some):
    spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def run(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    trigger_sink(CHAIN(stream), CHAIN.names, str(tmp_path / "log"), keep=["id"], time_col="at",
                 availableNow=True).awaitTermination()


def compare(spark, tmp_path, some):
    batch = CHAIN(spark.createDataFrame(some, SCHEMA))
    log = sorted(map(tuple, mt.trigger_log(batch, CHAIN.names, ["id"]).select(
        "id", "stage", "result", "reason").collect()))
    folder = str(tmp_path / "log")
    got = read_triggers(spark, folder).select("id", "stage", "result", "reason")
    assert sorted(map(tuple, got.collect())) == log and log
    whole = {r["stage"]: r for r in mt.chain_metrics(batch, CHAIN.names, totals=False).collect()}
    counted = {r["stage"]: r for r in read_counts(spark, folder).select(
        next(iter(whole.values())).__fields__).collect()}
    assert counted == whole
    hours = read_counts(spark, folder, ["window", "stage"]).where("stage = 'InputLength'")
    by_hour = batch.groupBy(F.date_trunc("hour", "at").alias("window")).agg(
        F.count("InputLength_result").alias("n"))
    assert {r["window"]: r["total_checks"] for r in hours.collect()} == {
        r["window"]: r["n"] for r in by_hour.collect()}


def test_stopped_failed_and_resumed(spark, tmp_path):
    some = rows(0, 40)
    add(spark, tmp_path, some[:10])
    add(spark, tmp_path, some[10:20])
    run(spark, tmp_path)
    compare(spark, tmp_path, some[:20])
    # As after a failure between the writing of a batch and its being noted as done.
    commits = tmp_path / "log" / "progress" / "commits"
    (commits / "1").unlink()
    for crc in commits.glob(".1.crc"):
        crc.unlink()
    add(spark, tmp_path, some[20:40])
    run(spark, tmp_path)
    compare(spark, tmp_path, some)
    run(spark, tmp_path)
    compare(spark, tmp_path, some)


def test_a_stage_that_fails_writes_nothing_twice(spark, tmp_path):
    flag = tmp_path / "broken"
    flag.touch()
    some, at = rows(0, 20), str(flag)

    @F.udf("string")
    def fragile(text):
        import os

        if os.path.exists(at):
            raise RuntimeError("no model")
        return text

    add(spark, tmp_path, some)
    folder = str(tmp_path / "log")

    def go():
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        trigger_sink(CHAIN(stream.withColumn("text", fragile("text"))), CHAIN.names, folder,
                     keep=["id"], time_col="at", availableNow=True).awaitTermination()

    with pytest.raises(Exception, match="no model"):
        go()
    assert read_triggers(spark, folder).count() == 0
    flag.unlink()
    go()
    compare(spark, tmp_path, some)


def test_empty_stream_and_clashing_names(spark, tmp_path):
    add(spark, tmp_path, [])
    run(spark, tmp_path)
    assert read_triggers(spark, str(tmp_path / "log")).count() == 0
    assert read_counts(spark, str(tmp_path / "log")).count() == 0
    stream = spark.readStream.schema(SCHEMA + ", stage string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="stage"):
        trigger_sink(CHAIN(stream), CHAIN.names, str(tmp_path / "other"), keep=["stage"])
