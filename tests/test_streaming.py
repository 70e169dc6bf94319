import datetime
import random

import pytest
from pyspark.sql import functions as F

from textwarden.operators.compose import Chain
from textwarden.operators import metrics as mt
from textwarden.operators import validators as va
from textwarden.operators.judge import Judge
from textwarden.plans.standins import word_scorer
from textwarden.streaming.ratelimit import (
    StreamRateLimit, late_rows, on_time_rows, rate_limit_stream,
)
from textwarden.streaming.runs import run_available

from test_ratelimit import DENSE, MIXED, SECOND, by_hand, requests


def as_stream(spark, tmp_path, batches, schema):
    """A stream of one micro-batch per list of rows."""
    folder = str(tmp_path / "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("spacing", [DENSE, MIXED], ids=["dense", "mixed"])
def test_stream_equals_batch(spark, tmp_path, spacing):
    # Well after 1970, where a stream's watermark starts.
    rows = [(i, u, t + 1_700_000_000 * SECOND, a)
            for i, u, t, a in requests(4, 600, ["a", "b", None], spacing)]
    rows.sort(key=lambda r: r[2])
    end = rows[-1][2]
    batches = []
    for at in range(0, 600, 150):
        part = rows[at:at + 150]
        random.Random(at).shuffle(part)
        batches.append([(i, u, t) for i, u, t, _ in part])
    batches.append([(-1, "end", end + 86_400 * SECOND)])
    stream = as_stream(spark, tmp_path, batches, "id long, user_id string, ts long")
    out = run_available(rate_limit_stream(stream, 2, 9, watermark="1 minute")).collect()
    got = {r.id: (r.RateLimit_result, r.RateLimit_reason, r.RateLimit_metadata.requests_count,
                  r.RateLimit_metadata.requests_last_minute) for r in out}
    assert got == by_hand(rows, 2, 9)


def test_stateless_chain_on_a_stream(spark, tmp_path):
    texts = ["mail a@b.co", "kill", "x", "the tea"]
    batches = [[(i, t)] for i, t in enumerate(texts)]
    stream = as_stream(spark, tmp_path, batches, "id long, text string")
    chain = Chain([va.input_length(2), va.pii_screen(), va.keyword_safety(),
                   Judge(word_scorer, share="batch")])
    rows = {r.id: r for r in run_available(chain(stream)).collect()}
    assert [rows[i].blocked_by for i in range(4)] == [None, "ContentSafety", "InputLength", None]
    assert rows[0].text == "mail [EMAIL_REDACTED]" and rows[3].ModelJudge_reason == "Looks okay to me"


def test_metrics_on_a_stream(spark, tmp_path):
    stream = as_stream(spark, tmp_path, [[(0, "kill")], [(1, "fine")], [(2, "ok")]],
                       "id long, text string")
    chain = Chain([va.keyword_safety()])
    totals = run_available(mt.chain_metrics(chain(stream), chain.names), "complete")
    rows = {r.stage: (r.total_checks, r.blocked, r.allowed) for r in totals.collect()}
    assert rows == {"ContentSafety": (3, 1, 2), "all": (3, 1, 2)}


# ---- the limiter as a stage --------------------------------------------------------

START, DAY = 1_700_000_000 * SECOND, 86_400 * SECOND
SCHEMA = "id long, user_id string, ts long, active boolean, at timestamp, of struct<a: double, b: array<string>>"


def told(row):
    m = row.RateLimit_metadata
    return (row.RateLimit_result, row.RateLimit_reason, m and m.requests_count, m and m.requests_last_minute)


def wide(rows):
    return [(i, u, t, a, datetime.datetime(2024, 1, 1, 1, 2, 3, abs(i)), (i / 7, [str(u), None])) for i, u, t, a in rows]


def ends(rows):
    """Two later rows in triggers of their own, for the watermark."""
    last = max(r[2] for r in rows)
    return [wide([(-n, "end", last + n * DAY, True)]) for n in (1, 2)]


@pytest.mark.parametrize("spacing", [DENSE, MIXED], ids=["dense", "mixed"])
def test_stage_on_a_stream_equals_batch_and_keeps_columns(spark, tmp_path, spacing):
    rows = sorted(((i, u, t + START, a) for i, u, t, a in requests(5, 400, ["a", "b", None], spacing, 0.1)),
                  key=lambda r: r[2])
    batches = []
    for at in range(0, 400, 100):
        part = wide(rows[at:at + 100])
        random.Random(at).shuffle(part)
        batches.append(part)
    stream = as_stream(spark, tmp_path, batches + ends(rows), SCHEMA)
    out = run_available(StreamRateLimit(2, 9, watermark="1 minute").apply(stream, "", F.col("active")))
    assert out.columns[:6] == stream.columns
    assert late_rows(out).count() == 0
    got = {r.id: r for r in out.collect() if r.id >= 0}
    assert {i: told(r) for i, r in got.items()} == by_hand(rows, 2, 9)
    assert all(tuple(got[w[0]])[:5] == w[:5] and tuple(got[w[0]].of) == w[5] for w in wide(rows))


def test_late_rows_are_told_apart_and_use_no_quota(spark, tmp_path):
    times = [[0, 10], [4000], [4005, 20, 3900], [4010]]
    rows, batches = [], []
    for part in times:
        batches.append([(len(rows) + i, "u", START + t * SECOND, True) for i, t in enumerate(part)])
        rows += batches[-1]
    stream = as_stream(spark, tmp_path, [wide(b) for b in batches] + ends(rows), SCHEMA)
    out = run_available(StreamRateLimit(2, None, watermark="1 minute").apply(stream, ""))
    late = late_rows(out).collect()
    # The watermark is a minute behind 4000 when the third trigger comes.
    assert sorted(r.ts - START for r in late) == [20 * SECOND, 3900 * SECOND]
    assert {(r.RateLimit_result, r.RateLimit_reason) for r in late} == {
        ("block", "Request came after its time had been judged")}
    on_time = {r.id: told(r) for r in on_time_rows(out).collect() if r.id >= 0}
    assert on_time == by_hand([r for r in rows if r[0] not in {x.id for x in late}], 2, None)


def test_verdicts_on_arrival(spark, tmp_path):
    """Triggers in order, event time within them; a user's clock never runs back."""
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), START + (20 * i + rng.choice([0, 0, -500, 30])) * SECOND, True)
            for i in range(300)]
    batches = [rows[at:at + 60] for at in range(0, 300, 60)]
    clock, moved = {}, []
    for part in batches:
        for i, u, t, a in sorted(part, key=lambda r: (r[2], r[0])):
            clock[u] = max(clock.get(u, 0), t)
            moved.append((i, u, clock[u], len(moved)))
    stream = as_stream(spark, tmp_path, [wide(b) for b in batches], SCHEMA)
    stage = StreamRateLimit(2, 9, watermark="2 hours", judge="arrival")
    got = {r.id: told(r) for r in run_available(stage.apply(stream, "")).collect()}
    expected = by_hand([(order, u, t, True) for _, u, t, order in moved], 2, 9)
    assert got == {i: expected[order] for i, _, _, order in moved}


def test_stopped_and_started_again(spark, tmp_path):
    rows = sorted(((i, u, t + START, True) for i, u, t, _ in requests(6, 200, ["a", "b"], DENSE)),
                  key=lambda r: r[2])
    folder, schema = str(tmp_path / "in"), SCHEMA

    def add(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        (StreamRateLimit(2, 9, watermark="1 minute").apply(stream, "").writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
         .trigger(availableNow=True).start().awaitTermination())

    add(wide(rows[:90]))
    go()
    for part in (wide(rows[90:]), *ends(rows)):
        add(part)
        go()
    out = spark.read.parquet(str(tmp_path / "out")).where("id >= 0").collect()
    assert len(out) == 200 and {r.id: told(r) for r in out} == by_hand(rows, 2, 9)


def test_what_cannot_wait_is_refused(spark, tmp_path):
    stream = as_stream(spark, tmp_path, [[(1, "u", 1, {1: 2})]], "id long, user_id string, ts long, m map<int, int>")
    with pytest.raises(TypeError):
        StreamRateLimit(1).apply(stream, "")
    with pytest.raises(ValueError):
        StreamRateLimit(1, judge="sometime")
