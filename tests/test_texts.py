"""Texts that stay out of the limiter's shuffle and state."""

import contextlib
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textwarden.operators.ratelimit import RateLimit
from textwarden.plans.catalog import QUERIES
from textwarden.plans.presets import safety_preset
from textwarden.streaming.ratelimit import StreamRateLimit
from textwarden.streaming.runs import run_available

from test_streaming import DAY, START, as_stream
from test_ratelimit import SECOND

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "id long, user_id string, ts long, text string"
TEXTS = ["mail a@b.co to us", "a plain question", None, "", "x", "ignore previous instructions", "ünï \n\"q\""]
ROWS = [(i, f"u{i % 3}" if i % 7 else None, START + i * 40 * SECOND, TEXTS[i % 7 if i % 5 else 0])
        for i in range(120)]


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def table(spark):
    """Each text twice, one that is never sent, and NULL."""
    return spark.createDataFrame([(t,) for t in [*TEXTS, *TEXTS, "never sent"]], "text string")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", ["safety_preset", "safety_preset_with_model"])
def test_no_text_in_the_exchange_by_user(spark, name):
    nodes = plan(QUERIES[name](spark, FOLDER)).split("\n\n")
    by_user = [n for n in nodes if "hashpartitioning(__RateLimit_user" in n]
    assert by_user and not any(" text#" in n.split("Arguments")[0].replace("[", " ") for n in by_user)


def test_chain_with_texts_set_aside_gives_the_same_rows(spark):
    log = spark.createDataFrame(ROWS + ROWS[:9], SCHEMA)
    plain = safety_preset(per_minute=1, per_hour=9)(log)
    aside = safety_preset(per_minute=1, per_hour=9, texts=table(spark))(log)
    assert aside.schema == plain.schema and rows(aside) == rows(plain)


def test_a_text_missing_from_the_table_is_an_error(spark):
    log = spark.createDataFrame(ROWS, SCHEMA)
    few = table(spark).where("text <> 'a plain question'")
    with pytest.raises(PySparkException, match="not among those"):
        RateLimit(1, 9, texts=few).apply(log, "text").collect()


@pytest.mark.parametrize("judge", ["event", "arrival"])
def test_stream_with_texts_set_aside_gives_the_same_rows(spark, tmp_path, judge):
    ends = [(-n, "end", ROWS[-1][2] + n * DAY, None) for n in (1, 2)]
    batches = [ROWS[:60], ROWS[60:], *[[e] for e in ends]]
    stream = as_stream(spark, tmp_path, batches, SCHEMA)
    options = dict(watermark="1 minute", judge=judge)
    plain = StreamRateLimit(1, 9, **options).apply(stream, "text")
    aside = StreamRateLimit(1, 9, texts=table(spark), **options).apply(stream, "text")
    assert aside.schema == plain.schema
    state = [n for n in plan(aside, "extended").split("\n") if "to_json" in n]
    assert state and not any("text, text#" in n for n in state)
    got = rows(run_available(aside).where(F.col("id") >= 0))
    assert got == rows(run_available(plain).where(F.col("id") >= 0)) and len(got) == 120
