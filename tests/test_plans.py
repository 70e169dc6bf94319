"""Plans: shuffles, what is read, what is computed once."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from textwarden.operators.compose import Chain, route
from textwarden.operators.ratelimit import RateLimit
from textwarden.operators.similarity import SemanticTopic, Topic
from textwarden.operators import validators as va
from textwarden.plans.presets import safety_preset
from textwarden.session import scratch_folder

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Physical Plan ==")[1]


@pytest.fixture(scope="module")
def log(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs.withColumns({
        "id": F.col("doc_id"), "user_id": F.col("source"),
        "ts": F.timestamp_seconds(F.col("doc_id")),
    })


def test_preset_needs_one_shuffle(log):
    text = plan(safety_preset(hot_rows=None)(log))
    assert text.count("Exchange") == 1
    assert text.count("ArrowEvalPython") == 1
    assert "MapInPandas" not in text and "CartesianProduct" not in text


def test_text_stays_out_of_python(log):
    text = plan(safety_preset(hot_rows=None)(log))
    call = text.split("ArrowEvalPython ")[1].split("\n")[0]
    assert "text#" not in call


def test_column_stages_need_no_shuffle(log):
    chain = Chain([va.input_length(), va.pii_screen(), va.keyword_safety(), va.prompt_injection(),
                   va.code_safety(["os"]), va.keyword_topic(["a"])])
    text = plan(chain(log))
    assert "Exchange" not in text and "Python" not in text


def test_only_used_columns_are_read(log):
    out = va.pii_screen()(log).select("doc_id", "PIIDetection_result")
    text = plan(out)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "without_email" not in text, "redaction is not computed when unused"


def test_regexes_run_once(log):
    """A filter on the outcome repeats no regex, however many stages there are."""
    chain = Chain([va.pii_screen(), va.keyword_safety(), va.prompt_injection()])
    text = plan(route(chain(log), chain.names).where("route = 'continue'"))
    assert text.count("@[A-Za-z0-9.-]+") == plan(chain(log)).count("@[A-Za-z0-9.-]+")


def test_limiter_keeps_its_sort_under_an_aggregation(log):
    """Order matters to the limiter even where the result's order does not."""
    out = RateLimit(1, 2, hot_rows=None).apply(log, "text").groupBy("RateLimit_result").count()
    assert "Sort [" in plan(out)


def test_similarity_needs_no_shuffle(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").withColumn("text", F.lit(""))
    text = plan(SemanticTopic([Topic("t", [1.0] * 64)])(vectors))
    assert "Exchange" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_scratch_folders_are_new_and_shared(spark):
    one, two = scratch_folder(spark), scratch_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert one != two and one.startswith(base) and two.startswith(base)
