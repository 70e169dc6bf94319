"""Odd replies, absent texts and Python's regex notation."""

import re

import pytest
from pyspark.sql import functions as F

from textwarden.functions import fixed_values as fixed
from textwarden.functions.objects import extract_json, read_verdict
from textwarden.functions.regex import java_pattern
from textwarden.operators.compose import Chain, replace_messages_on_block, replace_on_block, routed, split
from textwarden.operators.judge import parse_verdict, verdict_threshold
from textwarden.operators.lexicon import Lexicon, keyword_lexicon
from textwarden.operators.validators import input_length, output_length
from textwarden.sources.content import last_turns


def test_replies_never_kill_the_job(spark):
    replies = [
        '{"is_safe": false, "reason": "bad \\ud83d"}', '{"\\ud83d": 1}',
        '{"is_safe": false, "confidence": 1' + "0" * 400 + "}",
        '{"is_safe": false, "confidence": NaN}', '{"is_safe": false, "confidence": Infinity}',
        '{"a":' * 5000 + "1" + "}" * 5000,
    ]
    df = spark.createDataFrame(list(enumerate(replies)), "id long, text string")
    fields = df.select("id", read_verdict(F.col("text")).alias("v"), extract_json(F.col("text")).alias("o"))
    rows = {r["id"]: r for r in fields.collect()}
    assert rows[0]["v"]["reason"] == "bad ?" and rows[1]["o"]["keys"] == ["?"]
    assert rows[2]["v"]["confidence_ok"] is False
    parsed = parse_verdict(F.col("text"))
    action = df.select("id", verdict_threshold(parsed, 0.7, F.col("text")).action.alias("a")).collect()
    assert {r["id"]: r["a"] for r in action}[3] == "warn"
    assert {r["id"]: r["a"] for r in action}[4] == "block"


def test_absent_text_is_empty(run_text):
    assert run_text(input_length(), [None, ""], )[0]["InputLength_result"] == "block"
    assert run_text(output_length(), [None])[0]["OutputLength_result"] == "block"


def test_truncating_to_nothing_is_refused():
    with pytest.raises(ValueError):
        input_length(0, 0, truncate=True)


@pytest.mark.parametrize("pattern", [
    "ignore.*rules", r"end\Z", r"end$", r"(?P<act_1>act) now (?P=act_1)", "a[[b]c", "[]a]x", "[^]a]x",
    r"[a&&b]z", r"x[\b]y", r"\bw\w+", r"[\d\s]q", r"a\.b", r"(?i)HeLLo", r"[a\]b]k",
])
def test_patterns_mean_what_they_mean_in_python(spark, pattern):
    texts = [
        "ignore\r the rules", "ignore\n the rules", "ignore the rules", "the end\n", "the end", "act now act",
        "act now", "a[c", "abc", "]x", "ax", "bx", "&z", "az", "bz", "cz", "x\by", "xby", "word", "5q", " q",
        "a.b", "axb", "hello", "]k", "bk", "the end\r", " q",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[1] for r in df.select("t", F.col("t").rlike(java_pattern(pattern))).collect()]
    assert got == [re.search(pattern, t) is not None for t in texts]


def test_two_apologies(spark):
    df = spark.createDataFrame(
        [(1, "t", "block", False), (2, "t", "allow", True), (3, "t", "allow", None)],
        "id long, text string, X_result string, failed boolean")
    out = replace_on_block(df, "X", error=F.col("failed")).orderBy("id").collect()
    assert [r["text"] for r in out] == [fixed.RETRY_APOLOGY, fixed.ERROR_APOLOGY, "t"]


def test_last_turn_is_one_row(spark):
    df = spark.createDataFrame(
        [(1, 2, "user", "b"), (1, 2, "assistant", "z"), (1, 1, "user", "q")],
        "conv_id long, turn long, role string, text string")
    row = last_turns(df).first()
    assert (row["role"], row["text"]) == ("user", "b") and row["turn"] == 2


def test_lexicon_of_ten_thousand_words(spark, run_text):
    words = [(f"c{i % 3}", f"Word{i}x") for i in range(10_000)] + [("c0", "kill"), ("c9", "kill"), (None, "the")]
    stage = keyword_lexicon(spark.createDataFrame(words, "category string, keyword string"))
    rows = run_text(stage, ["a skill", "xWORD77x word78x", "word77", None, ""])
    assert [r["ContentSafety_result"] for r in rows] == ["block", "block", "allow", "allow", "allow"]
    assert rows[0]["ContentSafety_metadata"]["violations"] == ["c0", "c9"]
    assert rows[1]["ContentSafety_metadata"]["violations"] == ["c0", "c2"]


def test_lexicon_of_three_million_words(spark):
    """Joins only: no Python in the plan, no word is collected."""
    words = spark.range(3_000_000).select(
        F.concat(F.lit("c"), F.col("id") % 4).alias("category"),
        F.concat(F.lit("q"), F.conv(F.col("id") * 7919 + 36 ** 5, 10, 36), F.lit("z")).alias("keyword"))
    long = "ä" * 70_000
    pick = {r["keyword"].lower(): r["category"] for r in words.where("id in (5, 70000, 2999999)").collect()}
    texts = [(0, "no word here"), (1, long + list(pick)[0] + long), (2, "x" * 65_533 + list(pick)[1]),
             (3, "--" + list(pick)[2].upper() + list(pick)[0]), (4, list(pick)[0][:-1]), (5, ""), (6, None)]
    df = spark.createDataFrame(texts, "id long, text string")
    out = keyword_lexicon(words)(df)
    assert "Python" not in out._jdf.queryExecution().toString()
    got = {r["id"]: r["ContentSafety_metadata"]["violations"] for r in out.collect()}
    cats = list(pick.values())
    assert got == {0: None, 1: [cats[0]], 2: [cats[1]], 3: sorted({cats[0], cats[2]}), 4: None, 5: None, 6: None}


def test_lexicon_of_short_words_in_a_chain(spark):
    words = spark.createDataFrame(
        [("a", "x"), ("b", "\U0001F600b"), ("c", "kill"), ("d", "killing time"), ("d", ""), (None, "z"), ("e", None)],
        "category string, keyword string")
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["axe", "\U0001F600B", "KILLING  time", "Killing Time!", "z", "ab", "ab"])],
        "id long, text string")
    chain = Chain([input_length(3), Lexicon(words)])
    got = {r["id"]: (r["ContentSafety_result"], (r["ContentSafety_metadata"] or {"violations": None})["violations"])
           for r in chain(df).collect()}
    assert got == {0: ("block", ["a"]), 1: (None, None), 2: ("block", ["c"]), 3: ("block", ["c", "d"]),
                   4: (None, None), 5: (None, None), 6: (None, None)}
    empty = Lexicon(words.where("false"))(df)
    assert {r["ContentSafety_result"] for r in empty.collect()} == {"allow"}


def test_routed_asks_once(spark):
    """A verdict that differs each time it is computed still puts every row in one half."""
    df = spark.range(2000).withColumn("X_result", F.when(F.rand() < 0.5, "block").otherwise("allow"))
    accepted, rejected = routed(df, ["X"])
    assert sorted(r["id"] for r in accepted.union(rejected).collect()) == list(range(2000))
    assert accepted.where("X_result = 'block'").count() == 0 == rejected.where("X_result <> 'block'").count()


def test_split_is_one_computation(spark):
    """Both halves read the same rows, also where a verdict differs each time."""
    df = spark.range(2000).withColumn("X_result", F.when(F.rand() < 0.5, "block").otherwise("allow"))
    accepted, rejected = split(df, ["X"])
    assert sorted(r["id"] for r in accepted.union(rejected).collect()) == list(range(2000))
    assert accepted.where("X_result = 'block'").count() == 0 == rejected.where("X_result <> 'block'").count()


def test_replaced_messages_keep_the_first(spark):
    kind = "array<struct<role: string, content: string>>"
    talk = [("user", "hi"), ("assistant", "x"), ("user", "and?"), ("assistant", "y")]
    df = spark.createDataFrame(
        [(0, talk, "allow"), (1, talk, "block"), (2, [], "block"), (3, None, "block"), (4, talk, None)],
        f"id long, messages {kind}, X_result string")
    out = replace_messages_on_block(df, "X", error=F.col("id") == 4).orderBy("id").collect()
    got = [[tuple(m) for m in r["messages"]] for r in out]
    sorry = ("assistant", fixed.RETRY_APOLOGY)
    assert got == [talk, [talk[0], sorry], [("user", ""), sorry], [("user", ""), sorry],
                   [talk[0], ("assistant", fixed.ERROR_APOLOGY)]]
