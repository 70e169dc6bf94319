import json

import pytest
from pyspark.sql import functions as F

from textwarden.functions import text as tx
from textwarden.functions.objects import extract_json
from textwarden.functions.regex import java_pattern, literal_start
from textwarden.functions.vectors import cosine_sim


def evaluate(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return [r.x for r in df.select("id", column.alias("x")).orderBy("id").collect()]


PII_CASES = [
    ("a@b.co and c.d+e@f-g.org", "email", ["a@b.co", "c.d+e@f-g.org"]),
    ("x@y.c|m", "email", ["x@y.c|m"]),
    ("call +1-555-123-4567 or 5551234567", "phone", ["555-123-4567", "555-123-4567"]),
    ("(555)123.4567", "phone", ["555-123-4567"]),
    ("(555) 123-4567, 555 123 4567", "phone", []),
    ("123-45-6789", "ssn", ["123-45-6789"]),
    ("٣٣٣-٤٤-٥٥٥٥", "ssn", ["٣٣٣-٤٤-٥٥٥٥"]),
    ("é123-45-6789", "ssn", []),
    ("4111 1111-1111 1111", "credit_card", ["4111 1111-1111 1111"]),
    ("192.168.1.1 and 1.2.3", "ip_address", ["192.168.1.1"]),
    ("", "email", []),
]


@pytest.mark.parametrize("text,kind,expected", PII_CASES)
def test_pii_detect(spark, text, kind, expected):
    assert evaluate(spark, [text], tx.pii_detect(F.col("text"))[kind]) == [expected]


def test_pii_hints_lose_nothing(spark):
    """Every type is found with and without the cheap tests in front."""
    texts = [text for text, _, _ in PII_CASES] + ["1.1.1.1", "0000", "a.1.22.3", "12.34.56.78"]
    for kind in tx.PII_TYPES:
        plain = evaluate(spark, texts, F.regexp_extract_all(
            "text", F.lit(java_pattern(dict((n, p) for n, p, _ in tx.fixed.PII_PATTERNS)[kind])),
            F.lit(0)))
        found = evaluate(spark, texts, tx.pii_matches(F.col("text"), kind))
        assert [len(x) for x in plain] == [len(x) for x in found], kind


def test_tokens(spark):
    texts = ["", "   ", "one", "a b c d", " a\tb\nc\x1cd e ", "x " * 9]
    expected = [int(len(t.split()) * 0.75) for t in texts]
    assert evaluate(spark, texts, tx.approx_tokens(F.col("text"))) == expected


def test_truncate(spark):
    texts = ["short", "exactly10!", "eleven chars", "ünïcödé text"]
    expected = [t if len(t) <= 10 else t[:7] + "..." for t in texts]
    assert evaluate(spark, texts, tx.truncate_text(F.col("text"), 10)) == expected
    with pytest.raises(ValueError):
        tx.truncate_text(F.col("text"), 2)


def test_extract_json(spark):
    texts = [
        '{"a": 1}', 'Sure: {"a": {"b": 1}} done', "{}", "}{", '{"a":1,}', "", "no braces",
        '{"a":1} and {"b":2}', "{'a': 1}", '{"a": 1, "a": 2}', None,
    ]

    def expected(text):
        if text is None or "{" not in text or "}" not in text:
            return None
        try:
            return json.loads(text[text.find("{"):text.rfind("}") + 1])
        except ValueError:
            return None

    got = evaluate(spark, texts, extract_json(F.col("text"))["json"])
    assert [None if g is None else json.loads(g) for g in got] == [expected(t) for t in texts]


def test_strip_html(spark):
    texts = ["<p class='x'>a &amp; b</p>", "<>", "&#39; &nbsp;x", "a < b > c"]
    assert evaluate(spark, texts, tx.strip_html(F.col("text"))) == ["a  b", "<>", "&#39; x", "a  c"]


def test_render_prompt(spark):
    text = F.col("text")
    filled = tx.render_prompt("{{x}} {content}!", {"content": text})
    assert evaluate(spark, ["hi", None], filled) == ["{x} hi!", None]
    assert evaluate(spark, ["hi"], tx.render_prompt("{content} {other}", {"content": text})) == [None]


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([0.6, 0.8], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = [r.x for r in df.select(cosine_sim(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == pytest.approx([1.0, 0.6, 0.0], abs=1e-6)


@pytest.mark.parametrize(
    "pattern,start",
    [("act as", "act as"), ("new instructions?:", "new instruction"), ("ab*c", "a"),
     ("abc|d", ""), ("forget (all|it)", "forget "), (r"eval\s*\(", "eval"), ("[ab]c", ""),
     ("(a|b)c", ""), ("a+b", "a")],
)
def test_literal_start(pattern, start):
    assert literal_start(pattern) == start
