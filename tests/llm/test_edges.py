"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from textwarden.llm import (
    language, lines, near, neighbours, pieces, pii, repeats, secret_scan, templates, toxicity,
)

LONG = "word " * 60_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None, None),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", None, None),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (None, "Der schnelle braune Fuchs springt über den faulen Hund am Fluss", "de", "b", 1),
    (5, LONG, "xx", "b", len(LONG)),
    (6, "x" * 300_000, None, "b", 1),
    (7, "12345 !!! ▁ \x00 \U0001F600", "de", "b", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "node", "band", "score", "label", "found", "h", "key", "z", "component", "kept"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("own") for c in CLASH})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language(docs, empty):
    model = language.fit(docs)
    out = by_id(language.identify(docs, model))
    assert out[4]["language"]["lang_pred"] == "und" and out[4]["language"]["rejected"]
    assert out[3]["language"]["score"] == 0.0
    assert out[7]["language"]["lang_pred"] == "und"
    assert out[1]["language"] == out[2]["language"]
    assert out[1]["found"] == "own"
    none = language.fit(empty)
    assert by_id(language.identify(docs, none))[1]["language"]["lang_pred"] == "und"
    assert language.identify(empty, model).count() == 0


def test_pii(docs, empty):
    out = by_id(pii.detect(docs, pii.train()))
    assert out[4]["pii"]["kind"] == [] and out[3]["pii"]["kind"] == []
    assert out[6]["found"] == "own"
    assert pii.detect(empty, pii.train()).count() == 0


def test_secrets(docs, empty):
    out = by_id(secret_scan.scan(docs))
    assert out[4]["secrets"]["kind"] == [] and out[5]["secrets"]["kind"] == []
    assert secret_scan.scan(empty).count() == 0


def test_pieces(docs, empty):
    out = by_id(pieces.encode(docs))
    assert out[4]["tokens"]["ids"] == [] and out[3]["tokens"]["ids"] == []
    assert all(r["tokens"]["parity"] for r in out.values())
    back = by_id(pieces.decode(pieces.encode(docs).select("doc_id", "text", "tokens.ids")))
    assert all(back[i]["decoded"] == back[i]["text"] for i in (1, 2, 3, 5, 6, None))
    assert back[4]["decoded"] == ""
    assert back[7]["decoded"] == back[7]["text"].replace("▁", " ")
    assert pieces.encode(empty).count() == 0


def test_near_duplicates(docs, empty):
    rows = near.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got[2] == (10, 1, False) and got[1] == (10, 1, True)
    assert got[3] == (0, 3, True) and got[4] == (0, 4, True)
    assert got[None][2] and got[5] == (1, 5, True) and got[6] == (1, 6, True)
    assert near.near_duplicates(empty).count() == 0


def test_lines(docs, empty):
    rows = lines.deduplicate(docs, dropped="n_dropped").collect()
    assert len(rows) == len(ROWS)
    out = {r["doc_id"]: r for r in rows}
    assert out[1]["text"] == ROWS[0][1] and out[2]["text"] == "" and out[2]["n_dropped"] == 1
    assert out[4]["text"] is None and out[3]["text"] == "" and out[None]["text"] == ROWS[5][1]
    assert out[5]["text"] == LONG and out[1]["h"] == "own"
    assert lines.deduplicate(empty).count() == 0


def test_repeats(docs, empty):
    rows = repeats.cut_repeats(docs).collect()
    assert len(rows) == len(ROWS)
    out = {r["doc_id"]: r for r in rows}
    assert out[1]["n_removed"] == 0 and out[2]["n_removed"] == len(ROWS[0][1])
    assert out[2]["n_spans"] == 1 and out[4]["n_bytes"] == 0 and out[3]["n_removed"] == 0
    assert out[None]["n_removed"] == 0 and out[5]["n_removed"] == 0
    assert repeats.cut_repeats(empty).count() == 0


def test_templates(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, ROWS[0][1]), (2, None), (3, ""), (None, "some other text of no document here")],
        "item_id long, text string").withColumn("id", F.lit(0))
    got = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 1)}
    kept = templates.decontaminate(docs, items)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "5", "6", "7", "None"]
    assert templates.contaminated(empty, items).count() == 0
    assert templates.contaminated(docs, items.where("false")).count() == 0


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame(
        [(1, 0, 0), (2, 1, 1), (3, None, None), (None, 1, 1), (5, 1, 7)],
        "doc_id long, quality int, toxic int").withColumn("text", F.lit("own"))
    model = toxicity.fit(docs, labels)
    out = by_id(toxicity.score(docs, model))
    assert all(0 <= r["toxicity"]["score"] <= 1 for r in out.values())
    assert out[1]["toxicity"] == out[2]["toxicity"]
    nothing = toxicity.fit(docs, labels.where("false"))
    assert by_id(toxicity.score(docs, nothing))[4]["toxicity"]["score"] == 0.0
    assert toxicity.score(empty, model).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]),
            (4, None), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0]), (10, []), (None, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn(
        "id", F.lit("own")).withColumn("list", F.lit(1))
    got = neighbours.search(df, F.col("id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (1, 1, 0.0), (2, 2, 0.0), (3, 3, 2 ** 0.5)]
    assert neighbours.search(df.where("false"), F.col("id") == 0).count() == 0
    alone = df.where("vec_id = 0")
    assert neighbours.search(alone, F.col("id") == 0).count() == 0
