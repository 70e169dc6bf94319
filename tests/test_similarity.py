import numpy as np
import pytest
from pyspark.sql import functions as F

from textwarden.operators.compose import Chain
from textwarden.operators.similarity import (
    SemanticAllowBlock,
    SemanticTopic,
    Topic,
    embed_column,
    embed_topics,
)
from textwarden.operators.stage import Verdict, custom_stage
from textwarden.plans.standins import letter_embedder

VECTORS = [[1.0, 0.0], [0.0, 1.0], [0.6, 0.8], [0.0, 0.0], None, [1.0, 2.0, 3.0], [None, 1.0]]
TOPICS = [Topic("east", [1.0, 0.0]), Topic("north", [0.0, 1.0]), Topic("east again", [1.0, 0.0])]


def judged(spark, stage, vectors=VECTORS):
    df = spark.createDataFrame(
        [(i, "", v) for i, v in enumerate(vectors)], "id long, text string, embedding array<double>"
    )
    return [r.asDict(recursive=True) for r in stage(df).orderBy("id").collect()]


def test_max(spark):
    rows = judged(spark, SemanticTopic(TOPICS, 0.8))
    assert [r["SemanticSimilarity_result"] for r in rows] == [
        "allow", "allow", "allow", "block", "warn", "warn", "warn"]
    meta = [r["SemanticSimilarity_metadata"] for r in rows]
    assert [m["matched_topic"] for m in meta[:4]] == ["east", "north", "north", None]
    assert meta[2]["all_similarities"] == pytest.approx([0.6, 0.8, 0.6], abs=1e-6)
    assert meta[3]["similarity_score"] == 0.0
    assert meta[5]["error"] == "embedding has 3 dimensions, topics have 2"
    assert rows[0]["SemanticSimilarity_reason"] == "Topic match (similarity: 1.000)"
    assert rows[3]["SemanticSimilarity_reason"] == "Off-topic (similarity: 0.000 < 0.8)"


def test_threshold_is_inclusive(spark):
    (row,) = judged(spark, SemanticTopic([Topic("t", [1.0, 0.0])], 1.0), [[2.0, 0.0]])
    assert row["SemanticSimilarity_result"] == "allow"


def test_mean_and_bad_settings(spark):
    rows = judged(spark, SemanticTopic(TOPICS, 0.6, aggregation="mean"), VECTORS[:3])
    assert [r["SemanticSimilarity_result"] for r in rows] == ["allow", "block", "allow"]
    assert rows[0]["SemanticSimilarity_metadata"]["matched_topic"] is None
    for stage in (SemanticTopic(TOPICS, 0.6, aggregation="median"), SemanticTopic([], 0.6)):
        (row,) = judged(spark, stage, VECTORS[:1])
        assert row["SemanticSimilarity_result"] == "warn"


@pytest.mark.parametrize("aggregation", ["max", "mean"])
def test_topics_in_several_groups(spark, aggregation):
    """Too many topics for one group: successive passes give the same answer."""
    rng = np.random.default_rng(5)
    topics = [Topic(f"t{i}", v.tolist()) for i, v in enumerate(rng.normal(size=(23, 4)))]
    vectors = [*rng.normal(size=(40, 4)).tolist(), None]
    one = judged(spark, SemanticTopic(topics, 0.5, aggregation), vectors)
    many = judged(spark, SemanticTopic(topics, 0.5, aggregation, group_bytes=160), vectors)
    for a, b in zip(one, many):
        assert a["SemanticSimilarity_result"] == b["SemanticSimilarity_result"]
        x, y = a["SemanticSimilarity_metadata"], b["SemanticSimilarity_metadata"]
        assert x["matched_topic"] == y["matched_topic"] and x["error"] == y["error"]
        if x["all_similarities"] is not None:
            assert x["all_similarities"] == pytest.approx(y["all_similarities"])


def test_topics_from_a_table(spark):
    table = spark.createDataFrame(
        [(1, "north", [0.0, 1.0]), (0, "east", [1.0, 0.0])],
        "topic_idx int, topic string, embedding array<double>",
    )
    rows = judged(spark, SemanticTopic(table, 0.8), VECTORS[:3])
    assert [r["SemanticSimilarity_metadata"]["matched_topic"] for r in rows] == ["east", "north", "north"]


def test_allow_block(spark):
    stage = SemanticAllowBlock([TOPICS[0]], [TOPICS[1]], 0.5, 0.8)
    rows = judged(spark, stage, VECTORS[:4])
    assert [r["MultiModalSemantic_result"] for r in rows] == ["allow", "block", "block", "block"]
    assert rows[2]["MultiModalSemantic_reason"] == "Content matches blocked topic (similarity: 0.800)"
    assert rows[3]["MultiModalSemantic_reason"].startswith("Off-topic")
    rows = judged(spark, SemanticAllowBlock([TOPICS[0]], None, 0.5), VECTORS[:2])
    assert [r["MultiModalSemantic_result"] for r in rows] == ["allow", "block"]


@pytest.mark.parametrize("share", ["table", "batch"])
def test_embed_column(spark, share):
    texts = ["a tea", "so", "a tea", None, "", "bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")

    def embed(batch):
        assert len(set(batch)) == len(batch)
        return [ValueError("no vector") if t == "bad" else v
                for t, v in zip(batch, letter_embedder(batch))]

    rows = embed_column(df, "text", embed, share=share).orderBy("id").collect()
    assert [r.embedding and r.embedding[0] for r in rows] == [2.0, 0.0, 2.0, None, 0.0, None]
    assert [r.embedding_error for r in rows] == [None] * 5 + ["no vector"]
    assert embed_topics([], embed) == []


def matrix_embedder():
    """An embedder that answers with one matrix and fails on some texts."""

    def embed(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("no embedder")
        return np.array([[t.count("a"), t.count("b")] for t in texts], dtype=np.float64)

    return embed


def test_text_embedded_when_the_check_runs(spark, run_text):
    stage = SemanticTopic(["a", "b"], 0.9, embed=matrix_embedder(), batch_size=1)
    rows = run_text(stage, ["aaa", "ab", "boom", None, "", "aaa"])
    assert [r["SemanticSimilarity_result"] for r in rows] == [
        "allow", "block", "warn", "warn", "block", "allow"]
    assert rows[2]["SemanticSimilarity_reason"] == "Semantic similarity check failed: no embedder"
    assert rows[0]["SemanticSimilarity_metadata"]["matched_topic"] == "a"
    assert not [c for c in rows[0] if c.startswith("__")]


def test_embedding_sees_the_text_the_stages_before_left(spark, run_text):
    cut = custom_stage("Cut", lambda text: Verdict(
        F.when(text.startswith("x"), "block").otherwise("modify"), F.lit("cut"), None,
        F.substring(text, 1, 1)))
    chain = Chain([cut, SemanticTopic(["a"], 0.9, embed=matrix_embedder())])
    rows = run_text(chain, ["abbbb", "xa", "baaaa"])
    assert [r["SemanticSimilarity_result"] for r in rows] == ["allow", None, "block"]


@pytest.mark.parametrize("share", ["batch", "table"])
def test_embedders_of_single_vectors_and_bad_ones(run_text, share):
    def embed(texts):
        return [ValueError("odd") if t == "odd" else "x" if t == "word" else [1.0, float(len(t))]
                for t in texts]

    stage = SemanticTopic([Topic("t", [1.0, 2.0])], 0.9, embed=embed, share=share)
    rows = run_text(stage, ["ok", "odd", "word", "ok"])
    assert [r["SemanticSimilarity_result"] for r in rows] == ["allow", "warn", "warn", "allow"]
    assert rows[1]["SemanticSimilarity_metadata"]["error"] == "odd"


def test_topics_that_cannot_be_embedded_warn(run_text):
    stages = SemanticTopic(["boom"], 0.9, embed=matrix_embedder()), SemanticAllowBlock(
        ["a"], ["boom"], 0.9, 0.9, embed=matrix_embedder())
    (first,), (second,) = (run_text(s, ["a"]) for s in stages)
    assert first["SemanticSimilarity_reason"] == "Semantic similarity check failed: no embedder"
    # Blocked topics that cannot be scored block nothing.
    assert second["MultiModalSemantic_result"] == "allow"
    with pytest.raises(ValueError):
        run_text(SemanticTopic(["a"], 0.9), ["a"])


def test_too_few_vectors_are_an_error_of_the_batch(run_text):
    stage = SemanticTopic([Topic("t", [1.0])], 0.9, embed=lambda texts: [[1.0]] * (len(texts) + 1))
    assert run_text(stage, ["a"])[0]["SemanticSimilarity_metadata"]["error"] == "2 answers for 1 texts"
