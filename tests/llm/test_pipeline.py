"""The pipeline's stages one after the other, and its registration."""

import corpus_pipeline
import __spark_entry__ as contract
from textwarden.llm import catalog, templates
from textwarden.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER))
        seen[name] = before.count(), docs.count()
        if name != "sentencepiece":
            assert docs.columns == COLUMNS
        if name == "line_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert seen["language_id"][1] >= 0.95 * seen["language_id"][0]
    assert seen["line_dedup"][0] == seen["line_dedup"][1]
    assert templates.contaminated(docs, items).count() == 0
    assert docs.where("not parity or n_tokens <> size(token_ids)").count() == 0
    again = corpus_pipeline.run(spark, FOLDER)
    assert again.columns == docs.columns and again.count() == docs.count()


def test_registered():
    assert {"pipeline", *catalog.QUERIES} <= set(contract.queries())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in catalog.QUERIES)] == []


def test_encoding_is_decoded_back(spark):
    docs = spark.createDataFrame([(1, "plain words", "en", "a", 11), (2, "a ▁ mark", "en", "a", 8)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = corpus_pipeline.encode(spark, docs, FOLDER).collect()
    assert {r["doc_id"]: r["round_trip"] for r in rows} == {1: True, 2: False}
