import pytest
from pyspark.sql import functions as F

from textwarden.operators import judge as jd
from textwarden.operators.replies import ReplyStore
from textwarden.operators.stage import Verdict
from textwarden.plans.standins import failing_scorer, word_scorer

REPLIES = [
    ('Sure: {"is_safe": false, "reason": "r", "confidence": 0.9} done', "block", "r", 0.9),
    ('{"is_safe": false, "reason": "r", "confidence": 0.7}', "block", "r", 0.7),
    ('{"is_safe": false, "reason": "r", "confidence": 0.4}', "warn", "Low confidence concern: r", 0.4),
    ('{"is_safe": true}', "allow", "No reason provided", 1.0),
    ('{"a":1} and {"b":2}', "allow", '{"a":1} and {"b":2}', 0.5),
    ("IS_SAFE: FALSE", "warn", "Low confidence concern: IS_SAFE: FALSE", 0.5),
    ("this is unsafe", "warn", "Low confidence concern: this is unsafe", 0.5),
    ("looks appropriate", "allow", "looks appropriate", 0.5),
    ("inappropriate", "warn", "Low confidence concern: inappropriate", 0.5),
    ('{"is_safe": "false"}', "allow", "No reason provided", 1.0),
    ('{"is_safe": 0, "confidence": "high"}', "warn", None, None),
    ('{"is_safe": 1, "confidence": "high"}', "allow", "No reason provided", None),
    ('{"is_safe": true, "metadata": "x"}', "warn", None, None),
    ("no idea " * 40, "allow", ("no idea " * 40)[:200], 0.5),
    (None, "warn", "LLM validation failed: no reply", None),
]


def test_verdict_table(spark):
    df = spark.createDataFrame([(i, "", r[0]) for i, r in enumerate(REPLIES)],
                               "id long, text string, reply string")
    rows = jd.verdict_stage("reply")(df).orderBy("id").collect()
    for row, (reply, action, reason, confidence) in zip(rows, REPLIES):
        assert row.Verdict_result == action, reply
        if reason is not None:
            assert row.Verdict_reason == reason
        if confidence is not None:
            assert row.Verdict_metadata.confidence == confidence


@pytest.mark.parametrize("share", ["table", "batch"])
def test_judge(run_text, share):
    texts = ["I hate it", "no harm", "the end", "zzz", "I hate it", None]
    rows = run_text(jd.Judge(word_scorer, share=share), texts)
    assert [r["ModelJudge_result"] for r in rows] == ["block", "warn", "allow", "allow", "block", "warn"]
    assert rows[5]["ModelJudge_reason"] == "LLM validation failed: 'content'"
    assert rows[0]["ModelJudge_metadata"]["confidence"] == 0.9


def test_each_distinct_prompt_is_sent_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def scorer(system_prompt, prompts):
        with open(log, "a") as out:
            out.writelines("call\n" for _ in prompts)
        return ["okay"] * len(prompts)

    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i % 9}") for i in range(300)],
                               "id long, text string").repartition(7)
    out = jd.Judge(scorer, store_replies=True)(df)
    assert out.count() == 300 and out.filter("ModelJudge_result = 'allow'").count() == 300
    assert len(open(log).readlines()) == 4


def test_a_lasting_store_asks_what_it_has_not_seen(spark, tmp_path):
    log, path = str(tmp_path / "calls"), str(tmp_path / "store")

    def scorer(system_prompt, prompts):
        with open(log, "a") as out:
            out.writelines("call\n" for _ in prompts)
        return [RuntimeError("busy") if "bad" in p else "okay" for p in prompts]

    def run(texts, **options):
        df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        replies = ReplyStore(path, options.pop("model", "m"), **options)
        rows = jd.Judge(scorer, replies=replies)(df).orderBy("id").collect()
        before, run.calls = run.calls, len(open(log).readlines())
        return [r["ModelJudge_result"] for r in rows], run.calls - before

    run.calls = 0
    assert run(["a", "b", "a", None, "bad"], slices=3, callers=2) == (["allow"] * 3 + ["warn"] * 2, 3)
    assert run(["a", "c", "b"]) == (["allow"] * 3, 1)
    assert run(["a", "b", "c", "bad"], slices=2) == (["allow"] * 3 + ["warn"], 1)
    assert run(["a", "b"]) == (["allow"] * 2, 0)
    assert run(["a"], model="other") == (["allow"], 1)
    # A slice written twice does no harm.
    stored = spark.read.schema("key string, answer struct<value: string, error: string>").parquet(path)
    stored.write.parquet(f"{path}/run=again")
    assert run(["a", "b", "c"]) == (["allow"] * 3, 0)
    with pytest.raises(ValueError):
        ReplyStore(path, slices=0)


def test_failures_and_fallbacks(run_text):
    texts = ["seven 7", "hate"]
    rows = run_text(jd.Judge(failing_scorer), texts)
    assert [r["ModelJudge_result"] for r in rows] == ["warn", "block"]
    assert rows[0]["ModelJudge_metadata"]["error"] == "model unavailable"

    def fallback(text):
        return Verdict(F.lit("block"), F.concat(F.lit("by hand: "), text))

    rows = run_text(jd.Judge(failing_scorer, fallback=fallback), texts)
    assert rows[0]["ModelJudge_reason"] == "by hand: seven 7"
    rows = run_text(jd.Judge(fallback=fallback), texts)
    assert [r["ModelJudge_result"] for r in rows] == ["block", "block"]
    rows = run_text(jd.Judge(), texts)
    assert rows[0]["ModelJudge_reason"] == "No LLM configured and no fallback provided"

    def broken(system_prompt, prompts):
        raise OSError("down")

    rows = run_text(jd.Judge(broken), texts)
    assert rows[1]["ModelJudge_reason"] == "LLM validation failed: down"


def test_variables(spark):
    df = spark.createDataFrame(
        [(0, "x", {"tier": "gold"}), (1, "x", {}), (2, "x", {"tier": "t", "content": "hate"})],
        "id long, text string, metadata map<string,string>",
    )

    def echo(system_prompt, prompts):
        return [f"okay {p}" for p in prompts]

    stage = jd.Judge(echo, instruction="{tier}|{content}", metadata_col="metadata")
    rows = stage(df).orderBy("id").collect()
    assert [r.ModelJudge_reason for r in rows] == [
        "okay gold|x", "LLM validation failed: 'tier'", "okay t|hate"]


def test_custom_parser(run_text):
    def parse(reply):
        return {"is_safe": reply == "okay", "reason": reply, "confidence": F.lit(1.0)}

    rows = run_text(jd.Judge(lambda s, p: ["okay", "bad"][:len(p)], parse=parse, share="batch",
                             batch_size=2), ["a", "b"])
    assert sorted(r["ModelJudge_result"] for r in rows) in (["allow", "block"], ["allow", "allow"])


def test_content_safety(run_text):
    def scorer(system_prompt, prompts):
        return [p.split("|")[1] for p in prompts]

    replies = [
        '{"is_safe": false, "violations": ["hate", "x"], "confidence": 0.9}',
        '{"is_safe": false, "violations": ["hate"], "confidence": 0.1}',
        "unsafe!", "{}", '{"is_safe": false, "violations": [1]}',
    ]
    stage = jd.ContentSafetyJudge(scorer, custom_safety_prompt="|{content}|")
    rows = run_text(stage, replies)
    assert [r["ContentSafety_result"] for r in rows] == ["block", "warn", "allow", "allow", "warn"]
    assert rows[0]["ContentSafety_reason"] == "Content safety violation: hate, x"
    assert rows[1]["ContentSafety_reason"] == "Potential safety concerns: hate"
    assert rows[4]["ContentSafety_reason"].startswith("Safety check failed: ")
    rows = run_text(jd.ContentSafetyJudge(), ["attack"])
    assert rows[0]["ContentSafety_metadata"]["method"] == "keyword"


def test_presets_mention_their_arguments():
    def prompt(stage):
        return stage.instruction.format(content="<text>", known_facts="<facts>")

    assert "- Kind" in prompt(jd.brand_safety(None, ["Kind"], ["war", "{x}"]))
    assert "war, {x}" in prompt(jd.brand_safety(None, ["Kind"], ["war", "{x}"]))
    assert "sarcastic" in prompt(jd.tone(None, "warm", ["sarcastic"]))
    facts = jd.factual_check(None, "Water is wet.", require_citations=True)
    assert "Water is wet." in prompt(facts) and "sources" in prompt(facts)
    assert (facts.threshold, jd.tone(None, "x").threshold) == (0.8, 0.7)
