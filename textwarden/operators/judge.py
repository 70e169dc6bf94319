"""Checks judged by a user-supplied model.

The model is any function ``scorer(system_prompt, prompts) -> replies`` running on
executors.  Prompts are rendered in the JVM, each distinct prompt is sent once, replies
are parsed and weighed against a threshold.  Whatever fails is a warning, never a block.
Spark may run a task again, so a prompt can reach the model more than once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions.objects import read_verdict
from ..functions.text import render_prompt, template_fields
from .batch import call_per_text
from .replies import ReplyStore
from .stage import ALLOW, BLOCK, WARN, ColumnStage, Stage, Verdict, add_verdict
from .validators import keyword_safety

Scorer = Callable[[str | None, list[str]], Sequence]

SYSTEM_PROMPT = "You check whether content is acceptable."
INSTRUCTION = (
    "Decide whether the content below is acceptable.\n\nContent:\n{content}\n\n"
    'Reply with one JSON object: {{"is_safe": true or false, "reason": "short reason", '
    '"confidence": number from 0 to 1}}'
)


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.contains(text, F.lit(word))
    return out


def parse_verdict(reply: Column, fields: Column | None = None) -> dict[str, Column]:
    """``is_safe``, ``reason``, ``confidence`` and ``problem`` of a reply.

    A JSON object with ``is_safe`` counts as it stands; any other reply is searched for
    telling words and believed with a confidence of one half.
    """
    fields = read_verdict(reply) if fields is None else fields
    lower = F.lower(reply)
    guessed = (
        F.when(_contains_any(lower, fixed.UNSAFE_MARKS), False)
        .when(_contains_any(lower, fixed.SAFE_MARKS), True)
        .when(_contains_any(lower, fixed.UNSAFE_HINTS), False)
        .otherwise(True)
    )
    parsed = F.coalesce(fields["has_is_safe"], F.lit(False))
    is_safe = F.when(parsed, ~fields["unsafe"]).otherwise(guessed)
    bad_number = parsed & ~is_safe & ~fields["confidence_ok"]
    return {
        "is_safe": is_safe,
        "reason": F.when(parsed, fields["reason"]).otherwise(
            F.substring(reply, 1, fixed.REPLY_REASON_CHARS)
        ),
        "confidence": F.when(parsed, fields["confidence"]).otherwise(
            F.lit(fixed.REPLY_REASON_CONFIDENCE)
        ),
        "problem": F.when(parsed & ~fields["metadata_ok"], "reply metadata is not an object").when(
            bad_number, "reply confidence is not a number"
        ),
    }


def reaches(score: Column, threshold: float) -> Column:
    """Score at the threshold or above; NaN, which Spark orders last, is not."""
    return ~F.isnan(score) & (score >= threshold)


def verdict_threshold(
    parsed: Mapping[str, Column], threshold: float, reply: Column
) -> Verdict:
    """Block what is unsafe with enough confidence, warn below it, allow the rest."""
    safe, sure = parsed["is_safe"], reaches(parsed["confidence"], threshold)
    return Verdict(
        F.when(safe, ALLOW).when(sure, BLOCK).otherwise(WARN),
        F.when(safe | sure, parsed["reason"]).otherwise(
            F.concat(F.lit("Low confidence concern: "), parsed["reason"])
        ),
        F.struct(
            reply.alias("llm_response"),
            parsed["confidence"].alias("confidence"),
            F.lit(None).cast("string").alias("error"),
        ),
    )


def fallback_or_warn(
    verdict: Verdict, error: Column, prefix: str, fallback: Verdict | None = None
) -> Verdict:
    """The verdict where there is no error; else the fallback's, else a warning."""
    failed = error.isNotNull()
    if fallback is not None:
        action, reason = fallback.action, fallback.reason
    else:
        action, reason = F.lit(WARN), F.concat(F.lit(prefix), error)
    return Verdict(
        F.when(failed, action).otherwise(verdict.action),
        F.when(failed, reason).otherwise(verdict.reason),
        verdict.metadata.withField("error", error) if verdict.metadata is not None else None,
        F.when(failed, fallback.text).otherwise(verdict.text)
        if fallback is not None and fallback.text is not None and verdict.text is not None
        else (fallback.text if fallback is not None else None),
    )


class Judge(Stage):
    """A model's opinion of the text as a stage.

    ``instruction`` is a ``str.format`` template with ``{content}`` and further names
    taken from ``variables`` (columns) or ``metadata_col`` (a string map column); those
    win over the content.  ``fallback`` maps the text column to a ``Verdict`` used when
    there is no scorer or it fails.  ``parse`` replaces ``parse_verdict``: it maps the
    reply column to ``is_safe``, ``reason`` and ``confidence`` columns.  ``replies`` is a
    lasting ``ReplyStore``: prompts answered by an earlier run are not sent again.
    """

    failure_prefix = fixed.JUDGE_FAILED

    def __init__(
        self,
        scorer: Scorer | None = None,
        system_prompt: str | None = SYSTEM_PROMPT,
        instruction: str = INSTRUCTION,
        threshold: float = 0.7,
        fallback: Callable[[Column], Verdict] | None = None,
        parse: Callable[[Column], Mapping[str, Column]] | None = None,
        variables: Mapping[str, Column] | None = None,
        metadata_col: str | None = None,
        name: str = "ModelJudge",
        *,
        share: str = "table",
        batch_size: int = 64,
        concurrency: int | None = None,
        store_replies: bool = False,
        replies: ReplyStore | None = None,
    ):
        super().__init__(name)
        self.scorer, self.system_prompt, self.instruction = scorer, system_prompt, instruction
        self.threshold, self.fallback, self.parse = threshold, fallback, parse
        self.variables, self.metadata_col = dict(variables or {}), metadata_col
        self.call_options = dict(
            share=share, batch_size=batch_size, concurrency=concurrency, store=store_replies,
            replies=replies, settings=system_prompt or "",
        )

    def _variables(self, text: Column) -> dict[str, Column]:
        known = {"content": text}
        if self.metadata_col:
            extras = F.col(self.metadata_col)
            for field in template_fields(self.instruction):
                value = F.try_element_at(extras, F.lit(field))
                known[field] = F.coalesce(value, known[field]) if field in known else value
        return {**known, **self.variables}

    def prompt(self, text: Column) -> tuple[Column, Column]:
        """The rendered prompt, and what is missing where it could not be rendered."""
        known = self._variables(text)
        missing = [
            F.when(known[f].isNull() if f in known else F.lit(True), f"'{f}'")
            for f in template_fields(self.instruction)
        ]
        lacking = F.coalesce(*missing) if missing else F.lit(None).cast("string")
        return render_prompt(self.instruction, known), lacking

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        text = F.col(text_col)
        if self.scorer is None:
            verdict = (
                self.fallback(text) if self.fallback
                else Verdict(F.lit(ALLOW), F.lit(fixed.NO_SCORER))
            )
            return add_verdict(df, self.name, text_col, active, verdict)
        answer, lacks, asked, fields = (
            f"__{self.name}_{x}" for x in ("answer", "lacks", "asked", "fields")
        )
        prompt, lacking = self.prompt(text)
        # Evaluated before the join below, which must not re-evaluate it.
        df = df.withColumn(asked, F.lit(True) if active is None else F.coalesce(active, F.lit(False)))
        df = df.withColumn(lacks, lacking)
        scorer, system_prompt = self.scorer, self.system_prompt
        df = call_per_text(
            df, F.when(F.col(asked), prompt), lambda prompts: scorer(system_prompt, prompts),
            T.StringType(), answer, **self.call_options,
        )
        reply = F.col(answer)["value"]
        df = df.withColumn(fields, read_verdict(reply))
        error = F.coalesce(
            F.col(lacks), F.col(answer)["error"], F.when(reply.isNull(), "no reply")
        )
        verdict = self.decide(reply, F.col(fields), error)
        if self.fallback is not None:
            verdict = fallback_or_warn(verdict, self._error(verdict, error), self.failure_prefix,
                                       self.fallback(text))
        else:
            verdict = fallback_or_warn(verdict, self._error(verdict, error), self.failure_prefix)
        return add_verdict(df, self.name, text_col, F.col(asked), verdict).drop(
            answer, lacks, asked, fields
        )

    @staticmethod
    def _error(verdict: Verdict, error: Column) -> Column:
        return F.coalesce(error, verdict.metadata["error"])

    def decide(self, reply: Column, fields: Column, error: Column) -> Verdict:
        if self.parse is not None:
            parsed = dict(self.parse(reply))
            parsed.setdefault("problem", F.lit(None).cast("string"))
        else:
            parsed = parse_verdict(reply, fields)
        verdict = verdict_threshold(parsed, self.threshold, reply)
        return Verdict(
            verdict.action, verdict.reason, verdict.metadata.withField("error", parsed["problem"])
        )


# ---- presets -------------------------------------------------------------

_ANSWER = (
    '\n\nReply with one JSON object: {{"is_safe": true or false, "reason": "short reason", '
    '"confidence": number from 0 to 1'
)


def _quote(text: str) -> str:
    """Protect braces of fixed text that becomes part of a template."""
    return text.replace("{", "{{").replace("}", "}}")


class ContentSafetyJudge(Judge):
    """A model names violated safety categories; keyword search stands in without one.

    Only a JSON object counts as a reply: anything else is taken as safe.
    """

    failure_prefix = "Safety check failed: "

    def __init__(
        self,
        scorer: Scorer | None = None,
        safety_categories: Sequence[str] = fixed.SAFETY_CATEGORIES,
        threshold: float = 0.7,
        custom_safety_prompt: str | None = None,
        name: str = "ContentSafety",
        **options,
    ):
        self.categories = list(safety_categories or fixed.SAFETY_CATEGORIES)
        prompt = custom_safety_prompt or (
            "Judge the content below against these safety categories: "
            + _quote(", ".join(self.categories))
            + ".\n\nContent:\n{content}"
            + _ANSWER
            + ', "violations": [violated categories], "explanation": "short"}}\n\n'
            "Call it unsafe only when it clearly violates a category; when in doubt, allow it."
        )
        super().__init__(scorer, None, prompt, threshold, name=name, **options)

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        if self.scorer is None:
            return keyword_safety(self.categories, name=self.name).apply(df, text_col, active)
        return super().apply(df, text_col, active)

    def decide(self, reply: Column, fields: Column, error: Column) -> Verdict:
        unsafe = F.coalesce(fields["unsafe"], F.lit(False))
        listed = F.array_join(fields["violations"], ", ")
        sure = reaches(fields["confidence"], self.threshold)
        problem = F.when(unsafe & ~fields["confidence_ok"], "reply confidence is not a number").when(
            unsafe & ~fields["violations_ok"], "reply violations are not a list of strings"
        )
        return Verdict(
            F.when(~unsafe, ALLOW).when(sure, BLOCK).otherwise(WARN),
            F.when(~unsafe, "Content is safe")
            .when(sure, F.concat(F.lit("Content safety violation: "), listed))
            .otherwise(F.concat(F.lit("Potential safety concerns: "), listed)),
            F.struct(
                F.when(unsafe, fields["violations"]).alias("violations"),
                F.when(unsafe, fields["confidence"]).alias("confidence"),
                F.when(~unsafe | sure, F.coalesce(fields["json"], F.lit("{}")))
                .alias("safety_result"),
                problem.alias("error"),
            ),
        )


def brand_safety(
    scorer: Scorer | None,
    brand_values: Sequence[str] | None = None,
    prohibited_topics: Sequence[str] | None = None,
    threshold: float = 0.7,
    name: str = "BrandSafety",
    **options,
) -> Judge:
    """A model checks the text against brand values and prohibited topics."""
    values = brand_values or ["Professional", "Respectful", "Appropriate"]
    prompt = "Does the content below fit these brand values?\n" + _quote(
        "\n".join(f"- {v}" for v in values)
    )
    if prohibited_topics:
        prompt += "\nTopics that must not come up: " + _quote(", ".join(prohibited_topics))
    prompt += (
        "\n\nContent:\n{content}" + _ANSWER + ', "violations": [what it violates]}}\n\n'
        "Fail it only for a clear breach, judged in context."
    )
    return Judge(scorer, "You judge whether content fits a brand.", prompt, threshold,
                 name=name, **options)


def tone(
    scorer: Scorer | None,
    desired_tone: str,
    disallowed_tones: Sequence[str] | None = None,
    threshold: float = 0.7,
    name: str = "ToneValidation",
    **options,
) -> Judge:
    """A model checks the text's tone."""
    prompt = "Is the content below written in this tone: " + _quote(desired_tone) + "?"
    if disallowed_tones:
        prompt += "\nTones it must not have: " + _quote(", ".join(disallowed_tones))
    prompt += (
        "\n\nContent:\n{content}" + _ANSWER + ', "detected_tone": "its actual tone"}}\n\n'
        "is_safe is true exactly if the tone fits."
    )
    return Judge(scorer, "You analyse the tone of texts.", prompt, threshold, name=name, **options)


def factual_check(
    scorer: Scorer | None,
    knowledge_base: str | Column | None = None,
    require_citations: bool = False,
    threshold: float = 0.8,
    name: str = "FactualAccuracy",
    **options,
) -> Judge:
    """A model checks claims, against known facts if given as text or as a column."""
    variables = dict(options.pop("variables", None) or {})
    prompt = "Are the claims in the content below correct?"
    if isinstance(knowledge_base, Column):
        variables["known_facts"] = knowledge_base
        prompt += "\n\nKnown facts:\n{known_facts}"
    elif knowledge_base:
        prompt += "\n\nKnown facts:\n" + _quote(knowledge_base)
    if require_citations:
        prompt += "\nThe content has to name its sources."
    prompt += (
        "\n\nContent:\n{content}" + _ANSWER + ', "issues": [errors found]}}\n\n'
        "is_safe is true exactly if nothing in it is wrong."
    )
    return Judge(scorer, "You check facts.", prompt, threshold, variables=variables,
                 name=name, **options)


def verdict_stage(reply_col: str, threshold: float = 0.7, name: str = "Verdict") -> Stage:
    """Parse and weigh replies that are already in a column."""
    def facts(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return {"fields": read_verdict(F.col(reply_col))}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        reply = F.col(reply_col)
        parsed = parse_verdict(reply, known["fields"])
        verdict = verdict_threshold(parsed, threshold, reply)
        error = F.coalesce(parsed["problem"], F.when(reply.isNull(), "no reply"))
        return fallback_or_warn(verdict, error, fixed.JUDGE_FAILED)

    return ColumnStage(name, decide, [facts])
