"""Ready-made chains for requests and answers."""

from __future__ import annotations

from ..functions import fixed_values as fixed
from ..operators.compose import Chain
from ..operators.judge import ContentSafetyJudge, Judge, Scorer
from ..operators.ratelimit import RateLimit
from ..operators.stage import Stage
from ..operators.validators import input_length, output_length, pii_screen, prompt_injection
from ..streaming.ratelimit import StreamRateLimit

TOPIC_PROMPT = (
    "Is the query below about technology, programming, software, AI or machine learning?\n\n"
    "Content:\n{content}\n\n"
    'Reply with one JSON object: {{"is_safe": true if it is on topic, else false, '
    '"reason": "short reason", "confidence": number from 0 to 1}}\n\n'
    "Related topics count; only a query clearly about something else is off topic."
)


def safety_preset(
    level: str = "moderate",
    scorer: Scorer | None = None,
    *,
    per_minute: int | None = None,
    per_hour: int | None = None,
    judge_options: dict | None = None,
    live: bool = False,
    **rate_options,
) -> Chain:
    """Checks for requests: length, rate, injection, personal data, then model checks.

    ``level`` is strict, moderate or permissive; anything else means moderate.  The two
    model checks are part of the chain when a scorer is given.  ``per_minute`` and
    ``per_hour`` override the level's limits; ``rate_options`` go to ``RateLimit``, or with
    ``live``, for streams of requests, to ``StreamRateLimit``.
    """
    longest, minute, hour = fixed.PRESETS.get(level, fixed.PRESETS["moderate"])
    stages: list[Stage] = [
        input_length(fixed.PRESET_MIN_CHARS, longest),
        (StreamRateLimit if live else RateLimit)(
            minute if per_minute is None else per_minute,
            hour if per_hour is None else per_hour,
            **rate_options,
        ),
        prompt_injection(strict=True),
        pii_screen(redact=True, strict=False),
    ]
    if scorer is not None:
        # Within an Arrow batch repeats are sent once; that needs no shuffle and already
        # takes care of texts with very many copies.
        options = {"share": "batch", **(judge_options or {})}
        stages += [
            Judge(
                scorer, "You check whether queries fit the allowed topics.", TOPIC_PROMPT, 0.7,
                name="TopicValidation", **options,
            ),
            ContentSafetyJudge(scorer, threshold=0.7, **options),
        ]
    return Chain(stages)


def output_preset() -> Stage:
    """The check for answers: cut at 1000 characters, block below 10."""
    shortest, longest = fixed.PRESET_OUTPUT_CHARS
    return output_length(shortest, longest, truncate=True)
