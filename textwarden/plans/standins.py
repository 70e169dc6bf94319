"""Deterministic stand-ins for a model and an embedder, for queries and tests."""

from __future__ import annotations

import numpy as np

LETTERS = "aeiourst"

# Word looked for in the content, and the reply it draws; the first hit counts.
REPLIES = (
    ("hate", '{"is_safe": false, "reason": "hateful", "confidence": 0.9, "violations": ["hate"]}'),
    ("harm", '{"is_safe": false, "reason": "harmful", "confidence": 0.4, "violations": ["harm"]}'),
    ("the ", "Looks okay to me"),
    ("th", "This is inappropriate"),
)
DEFAULT_REPLY = '{"is_safe": true, "reason": "fine", "confidence": 0.8}'


def content_of(prompt: str) -> str:
    """The content inside one of the engine's prompts."""
    return prompt.split("Content:\n", 1)[-1].split("\n\nReply with one JSON object", 1)[0]


def word_scorer(system_prompt: str | None, prompts: list[str]) -> list[str]:
    """Replies by the first listed word the content holds."""
    contents = [content_of(p).lower() for p in prompts]
    return [next((r for w, r in REPLIES if w in c), DEFAULT_REPLY) for c in contents]


def failing_scorer(system_prompt: str | None, prompts: list[str]) -> list:
    """As ``word_scorer``, but each content with a digit 7 fails."""
    replies = word_scorer(system_prompt, prompts)
    return [
        RuntimeError("model unavailable") if "7" in content_of(p) else r
        for p, r in zip(prompts, replies)
    ]


def letter_embedder(texts: list[str]) -> list[np.ndarray]:
    """How often each of a few letters occurs."""
    return [np.array([t.lower().count(c) for c in LETTERS], dtype=np.float32) for t in texts]
