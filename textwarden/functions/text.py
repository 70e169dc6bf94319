"""Text functions as Spark columns.  All of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .regex import SPACE, java_pattern

PII_TYPES = tuple(name for name, _, _ in fixed.PII_PATTERNS)
# Possessive before the @, which the class before it cannot match: same matches, but no
# word is tried again from its end.
_PII_SOURCE = {name: pattern.replace("]+@", "]++@") for name, pattern, _ in fixed.PII_PATTERNS}
_PII_REGEX = {name: java_pattern(pattern) for name, pattern in _PII_SOURCE.items()}


def _core(pattern: str) -> str:
    """What every match contains, without boundaries and optional beginnings.

    Whatever matches the pattern matches this, which is much faster to look for.
    """
    bare = pattern.replace(r"\b", "")
    return java_pattern(bare[max(bare.find("([0-9]"), 0):])


_PII_CORE = {name: _core(pattern) for name, pattern in _PII_SOURCE.items()}
_PII_TAG = {name: tag for name, _, tag in fixed.PII_PATTERNS}


def empty_strings() -> Column:
    return F.array().cast("array<string>")


# ---- personal data -------------------------------------------------------

def pii_hints(text: Column) -> dict[str, Column]:
    """Cheap tests that hold wherever a type can occur at all.

    Each is implied by the patterns it stands for, so skipping rows that fail it loses
    nothing.  A text without personal data costs a byte search and one short scan, not
    five long ones.
    """
    return {
        "at": F.contains(text, F.lit("@")),
        "digits": text.rlike(r"\p{Nd}(?:\p{Nd}{3}|\.\p{Nd}{1,3}\.\p{Nd})"),
    }


_HINT_OF = {name: "at" if name == "email" else "digits" for name in PII_TYPES}


def _ten_digit_phone(match: Column) -> Column:
    digits = F.right(F.regexp_replace(match, "[^0-9]", ""), F.lit(10))
    return F.concat_ws(
        "-", F.substring(digits, 1, 3), F.substring(digits, 4, 3), F.substring(digits, 7, 4)
    )


def pii_matches(text: Column, pii_type: str, hint: Column | None = None) -> Column:
    """All non-overlapping matches of one type, in order; NULL text gives NULL."""
    found = F.regexp_extract_all(text, F.lit(_PII_REGEX[pii_type]), F.lit(0))
    if pii_type == "phone":
        found = F.transform(found, _ten_digit_phone)
    if hint is None:
        hint = pii_hints(text)[_HINT_OF[pii_type]]
    possible = hint & text.rlike(_PII_CORE[pii_type])
    return F.when(possible, found).when(text.isNotNull(), empty_strings())


def pii_detect(text: Column, hints: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """One ``array<string>`` of matches per type of personal data."""
    hints = hints or pii_hints(text)
    return {name: pii_matches(text, name, hints[_HINT_OF[name]]) for name in PII_TYPES}


def pii_redact_step(text: Column, pii_type: str, found: Column) -> Column:
    """Replace one type, in rows where it was found in the original text."""
    return F.when(
        F.size(found) > 0, F.regexp_replace(text, _PII_REGEX[pii_type], _PII_TAG[pii_type])
    ).otherwise(text)


def pii_redact(df: DataFrame, text_col: str, found: Mapping[str, Column]) -> DataFrame:
    """Redact a column type after type, each step on the text the last one left.

    Every step is a projection of its own: nesting the conditional steps in a single
    expression would double it with each type.
    """
    for name in PII_TYPES:
        df = df.withColumn(text_col, pii_redact_step(F.col(text_col), name, found[name]))
    return df


# ---- length --------------------------------------------------------------

def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def approx_tokens(text: Column) -> Column:
    """Estimated tokens: three for every four words, rounded down."""
    return F.floor(word_count(text) * F.lit(fixed.TOKENS_PER_WORD)).cast("int")


def text_length(text: Column, count_by: str) -> Column:
    return approx_tokens(text) if count_by == "tokens" else F.length(text)


def truncate_text(
    text: Column, max_length: int, suffix: str = fixed.TRUNCATION_SUFFIX
) -> Column:
    """Cut to ``max_length`` characters, the suffix included."""
    if max_length < len(suffix):
        raise ValueError(f"max_length {max_length} is shorter than the suffix {suffix!r}")
    cut = F.concat(F.substring(text, 1, max_length - len(suffix)), F.lit(suffix))
    return F.when(F.length(text) <= max_length, text).otherwise(cut)


def has_visible(text: Column) -> Column:
    """True when the text holds anything but white space."""
    return F.coalesce(text.rlike(f"[^{SPACE}]"), F.lit(False))


# ---- markup and prompts --------------------------------------------------

def strip_html(text: Column) -> Column:
    """Drop tags, then named entities."""
    return F.regexp_replace(
        F.regexp_replace(text, fixed.TAG_PATTERN, ""), fixed.ENTITY_PATTERN, ""
    )


def template_fields(template: str) -> list[str]:
    """Placeholder names of a ``str.format`` template, in order."""
    return [name for _, name in _template_pieces(template) if name is not None]


def _template_pieces(template: str) -> list[tuple[str, str | None]]:
    from string import Formatter

    pieces = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if spec or conversion or (name is not None and not re.fullmatch(r"\w+", name)):
            raise ValueError(f"only plain {{name}} placeholders are supported, not {name!r}")
        pieces.append((literal, name))
    return pieces


def render_prompt(template: str, variables: Mapping[str, Column]) -> Column:
    """Fill a template; NULL when a placeholder is unknown or its value is NULL."""
    parts = []
    for literal, name in _template_pieces(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(variables[name].cast("string") if name in variables
                         else F.lit(None).cast("string"))
    return F.concat(*parts) if parts else F.lit("")
