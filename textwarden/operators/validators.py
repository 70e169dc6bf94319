"""Row checks built from column expressions."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx
from ..functions.objects import extract_json
from ..functions.regex import java_pattern, search
from .stage import ALLOW, BLOCK, MODIFY, WARN, ColumnStage, Stage, Verdict

_NULL_INT = "int"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def _hits(pairs: Sequence[tuple[Column, str]]) -> Column:
    """The labels whose condition holds, in order."""
    if not pairs:
        return tx.empty_strings()
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in pairs]))


# ---- length --------------------------------------------------------------

def _length_stage(
    name: str,
    subject: str,
    fine: str,
    min_length: int,
    max_length: int | None,
    truncate: bool,
    count_by: str,
    full_metadata: bool,
) -> Stage:
    if truncate and max_length is not None and max_length < len(fixed.TRUNCATION_SUFFIX):
        raise ValueError(f"max_length {max_length} is shorter than the truncation suffix")

    def facts(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        # An absent text is an empty one.
        return {"length": tx.text_length(F.coalesce(text, F.lit("")), count_by)}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        length = known["length"]
        short = length < min_length
        over = F.lit(False) if max_length is None else length > max_length
        fields = {
            "length": F.when(~(over & ~short & F.lit(truncate)), length),
            "original_length": F.when(over & ~short & F.lit(truncate), length),
        }
        if full_metadata:
            fields["truncated_length"] = F.when(
                over & ~short & F.lit(truncate), F.lit(max_length)
            ).cast(_NULL_INT)
            fields["min_length"] = F.when(short, F.lit(min_length)).cast(_NULL_INT)
            fields["max_length"] = F.when(
                over & ~short & ~F.lit(truncate), F.lit(max_length)
            ).cast(_NULL_INT)
        on_over = (MODIFY, f"{subject} truncated to {max_length} {count_by}") if truncate else (
            BLOCK, f"{subject} too long (maximum {max_length} {count_by})")
        return Verdict(
            F.when(short, BLOCK).when(over, on_over[0]).otherwise(ALLOW),
            F.when(short, f"{subject} too short (minimum {min_length} {count_by})")
            .when(over, on_over[1])
            .otherwise(fine),
            F.struct(*[value.alias(key) for key, value in fields.items()]),
            tx.truncate_text(text, max_length) if truncate and max_length is not None else None,
        )

    return ColumnStage(name, decide, [facts])


def input_length(
    min_length: int = 1,
    max_length: int = 10000,
    truncate: bool = False,
    count_by: str = "characters",
    name: str = "InputLength",
) -> Stage:
    """Bounds on a text's length in characters or estimated tokens; both inclusive.

    ``truncate`` cuts to ``max_length`` *characters* whichever unit is counted.
    """
    return _length_stage(
        name, "Input", "Input length within limits",
        min_length, max_length, truncate, count_by, True,
    )


def output_length(
    min_length: int = 1,
    max_length: int | None = None,
    truncate: bool = False,
    count_by: str = "characters",
    name: str = "OutputLength",
) -> Stage:
    """As ``input_length`` for answers; a ``max_length`` of None or 0 means no upper bound."""
    return _length_stage(
        name, "Output", "Output length within bounds",
        min_length, max_length or None, truncate, count_by, False,
    )


# ---- format --------------------------------------------------------------

def output_format(
    expected_format: str = "text",
    required_fields: Sequence[str] = (),
    name: str = "OutputFormat",
) -> Stage:
    """``json`` with required top-level keys, or non-blank ``text`` / ``markdown``."""
    required = list(required_fields or ())
    if expected_format == "json":
        return _json_format(name, required)
    if expected_format in ("text", "markdown"):
        def decide(text: Column, _: dict[str, Column]) -> Verdict:
            filled = tx.has_visible(text)
            return Verdict(
                F.when(filled, ALLOW).otherwise(BLOCK),
                F.when(filled, f"Output is valid {expected_format}").otherwise("Output is empty"),
            )
        return ColumnStage(name, decide)
    return ColumnStage(
        name,
        lambda text, _: Verdict(
            F.lit(ALLOW), F.lit(f"Format validation not implemented for {expected_format}")
        ),
    )


def _json_format(name: str, required: list[str]) -> Stage:
    def parse(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return {"object": extract_json(text)}

    def check(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        keys = known["object"]["keys"]
        return {"missing": _hits([(~F.array_contains(keys, field), field) for field in required])}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        invalid = known["object"]["json"].isNull()
        missing = known["missing"]
        lacking = F.size(missing) > 0
        return Verdict(
            F.when(invalid | lacking, BLOCK).otherwise(ALLOW),
            F.when(invalid, "Output is not valid JSON")
            .when(lacking,
                  F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", ")))
            .otherwise("Output is valid JSON with all required fields"),
            F.struct(
                F.when(~invalid & lacking, missing).alias("missing_fields"),
                F.when(~invalid & ~lacking, known["object"]["json"]).alias("parsed_json"),
            ),
        )

    return ColumnStage(name, decide, [parse, check])


# ---- personal data -------------------------------------------------------

def pii_screen(
    redact: bool = True,
    strict: bool = False,
    allowed_pii_types: Collection[str] = (),
    name: str = "PIIDetection",
) -> Stage:
    """Detect personal data and redact it, or block (``strict``) or warn about it.

    Redaction covers every type found once any type is not allowed; ``pii_types`` lists
    the types that are not allowed, ``pii_count`` counts matches of all types.
    """
    screened = [t for t in tx.PII_TYPES if t not in set(allowed_pii_types or ())]

    def hints(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return tx.pii_hints(text)

    def detect(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        return tx.pii_detect(text, known)

    def summarise(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        found = {t: F.size(known[t]) > 0 for t in tx.PII_TYPES}
        return {"types": _hits([(found[t], t) for t in screened])}

    def redact_step(pii_type: str, before: str | None):
        def layer(text: Column, known: dict[str, Column]) -> dict[str, Column]:
            so_far = text if before is None else known[f"without_{before}"]
            return {f"without_{pii_type}": tx.pii_redact_step(so_far, pii_type, known[pii_type])}
        return layer

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        types = known["types"]
        hit = F.size(types) > 0
        total = sum((F.size(known[t]) for t in tx.PII_TYPES), F.lit(0))
        listed = F.array_join(types, ", ")
        if redact:
            action, said = MODIFY, "PII detected and redacted: "
            fine = "No PII detected or all PII types allowed"
        else:
            action, said = (BLOCK if strict else WARN), "PII detected: "
            fine = "No PII detected"
        return Verdict(
            F.when(hit, action).otherwise(ALLOW),
            F.when(hit, F.concat(F.lit(said), listed)).otherwise(fine),
            F.struct(
                F.when(hit, types).alias("pii_types"),
                (_null("int") if action == WARN else F.when(hit, total)).alias("pii_count"),
            ),
            known[f"without_{tx.PII_TYPES[-1]}"] if redact else None,
        )

    steps = [redact_step(t, b) for b, t in zip((None, *tx.PII_TYPES), tx.PII_TYPES)]
    return ColumnStage(name, decide, [hints, detect, summarise, *(steps if redact else [])])


# ---- keywords and patterns -----------------------------------------------

def keyword_verdict(violations: Column) -> Verdict:
    hit = F.size(violations) > 0
    said = F.concat(F.lit("Potential safety issues detected: "), F.array_join(violations, ", "))
    return Verdict(
        F.when(hit, BLOCK).otherwise(ALLOW),
        F.when(hit, said).otherwise("No safety issues detected (keyword check)"),
        F.struct(
            F.when(hit, violations).alias("violations"),
            F.when(hit, F.lit("keyword")).alias("method"),
        ),
    )


def keyword_safety(
    categories: Sequence[str] = fixed.SAFETY_CATEGORIES,
    lexicon: Mapping[str, Sequence[str]] | None = None,
    name: str = "ContentSafety",
) -> Stage:
    """Block texts holding a word of a selected category, also inside longer words."""
    words = lexicon if lexicon is not None else fixed.SAFETY_WORDS
    chosen = [c for c in words if c in set(categories or fixed.SAFETY_CATEGORIES)]

    def lower(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return {"lower": F.lower(text)}

    def look(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        pairs = [
            (_any([F.contains(known["lower"], F.lit(word)) for word in words[c]]), c)
            for c in chosen
        ]
        return {"violations": _hits(pairs)}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        return keyword_verdict(known["violations"])

    return ColumnStage(name, decide, [lower, look])


def prompt_injection(
    strict: bool = True,
    custom_patterns: Sequence[str] = (),
    name: str = "PromptInjection",
) -> Stage:
    """Block (or warn about) phrases that try to override instructions.

    Patterns are searched in lower-cased text, so one with capitals never matches.
    """
    patterns = list(fixed.INJECTION_PATTERNS) + list(custom_patterns or ())
    action = BLOCK if strict else WARN
    said = "Potential prompt injection detected" if strict else "Possible prompt injection attempt"

    def lower(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return {"lower": F.lower(text)}

    def look(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        return {"patterns": _hits([(search(known["lower"], p), p) for p in patterns])}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        hit = F.size(known["patterns"]) > 0
        return Verdict(
            F.when(hit, action).otherwise(ALLOW),
            F.when(hit, said).otherwise("No prompt injection detected"),
            F.struct(F.when(hit, known["patterns"]).alias("detected_patterns")),
        )

    return ColumnStage(name, decide, [lower, look])


def code_safety(
    allowed_imports: Sequence[str] | None = None,
    block_dangerous_functions: bool = True,
    name: str = "CodeExecution",
) -> Stage:
    """Block code importing modules outside a list or calling dangerous functions."""
    allowed = sorted(set(allowed_imports)) if allowed_imports else None

    def look(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        out = {}
        if allowed is not None:
            names = F.regexp_extract_all(text, F.lit(java_pattern(fixed.IMPORT_PATTERN)), F.lit(1))
            permitted = F.array(*[F.lit(m) for m in allowed])
            out["imports"] = F.when(
                F.contains(text, F.lit("import")),
                F.filter(names, lambda m: ~F.array_contains(permitted, m)),
            ).when(text.isNotNull(), tx.empty_strings())
        if block_dangerous_functions:
            out["calls"] = _hits(
                [(search(text, p), f"Dangerous function detected: {p}")
                 for p in fixed.DANGEROUS_CALL_PATTERNS]
            )
        return out

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        issues = tx.empty_strings()
        if "imports" in known:
            said = F.concat(
                F.lit("Unauthorized imports: "), F.array_join(known["imports"], ", ")
            )
            issues = F.array_compact(F.array(F.when(F.size(known["imports"]) > 0, said)))
        if "calls" in known:
            issues = F.concat(issues, known["calls"])
        hit = F.size(issues) > 0
        return Verdict(
            F.when(hit, BLOCK).otherwise(ALLOW),
            F.when(hit, "Potentially unsafe code detected").otherwise("Code passes safety checks"),
            F.struct(F.when(hit, issues).alias("issues")),
        )

    return ColumnStage(name, decide, [look])


def keyword_topic(
    allowed_topics: Sequence[str], fuzzy_match: bool = True, name: str = "TopicValidation"
) -> Stage:
    """Allow texts holding one of the topics, ignoring case; the first listed topic counts."""

    def lower(text: Column, _: dict[str, Column]) -> dict[str, Column]:
        return {"lower": F.lower(text)}

    def look(text: Column, known: dict[str, Column]) -> dict[str, Column]:
        topic = _null("string")
        if fuzzy_match and allowed_topics:
            topic = F.coalesce(
                *[F.when(F.contains(known["lower"], F.lit(t.lower())), F.lit(t))
                  for t in allowed_topics]
            )
        return {"topic": topic}

    def decide(text: Column, known: dict[str, Column]) -> Verdict:
        hit = known["topic"].isNotNull()
        return Verdict(
            F.when(hit, ALLOW).otherwise(BLOCK),
            F.when(hit, F.concat(F.lit("Topic '"), known["topic"], F.lit("' found in input")))
            .otherwise("Input does not match allowed topics"),
        )

    return ColumnStage(name, decide, [lower, look])
