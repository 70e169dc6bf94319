"""Patterns, word lists and messages that results must match exactly.

Nothing here is logic.  Patterns are written in Python ``re`` notation;
``functions.regex.java_pattern`` turns them into the Java notation Spark uses.
"""

# Personal data, in detection and redaction order: type, pattern, replacement.
PII_PATTERNS = (
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL_REDACTED]"),
    (
        "phone",
        r"\b(?:\+?1[-.]?)?\(?([0-9]{3})\)?[-.]?([0-9]{3})[-.]?([0-9]{4})\b",
        "[PHONE_REDACTED]",
    ),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "[SSN_REDACTED]"),
    ("credit_card", r"\b(?:\d{4}[-\s]?){3}\d{4}\b", "[CREDIT_CARD_REDACTED]"),
    ("ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP_REDACTED]"),
)

# Keyword safety: words looked for in lower-cased text, per category.
SAFETY_WORDS = {
    "violence": ("kill", "murder", "attack", "harm", "weapon"),
    "hate": ("hate", "racist", "discriminate"),
    "illegal": ("illegal", "crime", "fraud"),
}
SAFETY_CATEGORIES = ("violence", "hate", "sexual", "self-harm", "illegal")

# Prompt injection, searched in lower-cased text.
INJECTION_PATTERNS = (
    r"ignore (previous|above|all|the|your) (instructions?|prompts?|rules?)",
    r"disregard (previous|above|all|the|your) (instructions?|prompts?|rules?)",
    r"forget (everything|all|previous|above)",
    r"new instructions?:",
    r"system prompt:",
    r"you are now",
    r"act as",
    r"pretend (you are|to be)",
    r"roleplay as",
)

# Code safety.
IMPORT_PATTERN = r"import\s+([a-zA-Z0-9_\.]+)"
DANGEROUS_CALL_PATTERNS = (
    r"eval\s*\(",
    r"exec\s*\(",
    r"__import__\s*\(",
    r"compile\s*\(",
    r"open\s*\(",
    r"system\s*\(",
    r"subprocess\.",
)

# Markup removal.
TAG_PATTERN = r"<[^>]+>"
ENTITY_PATTERN = r"&[a-zA-Z]+;"

# Words that hint at a verdict in a reply without usable JSON.
UNSAFE_HINTS = ("unsafe", "inappropriate", "violation", "block")
SAFE_HINTS = ("safe", "appropriate", "allow", "okay")
UNSAFE_MARKS = ("is_safe: false", '"is_safe": false')
SAFE_MARKS = ("is_safe: true", '"is_safe": true')
REPLY_REASON_CHARS = 200
REPLY_REASON_CONFIDENCE = 0.5

# Token estimate and truncation.
TOKENS_PER_WORD = 0.75
TRUNCATION_SUFFIX = "..."

# Rate limiting.
MINUTE_SECONDS = 60
HOUR_SECONDS = 3600
ANONYMOUS_USER = "anonymous"

# Borderline similarity band in which a model has the last word.
BORDERLINE_LOW = 0.6
BORDERLINE_HIGH = 0.8

# Presets: level, longest input in characters, requests per minute and per hour.
PRESETS = {
    "strict": (500, 5, 50),
    "moderate": (1000, 10, 100),
    "permissive": (2000, 20, 200),
}
PRESET_MIN_CHARS = 3
PRESET_OUTPUT_CHARS = (10, 1000)

# Messages shown to a user.
REJECTION_PREFIX = "I cannot process this request. Reason: "
REJECTION_DEFAULT_REASON = "Content did not pass validation"
REJECTION_WITHOUT_STAGE = "Request blocked by guardrails"
RETRY_APOLOGY = (
    "I apologize, but I couldn't generate an appropriate response. "
    "Please try rephrasing your question."
)
ERROR_APOLOGY = (
    "I'm sorry, but I'm unable to process your request at this time. Please try again later."
)
CONDITION_NOT_MET = "Condition not met, skipped validation"
NO_SCORER = "No LLM configured and no fallback provided"
JUDGE_FAILED = "LLM validation failed: "
