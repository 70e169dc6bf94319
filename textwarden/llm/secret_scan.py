"""Secrets: fixed credential patterns, and values too costly to guess.

Three fixed patterns give the base spans: assignments to credential names, access-key ids
and long hexadecimal runs.  Beyond them, words that stand in a credential context (a cue
such as "password is", "pwd:", "login" or "Bearer" shortly before) are scored by the
number of guesses an informed attacker needs: the cheapest segmentation of the value into
dictionary words, dates, repeats, alphabetic or numeric sequences, keyboard walks and
brute-force spans, found by dynamic programming.  A value of at least ``MIN_LOG_GUESSES``
decimal digits of guesses becomes a span of kind ``guess`` where no base span is.  The
dictionary is a list of frequent passwords and words, followed by the words that most
documents hold, so that prose is cheap: those in at least ``WORD_DOCS`` documents, and in as
many more as leaves ``WORDS`` of them at most.

A sequence or a keyboard walk is a part of up to ``WALK`` characters; longer ones are several
parts.  Words, dates and repeats have their own lengths, repeats any.

Defined cases: a null text is an empty one; no text, no spans; values of every length are
scored alike; texts are read whole; repeated rows give equal results; other columns are
untouched.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, stored
from .spans import digest_columns

KINDS = ("assign", "access", "hex")
SCHEMA = ("kind array<string>, start array<int>, end array<int>, base array<boolean>, "
          "value array<string>, log_guesses array<double>")
MIN_LOG_GUESSES = 9.0
# Characters of a sequence or keyboard walk that are one part.
WALK = 64
# Words taken from the documents: so many at most, each in so many documents at least (a
# secret in a few documents is no word), of at most so many letters.
WORDS, WORD_DOCS, WORD_LETTERS = 50_000, 10, 24

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ASSIGN_CUES = ("passw", "secret", "token", "key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 32 or more is found at its first character only, and taken to its end.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

# Credential contexts beyond the base pattern: cue, separator, value.
_CONTEXT = re.compile(
    r"""(?:\b(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|credentials?|login|pin|"""
    r"""auth(?:orization)?|(?:api|access|private|client|secret)[ _-]?(?:key|token|secret)))"""
    r"""(?:["']?[ \t]{0,3}(?:[:=]|=>|->|\bis\b|\bwas\b)[ \t]{0,3}|[ \t]{1,3}(?:bearer|basic)[ \t]{1,3})"""
    r"""(?:bearer[ \t]{1,3}|basic[ \t]{1,3})?["'`]?([^\s"'`<>]{6,})""",
    re.IGNORECASE | re.ASCII)
_CONTEXT_CUES = ("pass", "pwd", "secret", "token", "credential", "login", "pin", "auth", "key")
_TRAILING = ".,;:!?)]}*#$%&|"

# Frequent passwords and words, most frequent first.
COMMON = """
password 123456 qwerty admin letmein welcome monkey dragon master login abc123 iloveyou
sunshine princess football shadow baseball superman michael jordan hunter secret summer
winter spring autumn trustno1 starwars hello freedom whatever passw0rd charlie test guest
root user default changeme access love money access123 computer internet killer pepper
ginger cookie soccer hockey george batman andrew tigger robert thomas daniel jessica
the of and to in is that for it with as was on be by this are from at an have not or which
you one all we can his her has there been if more when will would who so no out up said
what its about into than them time some could these two may then do first any my now
such like our over man me even most made after also did many before must through years
where much your way well down should because each just those people how too little state
good very make world still own see men work long get here between both life being under
never day same another know while last might us great old year off come since against
go came right used take three house home name place part new key token pass word
""".split()
_KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SUBSTITUTES = str.maketrans("@430$17!", "aaeositi")


def default_ranks(words: list[str] = COMMON) -> dict[str, int]:
    ranks: dict[str, int] = {}
    for word in words:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


def _neighbours() -> dict[str, set[str]]:
    """Keys that touch on a keyboard whose rows are each shifted by about half a key."""
    place = {c: (row, col + row * 0.5) for row, keys in enumerate(_KEYBOARD)
             for col, c in enumerate(keys)}
    return {
        a: {b for b, (r2, c2) in place.items()
            if b != a and abs(r1 - r2) <= 1 and abs(c1 - c2) <= 1}
        for a, (r1, c1) in place.items()
    }


_NEAR = _neighbours()
_DATE = re.compile(r"(\d{1,4})([-/._ ]?)(\d{1,2})\2(\d{1,4})")


def _charset(text: str) -> int:
    sizes = ((26, str.islower), (26, str.isupper), (10, str.isdecimal))
    known = sum(size for size, test in sizes if any(map(test, text)))
    return known + (33 if any(not c.isalnum() for c in text) else 0) or 10


def _is_date(part: str) -> bool:
    m = _DATE.fullmatch(part)
    if not m:
        return len(part) == 4 and part.isdecimal() and 1900 <= int(part) <= 2039
    a, b, c = int(m[1]), int(m[3]), int(m[4])
    years = lambda s, n: (len(s) == 4 and 1900 <= n <= 2039) or len(s) == 2
    day_month = lambda x, y: (1 <= x <= 31 and 1 <= y <= 12) or (1 <= x <= 12 and 1 <= y <= 31)
    return (years(m[1], a) and day_month(b, c)) or (years(m[4], c) and day_month(a, b))


class Ranks(dict):
    """Words and their ranks; knows its longest word."""

    def __init__(self, words: dict[str, int]):
        super().__init__(words)
        self.longest = max(map(len, words), default=0)


def _word_costs(value: str, ranks: Ranks) -> list[tuple[int, int, float]]:
    """(start, end, cost) of the parts that are words, turned round or with signs for letters."""
    lower, n = _lowered(value), len(value)
    plain = lower.translate(_SUBSTITUTES)
    swapped = [0]
    capitals = [0]
    for a, b, c in zip(lower, plain, value):
        swapped.append(swapped[-1] + (a != b))
        capitals.append(capitals[-1] + c.isupper())
    forms = [(lower, 0)] + ([(plain, 1)] if plain != lower else [])
    out = []
    for i in range(n):
        for j in range(i + 2, min(n, i + ranks.longest) + 1):
            best = None
            for form, is_plain in forms:
                part = form[i:j]
                for text, turned in ((part, 0), (part[::-1], 1)):
                    rank = ranks.get(text)
                    if rank:
                        upper = capitals[j] - capitals[i]
                        cased = 0 if not upper else 1 if upper in (1, j - i) else upper
                        swaps = (swapped[j] - swapped[i]) * is_plain
                        cost = math.log10(rank) + 0.3 * (cased + swaps + turned)
                        best = cost if best is None else min(best, cost)
            if best is not None:
                out.append((i, j, best))
    return out


def _lowered(value: str) -> str:
    """Lower case, character for character."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


def special_parts(value: str, ranks: dict[str, int]) -> list[tuple[int, int, float]]:
    """(start, end, cost) of the parts that are something else than brute force."""
    n, lower = len(value), _lowered(value)
    brute = math.log10(_charset(value))
    out = _word_costs(value, ranks if isinstance(ranks, Ranks) else Ranks(ranks))
    for i in range(n):
        if value[i].isdecimal():
            for j in range(i + 4, min(n, i + 10) + 1):
                if value[j - 1].isdecimal() and _is_date(value[i:j]):
                    out.append((i, j, math.log10(365 * 140) if j - i > 4 else math.log10(140)))
        # Steps of one up or down, as in abcd or 9876; all prefixes count.
        for step in (1, -1):
            j, end = i + 1, min(n, i + WALK)
            while j < end and ord(lower[j]) - ord(lower[j - 1]) == step and lower[j].isalnum():
                j += 1
            out += [(i, k, math.log10(2 * 26 * (k - i))) for k in range(i + 3, j + 1)]
        # Walks over neighbouring keys cost a start and a few turns.
        j, end, turns, move = i + 1, min(n, i + WALK), 0, None
        while j < end and lower[j] in _NEAR.get(lower[j - 1], ()):
            rows = [r for c in lower[j - 1:j + 1] for r, keys in enumerate(_KEYBOARD) if c in keys]
            now = (rows[1] - rows[0], lower[j] > lower[j - 1])
            turns, move = turns + (now != move), now
            j += 1
            if j - i >= 3:
                out.append((i, j, math.log10(47 * (j - i)) + turns * math.log10(6)))
    # The same unit again and again, as far as it goes.
    for unit in (1, 2, 3, 4):
        same = 0  # characters from i on that equal the one a unit later
        for i in range(n - unit - 1, -1, -1):
            same = same + 1 if value[i] == value[i + unit] else 0
            size = unit * (1 + same // unit)
            if size >= max(3, 2 * unit):
                out.append((i, i + size, unit * brute + math.log10(size // unit)))
    return out


def log_guesses(value: str, ranks: dict[str, int]) -> float:
    """Decimal logarithm of the guesses needed, by the cheapest segmentation.

    The cost of a segmentation is the sum of its parts' costs plus log10(k!) for the order
    of its k parts.  Row k of the dynamic programme holds the cheapest sums of each prefix in
    k parts.  A toll on every part, for several tolls, first gives segmentations (an upper
    bound) and lower bounds for every k, so that only the rows up to the last k that can
    still win are computed.
    """
    n = len(value)
    if not n:
        return 0.0
    brute = math.log10(_charset(value))
    answer = n * brute
    parts = special_parts(value, ranks)
    if not parts:
        return answer
    # By end; at each end the cheapest part of each start is enough.
    parts.sort(key=lambda p: (p[1], p[0], p[2]))
    starts = np.array([p[0] for p in parts])
    ends = np.array([p[1] for p in parts])
    costs = np.array([p[2] for p in parts])
    by_end: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in parts:
        by_end[j].append((i, cost))
    order = np.array([math.lgamma(k + 1) / math.log(10) for k in range(n + 1)])
    floor = np.zeros(n + 1)
    toll = 0.0
    for _ in range(12):
        total, k = _tolled(by_end, n, brute, toll)
        floor = np.maximum(floor, total - toll * np.arange(n + 1))
        answer = min(answer, total - toll * k + order[k])
        # The toll that the last part added would pay in the order of parts.
        following = math.log10(k)
        if abs(following - toll) < 1e-9:
            break
        toll = (toll + following) / 2
    winning = np.flatnonzero(floor[1:] + order[1:] < answer - 1e-12)
    most = int(winning[-1]) + 1 if len(winning) else 0
    position = np.arange(n + 1) * brute
    before = np.full(n + 1, np.inf)
    before[0] = 0.0
    first = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
    for k in range(1, most + 1):
        row = np.full(n + 1, np.inf)
        # Brute force from any earlier place; spans of it side by side never pay.
        row[1:] = np.minimum.accumulate(before - position)[:-1] + position[1:]
        special = np.minimum.reduceat(before[starts] + costs, first)
        row[ends[first]] = np.minimum(row[ends[first]], special)
        answer = min(answer, float(row[n] + order[k]))
        before = row
    return answer


def _tolled(by_end: list[list[tuple[int, float]]], n: int, brute: float,
            toll: float) -> tuple[float, int]:
    """Least sum of costs and tolls, and the number of parts that has it."""
    best, count = [0.0] * (n + 1), [0] * (n + 1)
    reach, via = math.inf, 0  # cheapest start of brute force so far
    for j in range(1, n + 1):
        if best[j - 1] - (j - 1) * brute < reach:
            reach, via = best[j - 1] - (j - 1) * brute, j - 1
        cost, k = reach + j * brute + toll, count[via] + 1
        for i, part in by_end[j]:
            if best[i] + part + toll < cost:
                cost, k = best[i] + part + toll, count[i] + 1
        best[j], count[j] = cost, k
    return best[n], count[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start and then kind."""
    spans = []
    lower = text.lower()
    if any(cue in lower for cue in _ASSIGN_CUES):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def all_spans(text: str | None, ranks: dict[str, int], least: float = MIN_LOG_GUESSES):
    """(kind, start, end, base, log guesses) of every span, by start and kind.

    A base assignment also carries the cost of its value; the other base kinds none.
    """
    text = text or ""
    spans = []
    for kind, a, b in base_spans(text):
        cost = None
        if kind == "assign":
            cost = log_guesses(_ASSIGN.match(text, a)[2], ranks)
        spans.append((kind, a, b, True, cost))
    lower = text.lower()
    if any(cue in lower for cue in _CONTEXT_CUES):
        for m in _CONTEXT.finditer(text):
            value = m[1].rstrip(_TRAILING)
            a, b = m.start(1), m.start(1) + len(value)
            if len(value) < 6 or any(a < s[2] and b > s[1] for s in spans):
                continue
            cost = log_guesses(value, ranks)
            if cost >= least:
                spans.append(("guess", a, b, False, cost))
    order = {k: i for i, k in enumerate((*KINDS, "guess"))}
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


def document_words(docs: DataFrame, text: str = "text", most: int = WORDS) -> list[str]:
    """Words of letters by the number of documents that hold them, most frequent first.

    The least number of documents that leaves at most ``most`` words is found from counts of
    counts, exact up to 4,096 and within one part in 2,048 beyond, so that the driver never
    sees more words than it keeps.
    """
    found = F.array_distinct(F.regexp_extract_all(
        F.lower(F.col(text)), F.lit(rf"(?<!\p{{L}})\p{{L}}{{3,{WORD_LETTERS}}}(?!\p{{L}})"), F.lit(0)))
    counts = stored(docs.select(F.explode(found).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= WORD_DOCS))
    # n without its bits after the leading twelve.
    extra = F.greatest(F.length(F.bin("n")) - 12, F.lit(0))
    coarse = counts.select(F.call_function(
        "shiftleft", F.call_function("shiftright", F.col("n"), extra), extra).alias("n"))
    least, kept = None, 0
    for row in coarse.groupBy("n").count().orderBy(F.desc("n")).collect():
        kept += row["count"]
        if kept > most:
            break
        least = row["n"]
    if least is None:
        return []
    rows = counts.where(F.col("n") >= least).collect()
    return [r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))]


def scan(docs: DataFrame, text: str = "text", out_col: str = "secrets",
         words: list[str] | None = None, least: float = MIN_LOG_GUESSES) -> DataFrame:
    """Add ``out_col``: kind, start, end, base, value and guess cost of each span.

    ``words`` is the attacker's dictionary, most frequent first; by default ``COMMON`` and then
    the words of the documents.
    """
    if words is None:
        words = COMMON + document_words(docs, text)
    ranks = Ranks(default_ranks(words))

    def batch(texts: list[str | None]) -> pd.DataFrame:
        rows = [all_spans(t, ranks, least) for t in texts]
        columns = ("kind", "start", "end", "base")
        frame = {c: [[s[i] for s in r] for r in rows] for i, c in enumerate(columns)}
        frame["value"] = [[(t or "")[s[1]:s[2]] for s in r] for t, r in zip(texts, rows)]
        frame["log_guesses"] = [[s[4] for s in r] for r in rows]
        return pd.DataFrame(frame)

    return annotate(docs, text, out_col, batch, SCHEMA)


def op6_secrets(spark, folder: str) -> DataFrame:
    """Secrets of every document: counts and digest of base spans, all spans."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", *digest_columns("secrets", KINDS))
