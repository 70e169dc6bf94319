"""Personal data: fixed formats by pattern, and a conditional random field for the rest.

E-mail addresses, IP addresses, card and phone numbers in their plain forms are found by
pattern and checked (``base_spans``).  A linear-chain conditional random field over word
shapes and cue words then finds names, national ids, and phone numbers and e-mail
addresses written in other ways.  It is trained from a small labelled table and decoded by
Viterbi in numpy over many lines at a time.  Its spans are added where no base span is.

A sequence is a line, cut after ``LONGEST`` words; texts are read whole whatever their
length.  Defined cases: a null text is an empty one; empty texts have no spans; among equally
good labellings the label first in ``LABELS`` wins; repeated rows give equal results; other
columns are untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import annotate, code_points, mix
from .spans import digest_columns

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "name", "national_id", "model_phone", "model_email")
SCHEMA = ("kind array<string>, start array<int>, end array<int>, base array<boolean>, "
          "value array<string>")
LONGEST = 256
CHUNK = 1 << 18

# The base patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Trying again inside a run of digits that failed could not succeed, so it is not tried.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# The labelled table, [label:words] marks personal data.
LABELLED = """
My name is [name:John Smith] and I live here.
Her name is [name:Maria Garcia] .
His name is [name:Peter] and he works there.
Please ask [name:Mr. Thomas Brown] about the order.
The letter was sent to [name:Mrs. Anna Keller] last week.
We met [name:Dr. Emily Clark] in the morning.
[name:Mr. Jones] is not in the office.
[name:Mrs. Weber] called twice.
[name:Dr. Martin Lopez] signed the form.
Contact person: [name:Julia Fischer]
Name: [name:Robert Miller]
Full name: [name:Sophie Martin Dubois]
Patient: [name:David Cohen]
Customer name: [name:Laura Rossi]
Signed by [name:Dr. Karl Braun] today.
You can call me at [model_phone:555-123-4567] tomorrow.
Call [model_phone:(499) 555-6503] for help.
Phone: [model_phone:(212) 555-0199]
Phone number: [model_phone:415-555-2671]
Tel: [model_phone:030 1234567]
Tel. [model_phone:089 5554321]
My mobile is [model_phone:0171 5551234] .
Mobile: [model_phone:600 123 456]
Please dial [model_phone:800.555.0123] now.
Fax: [model_phone:212.555.7788]
Reach us on [model_phone:(650) 555-9000] any time.
SSN: [national_id:123-45-6789]
My social security number is [national_id:987-65-4321] .
The ssn [national_id:321-54-9876] was leaked.
Social security: [national_id:555-12-3456]
Passport: [national_id:X1234567]
Passport number [national_id:C01234567] was issued.
Tax id: [national_id:12-3456789]
Write to [model_email:jane dot doe at example dot com] please.
My email is [model_email:bob at mail dot org] .
Email: [model_email:anna at example dot net]
Mail [model_email:info [at] example [dot] com] for details.
Email me: [model_email:tom (at) site (dot) de]
The name of the rose is a book.
In the end, The house was sold and The people left.
This is the best of all. The rest is there. It was with Them.
He is at home and she is at work on the dot.
What is The point of it? Is it in May or June? From Paris to Rome.
Call the function with the argument and email the result to the team.
The phone is broken and the fax is old.
There were 12 of them in 2019, and 1,250 in 2020.
Between 1990-1995 the price rose from 100 to 3,000 units.
Version 1.2.3 was released on 2020-01-15 at 10:30.
The total is 4711 and the code is 0815 for item 12345678.
Add 250 g of flour, 3 eggs and 1.5 l of milk to 20 units.
See page 12, lines 5-10, and chapter 3.
Order 100234 was sent on 12-05-2021 with 3 items at 19.99 each.
THIS IS ALL IN CAPITALS AND NOT A NAME.
Price: 300 Name: none Number: 5 Id: 7
token = abc123 and key = 9f8e7d6c
http://www.example.com/page?id=123456 is a link.
Numbers such as 555 and 123 or 4567 alone say little.
The patient customer was there and signed it.
Passport control is closed. Mobile homes are sold.
Released under the GNU General Public License, version 3.
Alpha Alpha Alpha Alpha Alpha Alpha
Of Of Of Of The The The The And And
Title | Author | Year | Place | Price
United States of America and The New York Times
BUY NOW!! ONLY TODAY!! GREAT PRICE!!
de la casa y el perro. Der Hund und Die Katze. Le chat et La table.
""".strip().split("\n")
_MARK = re.compile(r"\[(%s):((?:[^\[\]]|\[[a-z]+\])*)\]" % "|".join(LABELS[1:]))


# ---- base spans ------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.fullmatch(text, start - 1, at):
            # Doubling steps: a long run is read a few times, not once per character.
            step = 1
            while start - step > end and _LOCAL.fullmatch(text, max(end, start - 2 * step), start):
                step *= 2
            start = max(end, start - step)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four plain formats, by kind and start."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


# ---- words, shapes and cues --------------------------------------------------

_FACTOR = 0x9E3779B97F4A7C15 | 1
_TABLES: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash factor and of its inverse modulo 2^64."""
    if "up" not in _TABLES:
        for name, factor in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(CHUNK + 64, factor, dtype=np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For code points below 2^16: shape (1 upper, 2 lower, 3 digit, else 4 and up), lower case."""
    if "class" not in _TABLES:
        shape = np.arange(4, 0x10004, dtype=np.uint64)
        lower = np.arange(0x10000, dtype=np.uint64)
        for c in range(0x10000):
            s = chr(c)
            if s.isalpha():
                shape[c] = 1 if s.isupper() else 2
                if len(s.lower()) == 1:
                    lower[c] = ord(s.lower())
            elif s.isdecimal():
                shape[c] = 3
        shape[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0]] = 0
        _TABLES["class"], _TABLES["lower"] = shape, lower
    return _TABLES["class"], _TABLES["lower"]


@dataclass
class Words:
    """The words of a chunk: where their cores are, feature hashes, and their lines."""

    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    word: np.ndarray
    closes: np.ndarray
    line: np.ndarray


def words_of(points: np.ndarray) -> Words:
    """Words between white space.  Punctuation around a word is not part of its core."""
    classes, lowers = _classes()
    low = np.minimum(points, 0xFFFF)
    shape = classes[low]
    solid = shape != 0
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(np.uint64), none.astype(np.uint64),
                     none.astype(bool), none)
    place = np.arange(len(points))
    # 40 and 41 are round brackets, 43 plus, 91 and 93 square brackets.
    alnum = (shape >= 1) & (shape <= 3)
    opens = alnum | (low == 43) | (low == 40) | (low == 91)
    ends = alnum | (low == 41) | (low == 93)
    start = np.minimum.reduceat(np.where(opens, place, len(points)), first)
    end = np.maximum.reduceat(np.where(ends, place + 1, 0), first)
    core = (start < last) & (end > start)
    start, end = np.where(core, start, first), np.where(core, end, last)
    word_at = np.cumsum(edge[:-1] == 1) - 1
    inside = solid & (place >= start[word_at]) & (place < end[word_at])
    up, down = _powers()

    def hashed(codes: np.ndarray, keep: np.ndarray) -> np.ndarray:
        seat = np.cumsum(keep)
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(np.where(keep, codes * up[seat], np.uint64(0)), out=sums[1:])
        before = np.concatenate([[0], seat])[start]
        return mix((sums[end] - sums[start]) * down[before])

    letter = (shape == 1) | (shape == 2)
    again = np.zeros(len(points), dtype=bool)
    again[1:] = letter[1:] & (shape[1:] == shape[:-1]) & inside[:-1]
    # . ! ? : after the core, or a line's end, closes a phrase.
    closing = np.isin(low, (46, 33, 63)) & solid
    count = np.concatenate([[0], np.cumsum(closing)])
    lines = np.concatenate([[0], np.cumsum(low == 10)])[first]
    # Lines of more than LONGEST words go on as further sequences.
    rank = np.arange(len(first)) - np.flatnonzero(np.diff(lines, prepend=-1))[
        np.cumsum(np.diff(lines, prepend=-1) != 0) - 1]
    fresh = (rank % LONGEST == 0)
    return Words(start, end, hashed(shape, inside & ~again), hashed(lowers[low], inside),
                 count[last] - count[end] > 0, np.cumsum(fresh) - 1)


# ---- the random field --------------------------------------------------------

def _shifted(values: np.ndarray, line: np.ndarray, by: int, edge: int) -> np.ndarray:
    out = np.full(len(values), edge, dtype=values.dtype)
    if by < 0:
        out[-by:] = np.where(line[-by:] == line[:by], values[:by], edge)
    else:
        out[:-by] = np.where(line[:-by] == line[by:], values[by:], edge)
    return out


@dataclass
class Field:
    """Feature vocabularies (sorted hashes) and weights; row 0 is unknown, 1 a line's edge."""

    shapes: np.ndarray
    words: np.ndarray
    emission: list[np.ndarray]
    bias: np.ndarray
    step: np.ndarray

    def features(self, w: Words) -> list[np.ndarray]:
        def known(vocabulary, values):
            at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
            return np.where(vocabulary[at] == values, at + 2, 0)

        shape, word = known(self.shapes, w.shape), known(self.words, w.word)
        # What a closed phrase ends with is no cue for the next word.
        before = _shifted(np.where(w.closes & (w.end - w.start > 3), 1, word), w.line, -1, 1)
        return [shape, word, before, _shifted(word, w.line, 1, 1),
                _shifted(shape, w.line, -1, 1), _shifted(shape, w.line, 1, 1)]

    def scores(self, w: Words) -> np.ndarray:
        total = np.broadcast_to(self.bias, (len(w.start), len(LABELS))).copy()
        for weights, ids in zip(self.emission, self.features(w)):
            total += weights[ids]
        return total

    def labels(self, w: Words) -> np.ndarray:
        """Best labels of all words, by Viterbi over all lines of a chunk at once."""
        out = np.zeros(len(w.start), dtype=np.int8)
        if not len(out):
            return out
        scores = self.scores(w)
        # A label other than O can pay off in a line only if it does so for some word, even
        # with the best steps into and out of it: other lines are O throughout, exactly.
        spare = 2 * max(0.0, float(self.step.max() - self.step[0, 0]))
        gain = scores[:, 1:].max(axis=1) - scores[:, 0] + spare
        lines = np.unique(w.line[gain > 0])
        if not len(lines):
            return out
        chosen = np.flatnonzero(np.isin(w.line, lines))
        line = np.searchsorted(lines, w.line[chosen])
        head = np.searchsorted(line, np.arange(len(lines)))
        size = np.diff(np.append(head, len(line)))
        order = np.argsort(-size, kind="stable")
        k, longest = len(LABELS), int(size.max())
        best = scores[chosen[head[order]]]
        back = np.zeros((longest, len(lines), k), dtype=np.int8)
        ends = np.zeros((len(lines), k))
        alive = len(lines)
        for t in range(1, longest + 1):
            now = int(np.count_nonzero(size[order] > t))
            ends[now:alive] = best[now:alive]
            if not now:
                break
            through = best[:now, :, None] + self.step
            back[t, :now] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[chosen[head[order[:now]] + t]]
            alive = now
        label = ends.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            now = int(np.count_nonzero(size[order] > t))
            out[chosen[head[order[:now]] + t]] = label[:now]
            if t:
                label[:now] = back[t, np.arange(now), label[:now]]
        return out


def _parse(line: str) -> tuple[str, list[tuple[int, int, int]]]:
    text, spans, at = "", [], 0
    for m in _MARK.finditer(line):
        text += line[at:m.start()]
        spans.append((len(text), len(text) + len(m.group(2)), LABELS.index(m.group(1))))
        text, at = text + m.group(2), m.end()
    return text + line[at:], spans


def train(labelled: list[str] = LABELLED, rounds: int = 300, rate: float = 0.1,
          penalty: float = 0.02) -> Field:
    """Fit by gradient ascent on the penalised log likelihood, all sentences at once."""
    parsed = [_parse(line) for line in labelled]
    w = words_of(code_points("\n".join(text for text, _ in parsed)))
    starts = np.cumsum([0] + [len(text) + 1 for text, _ in parsed])
    gold = np.zeros(len(w.start), dtype=np.int64)
    for base, (_, spans) in zip(starts, parsed):
        for a, b, label in spans:
            gold[(w.start >= base + a) & (w.start < base + b)] = label
    k = len(LABELS)
    shapes, words = np.unique(w.shape), np.unique(w.word)
    sizes = [len(shapes) + 2, len(words) + 2, len(words) + 2, len(words) + 2,
             len(shapes) + 2, len(shapes) + 2]
    field = Field(shapes, words, [np.zeros((n, k)) for n in sizes], np.zeros(k), np.zeros((k, k)))
    ids = field.features(w)
    head = np.flatnonzero(np.diff(w.line, prepend=-1))
    size = np.diff(np.append(head, len(w.line)))
    longest = int(size.max())
    grid = np.minimum(head[:, None] + np.arange(longest), len(gold) - 1)
    real = np.arange(longest) < size[:, None]
    params = [*field.emission, field.bias, field.step]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def fold(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    for turn in range(1, rounds + 1):
        score = field.scores(w)[grid]
        alpha, beta = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            moved = fold(alpha[:, t - 1, :, None] + field.step, 1) + score[:, t]
            alpha[:, t] = np.where(real[:, t, None], moved, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = fold(field.step + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(real[:, t + 1, None], moved, 0)
        total = fold(alpha[:, -1], 1)
        share = np.exp(alpha + beta - total[:, None, None]) * real[..., None]
        flat = np.zeros((len(gold), k))
        flat[grid[real]] = share[real]
        error = np.eye(k)[gold] - flat
        pair = np.exp(alpha[:, :-1, :, None] + field.step + (score + beta)[:, 1:, None, :]
                      - total[:, None, None, None]) * real[:, 1:, None, None]
        steps = -pair.sum(axis=(0, 1))
        inner = np.flatnonzero(np.diff(w.line) == 0)
        np.add.at(steps, (gold[inner], gold[inner + 1]), 1)
        slopes = []
        for table, at in zip(field.emission, ids):
            slope = np.zeros_like(table)
            np.add.at(slope, at, error)
            slope[0] = 0  # unknown stays neutral
            slopes.append(slope)
        for i, (p, g) in enumerate(zip(params, [*slopes, error.sum(axis=0), steps])):
            g = g - penalty * p
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            p += rate * (first[i] / (1 - 0.9**turn)) / (
                np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8)
    return field


# ---- whole texts -------------------------------------------------------------

_DIGITS = {"national_id": (7, 12), "model_phone": (7, 15)}


def _plausible(kind: str, value: str) -> bool:
    digits = sum(c.isdecimal() for c in value)
    if kind in _DIGITS:
        return _DIGITS[kind][0] <= digits <= _DIGITS[kind][1]
    if kind == "model_email":
        return "dot" in value.lower() or "@" in value
    words = value.split()
    return (digits == 0 and any(c.isupper() for c in value) and len(words) <= 5
            and len(set(words)) == len(words) and "|" not in words)


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans of the random field in each text, by start."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    pending: list[tuple[int, int, np.ndarray]] = []
    room = CHUNK

    def flush():
        nonlocal pending, room
        if not pending:
            return
        bases = np.cumsum([0] + [len(p) + 1 for _, _, p in pending])
        newline = np.array([10], np.uint32)
        points = np.concatenate([x for _, _, p in pending for x in (p, newline)])
        w = words_of(points)
        label = field.labels(w)
        hit = np.flatnonzero(label)
        if len(hit):
            breaks = np.flatnonzero(
                (np.diff(hit) != 1) | (np.diff(label[hit]) != 0) | (np.diff(w.line[hit]) != 0))
            for run in np.split(hit, breaks + 1):
                a, b = int(w.start[run[0]]), int(w.end[run[-1]])
                piece = int(np.searchsorted(bases, a, side="right")) - 1
                owner, offset, _ = pending[piece]
                shift = offset - int(bases[piece])
                kind = LABELS[label[run[0]]]
                if _plausible(kind, texts[owner][a + shift:b + shift]):
                    found[owner].append((kind, a + shift, b + shift))
        pending, room = [], CHUNK

    for i, text in enumerate(texts):
        points = code_points(text)
        at = 0
        while at < len(points):
            stop = min(len(points), at + CHUNK - 1)
            if stop < len(points):
                # Cut after the last line end, else the last blank, else anywhere.
                for mark in (10, 32):
                    cut = np.flatnonzero(points[at:stop] == mark)
                    if len(cut):
                        stop = at + int(cut[-1]) + 1
                        break
            if stop - at + 1 > room:
                flush()
            pending.append((i, at, points[at:stop]))
            room -= stop - at + 1
            at = stop
    flush()
    return found


def all_spans(field: Field, texts: list[str | None]) -> list[list[tuple[str, int, int, bool]]]:
    """Base spans by kind and start, then the field's spans that touch none of them."""
    texts = [t or "" for t in texts]
    out = []
    for text, more in zip(texts, field_spans(field, texts)):
        base = base_spans(text)
        added = [s for s in more if all(s[2] <= a or s[1] >= b for _, a, b in base)]
        added.sort(key=lambda s: (LABELS.index(s[0]), s[1]))
        out.append([(*s, True) for s in base] + [(*s, False) for s in added])
    return out


def detect(docs: DataFrame, field: Field, text: str = "text", out_col: str = "pii") -> DataFrame:
    """Add ``out_col``: kind, start, end, whether by pattern, and value of each span."""

    def batch(texts: list[str | None]) -> pd.DataFrame:
        rows = all_spans(field, texts)
        return pd.DataFrame({
            "kind": [[s[0] for s in r] for r in rows],
            "start": [[s[1] for s in r] for r in rows],
            "end": [[s[2] for s in r] for r in rows],
            "base": [[s[3] for s in r] for r in rows],
            "value": [[(t or "")[s[1]:s[2]] for s in r] for t, r in zip(texts, rows)],
        })

    return annotate(docs, text, out_col, batch, SCHEMA)


def op8_pii(spark, folder: str) -> DataFrame:
    """Personal data of every document: counts and digest of base spans, all spans."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return detect(docs, train()).select("doc_id", *digest_columns("pii", KINDS))
