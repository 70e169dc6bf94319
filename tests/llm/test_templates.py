"""Names at the start of sentences, in both readings; results against a plain count."""

import random
import re

import pytest

from textwarden.llm import templates
from textwarden.llm.templates import contaminated

TOM = "Tom has 5 apples. Tom buys 7 more apples. How many apples does Tom have now?"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def found(spark, docs, items, **options):
    out = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_windows"], r["reparameterised"])
            for r in out.collect()}


def test_names_that_begin_sentences(spark):
    filler = "The weather was fine that week and nobody went home early. " * 20
    docs = [
        (1, TOM.replace("Tom", "Ann").replace("5", "8").replace("7", "9")),
        (2, filler + TOM.replace("Tom", "Ann").replace("5", "8") + " " + filler),
        (3, TOM), (4, TOM.lower()), (5, filler),
        # Two names for one: not the same question.
        (6, TOM.replace("Tom", "Ann", 1).replace("Tom buys", "Bob buys").replace("does Tom", "does Eve")),
    ]
    got = found(spark, docs, [(1, TOM)])
    assert {d for d, _ in got} >= {1, 2, 3}
    assert got[1, 1][2] and got[2, 1][2] and not got[3, 1][2]
    assert not {5, 6} & {d for d, _ in got}


def test_first_reading_still_finds_what_changes_case(spark):
    """Starts of sentences in another case match as words, as before."""
    item = "How many of the red boxes fit on the long shelf? Count them all before you answer."
    got = found(spark, [(1, item.replace("How", "how").replace("Count", "count"))], [(1, item)])
    n, of, changed = got[1, 1]
    assert n == of and not changed


def plain(doc, item, size=templates.WINDOW):
    """Best share of an item's windows in a short document, by hand and for both readings."""
    def tokens(text):
        out, end = [], None
        for m in re.finditer(r"[0-9]+|[A-Za-z]+", text):
            word = m[0]
            inside = end is not None and re.fullmatch(r",?[ ]{1,3}", text[end:m.start()])
            capital = re.match(r"[A-Z][a-z]", word) is not None
            kind = "num" if word[0].isdigit() else "inside" if capital and inside else \
                "start" if capital else "word"
            out.append((kind, word.lower()))
            end = m.end()
        return out

    best = 0.0
    for names in ({"inside"}, {"inside", "start"}):
        def parts(text):
            out = []
            toks = tokens(text)
            toks += [("pad", "")] * (size - len(toks))
            for at in range(len(toks) - size + 1):
                form = tuple("#" if k == "num" else "@" if k in names else w for k, w in toks[at:at + size])
                if any(f not in "#@" and f for f in form):
                    slots = [(w if f in "#@" and f else None) for f, (_, w) in zip(form, toks[at:at + size])]
                    out.append((at, form, slots))
            return out

        own, theirs = parts(item), parts(doc)
        n = len({f for _, f, _ in own})
        hits = [(a, b, f, s, t) for a, f, s in own for b, g, t in theirs if f == g]
        length = max(len(tokens(item)), size)
        places = {}
        for a, b, f, s, t in hits:
            d = b - a
            for place in ((0, d), (1, d // length), (2, (2 * d + length) // (2 * length)), (3, 0)):
                places.setdefault(place, []).append((f, s, t))
        for some in places.values():
            values = {}
            for _, s, t in some:
                for x, y in zip(s, t):
                    if x is not None:
                        values.setdefault(x, set()).add(y)
            bad = {f for f, s, _ in some if any(x is not None and len(values[x]) > 1 for x in s)}
            even = {f for f, s, _ in some} - bad
            best = max(best, len(even) / n if n else 0.0)
    return best


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_count(spark, seed):
    rng = random.Random(seed)
    words = ["Tom", "Ann", "buys", "has", "red", "apples", "How", "many", "5", "12", "the", "box"]
    ends = [" ", " ", " ", " ", ", ", ". ", "? "]

    def text(n):
        return "".join(rng.choice(words) + rng.choice(ends) for _ in range(n))

    items = [(i, text(rng.randint(3, 14))) for i in range(12)]
    swap = {"Tom": "Eve", "Ann": "Bob", "5": "77", "12": "3"}
    docs = []
    for i in range(60):
        base = rng.choice(items)[1]
        for a, b in swap.items():
            if rng.random() < 0.5:
                base = base.replace(a, b, rng.choice([1, -1, -1]))
        docs.append((i, text(rng.randint(0, 6)) + base + text(rng.randint(0, 6))))
    got = set(found(spark, docs, items))
    expected = {(d, i) for d, doc in docs for i, item in items if plain(doc, item) >= templates.SHARE}
    assert got == expected and expected
