"""Lexical search, fingerprint linking and phrases against plain computations."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textwarden.llm import catalog, lexical, phrases, simhash
from textwarden.llm.common import mix

FOLDER = "/root/testdata/sf0.001"
LONG = "word " * 60_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog, near the river bank", "en"),
    (2, "The quick brown fox jumps over the lazy dog, near the river bank", "en"),
    (2, "The quick brown fox jumps over the lazy dog, near the river bank", "en"),
    (3, "", "en"), (4, None, None), (None, "Der schnelle braune Fuchs", "de"),
    (5, LONG, None), (6, "x" * 300_000, "und"), (7, "Ä ä\t1\x0b!! \x00 \U0001F600", "de"),
]
CLASH = ["id", "n", "words", "m", "part", "rank", "score", "fp", "node", "k", "held"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("own") for c in CLASH})


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", ["op11_lexical_search", "op13_collocations"])
def test_queries_against_sql(spark, name):
    views = "".join(f"create view {t} as select * from '{FOLDER}/{t}.parquet';"
                    for t in ("documents", "benchmark"))
    con = duckdb.connect()
    con.execute(views)
    got = catalog.QUERIES[name](spark, FOLDER)
    expected = con.execute(f"select {', '.join(got.columns)} from ({catalog.ORACLES[name]})").fetchall()
    assert sorted(rows(got)) == sorted(expected) and expected


# ---- lexical search ----------------------------------------------------------------

def plain_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bags = [(i, Counter(split(t))) for i, t in docs if i is not None and split(t)]
    count, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(split(t))
    out = []
    for i, bag in asked.items():
        scored = []
        for doc, b in bags:
            m = 75 + 25 * sum(b.values()) * count // total
            s = sum(c * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in bag.items() if b[t])
            if s > 0:
                scored.append((-s, doc))
        out += [(i, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("unit, buffer, block", [(1 << 19, 1 << 23, 1 << 18), (40, 200, 30)])
def test_search_ranks_exactly(spark, unit, buffer, block):
    rng = random.Random(3)
    words = [f"W{i}" for i in range(60)]
    text = lambda n: " ".join(words[int(60 * rng.random() ** 3)] for _ in range(n))
    found = [(i, text(rng.choice([1, 5, 5, 20, 90]))) for i in range(300)]
    found += [(300, found[7][1]), (301, found[7][1]), (None, "W1"), (302, None), (303, "?!")]
    items = [(i, text(12)) for i in range(12)] + [(3, "W1 W1 w1"), (90, None), (91, "zzz"), (None, "W1")]
    got = lexical.search(
        spark.createDataFrame(found, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k=7, unit=unit, buffer=buffer, block=block)
    assert sorted(rows(got)) == plain_search(found, items, 7)


def test_search_skips_units(spark, tmp_path, monkeypatch):
    """Units whose bound is too low are not visited."""
    path = str(tmp_path / "visits")
    docs = [(i, "rare common " + "common " * (i % 40) if i < 30 else "common " * (1 + i % 40)) for i in range(2000)]
    real = lexical._Block.visit

    def noted(self, unit, at):
        with open(path, "a") as out:
            out.write("x")
        return real(self, unit, at)

    monkeypatch.setattr(lexical._Block, "visit", noted)
    items = spark.createDataFrame([(0, "rare")], "item_id long, text string")
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), items, k=5, unit=64)
    assert [r[2] for r in sorted(rows(got))] == [0, 1, 2, 3, 4]
    visits = len(open(path).read())
    assert 0 < visits < 30


def test_search_edges(spark, docs):
    items = spark.createDataFrame([(1, "quick FOX"), (2, None), (3, "ä 1")], "item_id long, text string").withColumn(
        "word", F.lit("own")).withColumn("score", F.lit(0))
    got = sorted(rows(lexical.search(docs, items)))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 1, 1), (1, 2, 2), (1, 3, 2), (3, 1, 7)]
    assert lexical.search(docs.where("false"), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0


# ---- fingerprints ------------------------------------------------------------------

def plain_fingerprint(text, words=3):
    found = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    k = min(words, len(found))
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i:i + k]), 42)
              for i in range(len(found) - k + 1)] if found else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    least = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(values):
            for j in range(i):
                if (x ^ values[j]).bit_count() <= 2 and least[i] != least[j]:
                    least[i] = least[j] = min(least[i], least[j])
                    changed = True
    return least


def test_simhash_query(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    expected = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, plain_components(prints))}
    assert {r[0]: r[1:] for r in rows(catalog.QUERIES["op12_simhash"](spark, FOLDER))} == expected


@pytest.mark.parametrize("crowd", [2, 8, 64])
def test_fingerprint_links_keep_every_component(spark, crowd):
    """Clouds of near fingerprints, chains of them and far ones, at any size of a crowd."""
    rng = random.Random(crowd)
    values = {0, (1 << 64) - 1}
    for size, flips in ((300, 4), (60, 2), (40, 7)):
        centre = rng.getrandbits(64)
        for _ in range(size):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            values.add(x)
    x = rng.getrandbits(64)
    for b in range(0, 60, 2):
        x ^= 3 << b
        values.add(x)
    values |= {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), crowd).distinct().collect()
    place = {v: i for i, v in enumerate(signed)}
    assert all((values[place[r["a"]]] ^ values[place[r["b"]]]).bit_count() <= 64 for r in got)
    joined = list(range(len(values)))

    def root(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for r in got:
        a, b = root(place[r["a"]]), root(place[r["b"]])
        joined[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(values))] == plain_components(values)


def test_pivots_discard_only_far_pairs():
    values = mix(np.arange(1, 200, dtype=np.uint64))
    values = np.concatenate([values, values ^ np.uint64(1 << 40), values ^ np.uint64(9)])
    reach = simhash.distances(values, simhash._PIVOTS).astype(int)
    apart = np.bitwise_count(values[:, None] ^ values[None, :]).astype(int)
    assert (np.abs(reach[:, None] - reach[None, :]).max(axis=2) <= apart).all()
    assert sum(simhash.blocks(0)) == (1 << 64) - 1
    assert sum(simhash.blocks(0xFF)) == (1 << 64) - 1 - 0xFF


def test_simhash_edges(spark, docs):
    got = rows(simhash.near_duplicates(docs))
    assert len(got) == len(ROWS)
    out = {r[0]: r for r in got}
    assert out[1][2] == 1 and out[2][2] == 1 and out[3] == (3, "0" * 16, 3) and out[4] == (4, "0" * 16, 3)
    assert out[None][2] is None and out[5][2] == 5 and out[6][2] == 6
    assert all(out[i][1] == f"{plain_fingerprint(t):016x}" for i, t, _ in ROWS)
    assert simhash.near_duplicates(docs.where("false")).count() == 0


# ---- phrases -----------------------------------------------------------------------

def plain_counts(docs, longest, least):
    seen, total = Counter(), Counter()
    for _, text, lang in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                seen.update((lang or "und", k, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    return sorted([(*key, n) for key, n in seen.items() if n >= least]
                  + [(lang, 0, "", n) for lang, n in total.items()])


@pytest.mark.parametrize("spare, chunk, longest", [(20, 1 << 19, 3), (-6, 500, 3), (-3, 2000, 4)])
def test_runs_are_counted_exactly(spark, spare, chunk, longest, monkeypatch):
    """Also with fingerprints so short that many runs share one."""
    monkeypatch.setattr(phrases, "RANGE", 2000)
    rng = random.Random(5)
    made = [(i, " ".join(f"w{int(30 * rng.random() ** 2)}" + rng.choice(["", "", ".", "\t"])
                         for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", None])) for i in range(200)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string").repartition(4)
    got = phrases.counts(df, longest=longest, least=3, chunk=chunk, spare=spare)
    assert sorted(rows(got)) == plain_counts(made, longest, 3)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in ([0], [5], [2 ** 64 - 1], [0, 1, 2 ** 64 - 1], rng.integers(0, 2 ** 63, 1000)):
        values = np.unique(np.array(values, dtype=np.uint64))
        assert (phrases.unpack(phrases.pack(values)) == values).all()


def test_longer_phrases_and_cuts(spark):
    text = "a b c d. " * 10 + "a b. " * 11 + "x a. " * 3
    df = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    got = {r["phrase"]: r for r in phrases.collocations(df, longest=4).collect()}
    assert set(got) == {"a b", "a b c d"}
    assert (got["a b"]["a"], got["a b"]["l"], got["a b"]["r"], got["a b"]["n"]) == (21, 24, 21, 68)
    assert got["a b"]["score"] == 10 ** 6 * 21 * 21 // (24 * 21)
    whole = got["a b c d"]
    assert (whole["a"], whole["l"], whole["r"]) == (10, 24, 10) and whole["score"] == 10 ** 6 * 100 // 240


def test_phrase_edges(spark, docs):
    got = rows(phrases.counts(docs, least=2))
    assert sorted(got) == plain_counts(ROWS, 3, 2)
    assert phrases.collocations(docs.where("false")).count() == 0
    assert {(r["lang"], r["phrase"]) for r in phrases.collocations(docs).collect()} == {("und", "word word word")}


def test_frequent_fingerprints_are_searched_in_order(monkeypatch):
    """Both sides of the search are sorted; phrases and counts are those of the text."""
    import pyarrow as pa

    from textwarden.llm import phrases

    words = (b"a b c . " * 30 + b"d a b . e f . ").split()
    runs = phrases.Runs(b" ".join(words), ["x"], [len(words)])
    answers = [phrases.pack(np.unique(runs.of(2)[1]))]
    batch = pa.RecordBatch.from_pydict({
        "langs": [["x"]], "lengths": [[len(words)]], "answers": pa.array([answers], pa.list_(pa.binary())),
        "data": [phrases.zlib.compress(b" ".join(words))]})

    class Chunks:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return list(run(iter([batch])))

    asked, search = [], np.searchsorted
    monkeypatch.setattr(phrases.np, "searchsorted", lambda a, v, *r, **k: asked.append(v) or search(a, v, *r, **k))
    out = phrases._written_out(Chunks(), 2, 64)
    assert asked and all((v[1:] >= v[:-1]).all() for v in asked)
    got = {(k, p): n for b in out for k, p, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))}
    assert got == {(0, ""): 95, (2, "a b"): 31, (2, "b c"): 30, (2, "d a"): 1, (2, "e f"): 1}
