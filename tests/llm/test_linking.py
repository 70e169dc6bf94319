"""Linking without a group's pairs."""

import random

from pyspark.sql import functions as F

from textwarden.llm import common, near, pieces
from textwarden.llm import components as components_module
from textwarden.llm.components import components
from textwarden.llm.linking import link_components, shared_members


def test_pairs_tried_in_a_group_of_near_copies(spark):
    """2,000 near copies: at most one pair for each node and round, and one component."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for i in range(2000):
        words = list(base)
        for at in rng.sample(range(200), 2):
            words[at] = f"v{i}x{at}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    seen, real = [], near._verified

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return real(pairs, *rest)

    near._verified = counted
    try:
        rows = near.near_duplicates(docs, words=4).collect()
    finally:
        near._verified = real
    assert {r["component_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1
    assert sum(seen) <= 2000 * 4 and max(seen) <= 2000


def test_links_equal_all_pairs(spark):
    """Points on a line, linked when next to each other; bands are random groups of them."""
    rng = random.Random(7)
    points = {i: rng.randrange(400) for i in range(300)}
    bands = [(b, n) for b in range(120) for n in rng.sample(sorted(points), rng.choice([1, 2, 9, 40]))]
    by_band = {}
    for b, n in bands:
        by_band.setdefault(b, []).append(n)
    true = {(min(x, y), max(x, y)) for group in by_band.values() for x in group for y in group
            if x != y and abs(points[x] - points[y]) <= 1}
    members = shared_members(spark.createDataFrame(bands, "band int, node int").select(
        "band", F.col("node").cast("long").alias("node")))
    sides = spark.createDataFrame([(int(n), p) for n, p in points.items()], "node long, p int")

    def accept(pairs):
        return pairs.join(sides.toDF("a", "pa"), "a").join(sides.toDF("b", "pb"), "b").where(
            F.abs(F.col("pa") - F.col("pb")) <= 1).select("a", "b")

    for rounds in (0, 1, 4):
        got = link_components(members, sides, lambda x, y: F.abs(x("p") - y("p")), 20, accept, rounds)
        expected = components(spark.createDataFrame(sorted(true), "a long, b long"))
        parts = {r["node"]: r["component"] for r in got.collect()}
        assert {n: c for n, c in parts.items() if (n in {x for p in true for x in p})} == {
            r["node"]: r["component"] for r in expected.collect()}
        assert all(parts[n] == n for n in parts if n not in {x for p in true for x in p})


def test_encoding_with_several_threads(spark):
    """Threads change nothing, and one encoder serves all tasks of a worker."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(6)
    rows = lambda df: sorted((r["doc_id"], r["tokens"]["ids"], r["tokens"]["parity"], r["tokens"]["round_trip"])
                             for r in df.collect())
    assert rows(pieces.encode(docs, check=True, threads=4)) == rows(pieces.encode(docs, check=True, threads=1))


def test_few_pairs_of_near_copies_that_are_not_alike(spark):
    """Copies of one text with many words changed, most pairs of them less than 0.8 alike: only
    pairs that the odd bits leave open are verified, and the components are those of all pairs."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = []
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(300), rng.choice([2, 8, 9, 10, 11])):
            words[at] = f"v{i}x{at}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tried, real = [], near._verified

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return real(pairs, *rest)

    near._verified = counted
    try:
        got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs, words=4).collect()}
    finally:
        near._verified = real
    sets = [set(near.shingle_set(t, 4).tolist()) for t in texts]
    top = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= 80 * len(x | sets[j]) and top[i] != top[j]:
                low, high = sorted((top[i], top[j]))
                top = [low if t == high else t for t in top]
    assert [got[i] for i in range(len(sets))] == top
    assert sum(tried) <= 4 * len(sets) + 200


def test_odd_bits_never_exceed_the_difference():
    rng = random.Random(9)
    for size in (1, 30, 3000, 30000):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        changed = [w if rng.random() < 0.95 else "x" for w in words]
        one, two = near.shingle_set(" ".join(words), 4), near.shingle_set(" ".join(changed), 4)
        apart = len(set(one.tolist()) ^ set(two.tolist()))
        bits = sum(int(x).bit_count() for x in (near.odd_bits(one) ^ near.odd_bits(two)).view("u8"))
        assert bits <= apart


def test_the_last_step_carries_no_lists_of_bands(spark):
    """Rows of (band, node) are as many as the members: a list in each would be their square."""
    bands = [(b, n) for n in range(12) for b in range(8)]
    members = shared_members(spark.createDataFrame(bands, "band int, node long"))
    sides = spark.createDataFrame([(n, n % 3) for n in range(12)], "node long, p int")
    tried = []

    def accept(pairs):
        tried.append((pairs._jdf.queryExecution().optimizedPlan().toString(), pairs.collect()))
        return pairs

    parts = link_components(members, sides, lambda x, y: F.abs(x("p") - y("p")), 0, accept, rounds=0)
    ((plan, pairs),) = tried
    assert "collect_set" not in plan and "array" not in plan
    # Each pair once, however many bands it shares.
    assert sorted(map(tuple, pairs)) == [(a, b) for a in range(12) for b in range(a + 3, 12, 3)]
    assert {r["node"]: r["component"] for r in parts.collect()} == {n: n % 3 for n in range(12)}


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    """And narrow rows of a known number are written by few tasks."""
    written = []

    def counted(df, rows=None):
        out = common.stored(df, rows)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components_module, "stored", counted)
    stars = [(n, n % 5) for n in range(5, 400)] + [(6, 1), (1, 6)]
    links = spark.createDataFrame(stars, "a long, b long").repartition(60, "a")
    got = components(links, len(stars))
    assert {r["node"]: r["component"] for r in got.collect()} == {n: n % 5 for n in range(400)}
    assert len(written) == 1
    chain = spark.createDataFrame([(n, n + 1) for n in range(50)], "a long, b long")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = components(chain, 50).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert {tuple(r) for r in got} == {(n, 0) for n in range(51)} and len(got) == 51
    assert max(written) <= spark.sparkContext.defaultParallelism
