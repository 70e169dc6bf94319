"""The methods against brute force, exact round trips or held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textwarden.llm import (
    catalog, language, lines, near, neighbours, pieces, pii, repeats, secret_scan, shingles,
    templates, toxicity,
)
from textwarden.llm.components import components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())


def result(spark, name):
    return catalog.QUERIES[name](spark, FOLDER).collect()


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


# ---- nearest neighbours ------------------------------------------------------------

def test_neighbours_recall_and_exact_scores(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{FOLDER}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = collections.defaultdict(list)
    for r in result(spark, "op1_nearest"):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        away = dict(zip(ids.tolist(), d))
        order = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(s == away[v] for _, v, s in found)
        assert found == sorted(found, key=lambda f: (f[2], f[1]))
        hits += len(set(order) & {v for _, v, _ in found})
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_split_lists_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0] if i % 3 else rng.normal(size=2).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {tuple(r) for r in neighbours.search(df, F.col("id") % 50 == 0).collect()}
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    assert {tuple(r) for r in neighbours.search(df, F.col("id") % 50 == 0).collect()} == whole


def test_graph_search_finds_nearest_centroids():
    rng = np.random.default_rng(2)
    index = neighbours.fit_sample(rng.normal(size=(4000, 8)), 128)
    x = rng.normal(size=(50, 8))
    found, _ = index.search(x, 8)
    true = np.argsort(neighbours._squares(x, index.centroids), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(found, true)]) > 7.5


# ---- decontamination -----------------------------------------------------------------

def test_whole_items_are_found_and_no_others(spark, texts):
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    want = {(d, i) for d, t in texts.items() for i, x in items if x in (t or "")}
    assert {(r["doc_id"], r["item_id"]) for r in result(spark, "op2_decontamination")} == want


def test_reparameterised_questions(spark):
    ask = "If {} has {} apples and buys {} more apples at {} km, how many does {} have now?"
    docs = spark.createDataFrame([
        (1, "Text before. " + ask.format("Tom", 5, 7, 3, "Tom") + " Text after."),
        (2, ask.format("Ann", 8, 9, 4, "Ann")), (3, ask.format("Ann", 8, 9, 4, "Bob")),
        (4, "If you have apples, buy more apples and tell me how many you have now."),
    ], "doc_id long, text string")
    items = spark.createDataFrame([(1, ask.format("Tom", 5, 7, 3, "Tom"))], "item_id long, text string")
    got = {r["doc_id"]: r["reparameterised"] for r in templates.contaminated(docs, items).collect()}
    assert got == {1: False, 2: True}


def test_decontamination_is_native(spark):
    plan = catalog.QUERIES["op2_decontamination"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- SentencePiece ---------------------------------------------------------------------

def test_encoder_agrees_with_reference_on_whole_texts(texts):
    encoder = pieces.Encoder(pieces._model_bytes(pieces.MODEL_PATH))
    odd = ["", " ", "  a  b ", "tab\tline\n", "日本語 \U0001F600", "<s> </s> <0x41>", "a" * 5000, "x  "]
    batch = list(texts.values()) + odd
    want = encoder.reference.encode(batch)
    got = encoder.encode(batch)
    assert [g.tolist() for g, _ in got] == want and all(same for _, same in got)
    assert encoder.decode([g for g, _ in got]) == batch
    # Without the word cache, and with one that overflows all the time.
    small = pieces.Encoder(encoder.model.raw, cache=10)
    assert [g.tolist() for g, _ in small.encode(batch[-20:])] == want[-20:]
    small.by_words = False
    assert [g.tolist() for g, _ in small.encode(batch[-20:])] == want[-20:]


def test_unigram_model_is_rebuilt():
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def part(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    import struct
    pieces_ = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces_ += [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]
    pieces_ += [("▁", -3.0, 1), ("▁he", -2.0, 1), ("llo", -2.5, 1), ("l", -4.0, 1), ("o", -4.0, 1),
                ("▁hel", -3.0, 1), ("lo", -3.2, 1), ("h", -5.0, 1), ("e", -5.0, 1)]
    raw = b"".join(
        part(1, part(1, p.encode()) + varint(2 << 3 | 5) + struct.pack("<f", s) + varint(3 << 3) + varint(k))
        for p, s, k in pieces_)
    raw += part(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1))
    raw += part(3, part(1, b"identity") + b"".join(
        varint(n << 3) + varint(v) for n, v in ((3, 1), (4, 0), (5, 1))))
    encoder = pieces.Encoder(raw)
    assert encoder.model.kind == pieces.UNIGRAM and encoder.model.byte_fallback
    batch = ["hello hello", "hel lo", "h€llo", "lol", ""]
    assert [g.tolist() for g, _ in encoder.encode(batch)] == encoder.reference.encode(batch)
    assert encoder.decode([g for g, _ in encoder.encode(batch)]) == batch


# ---- toxicity ------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = catalog.QUERIES["op4_toxicity"](spark, folder).collect()
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{folder}/labels.parquet'").fetchall())
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in held)
    assert right >= 0.95 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_block_max_search_is_exact():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    counts = [collections.Counter(rng.choices(words, k=12)) for _ in range(500)]
    labels = np.array([int(c["w0"] + c["w1"] + c["w2"] > 1) for c in counts])
    model = toxicity.train(np.arange(500) * 3, counts, labels, 0.3)
    dense = np.zeros((500, len(model.terms)))
    for i, c in enumerate(counts):
        t, w = model.vector_of(c)
        dense[i, t] = w
    for c in counts[:60]:
        t, w = model.vector_of(c)
        at, sim = model.nearest(t, w)
        truth = dense[:, t] @ w if len(t) else np.zeros(500)
        order = [i for i in np.lexsort((model.ids, -np.round(truth, 12))) if truth[i] > 0][:25]
        assert np.allclose(sim, truth[order]) and np.allclose(sim, truth[at])


# ---- repeats ----------------------------------------------------------------------------------

def test_suffix_array_order():
    for n in (1, 2, 50, 2000):
        for k in (1, 2, 5, 200):
            t = np.random.default_rng(n * k).integers(0, k, n).astype(np.uint8)
            order = repeats.suffix_array(t, repeats._words(t)).tolist()
            data = t.tobytes()
            assert sorted(order) == list(range(n))
            assert all(data[a:a + 50] <= data[b:b + 50] for a, b in zip(order, order[1:]))


def cut(texts):
    low, data = {}, {d: (t or "").encode() for d, t in texts.items()}
    for d, b in data.items():
        for i in range(len(b) - 49):
            low[b[i:i + 50]] = min(low.get(b[i:i + 50], d), d)
    for d, b in data.items():
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 49):
            if low[b[i:i + 50]] < d:
                gone[i:i + 50] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield d, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


def test_repeats_brute_force(spark, texts):
    assert {tuple(r) for r in result(spark, "op5_repeats")} == set(cut(texts))


def test_hot_key_in_pieces(monkeypatch):
    """One passage in very many documents, with a buffer of a few segments."""
    passage = "All rights of this passage are reserved by nobody in particular, so it says here."
    texts = {i: f"{random.Random(i).random()} {passage[i % 9:]} {random.Random(-i).random()}"
             for i in range(60)}
    rows = []
    for i, t in texts.items():
        data = t.encode()
        for k, s, n in zip(*repeats.segments(data)):
            rows.append((k, i, s, data[s:s + n + 49]))
    import pandas as pd
    frame = pd.DataFrame(rows, columns=["key", "id", "start", "bytes"]).sort_values(["key", "id", "start"])

    def removed():
        out = collections.defaultdict(set)
        for f in repeats._scan(iter([frame])):
            for r in f.itertuples():
                out[int(r.id)] |= set(range(int(r.start), int(r.start + r.count)))
        return dict(out)

    whole = removed()
    real = repeats.pd.DataFrame.__len__
    monkeypatch.setattr(repeats, "BUFFER", 300)
    pieces_ = iter([frame.iloc[i:i + 3] for i in range(0, real(frame), 3)])
    out = collections.defaultdict(set)
    for f in repeats._scan(pieces_):
        for r in f.itertuples():
            out[int(r.id)] |= set(range(int(r.start), int(r.start + r.count)))
    assert dict(out) == whole and whole


# ---- secrets and personal data -------------------------------------------------------------------

def base_secrets(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, ("assign", *m.span())))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, ("access", *m.span())))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, ("hex", *m.span())))
    return [s for _, _, s in sorted(out)]


def base_private(t):
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub(r"\D", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


@pytest.mark.parametrize("name, rule, scan, alphabet", [
    ("op6_secrets", base_secrets, secret_scan.base_spans,
     ["token", "api_key", "API_KEY", "secret", " ", ":", "=", "'", '"', "abcdef01", "AKIA", "Z9", "é",
      "ſecret", "g", "0a" * 16, "-", "AKIAAAAABBBBCCCC"]),
    ("op8_pii", base_private, pii.base_spans, list("a.@-+1234567890 (é") + ["4111 1111 1111 1111"]),
])
def test_base_spans(spark, texts, name, rule, scan, alphabet):
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert scan(t) == rule(t), t
    for r in result(spark, name):
        t = texts[r["doc_id"]] or ""
        assert r["base_sha256"] == digest(rule(t))
        assert {f"{k}:{a}:{b}" for k, a, b in rule(t)} <= set(filter(None, r["spans"].split(",")))


def test_guess_costs():
    cost = lambda v: secret_scan.log_guesses(v, secret_scan.default_ranks())
    cheap = ["password1", "qwertyuiop", "2021-05-06", "aaaaaaaaaa", "abcdefgh", "p@ssw0rd", "drowssap"]
    assert all(cost(v) < secret_scan.MIN_LOG_GUESSES for v in cheap)
    assert all(cost(v) > 12 for v in ["xK9#mQ2$vL", "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"])
    assert cost("") == 0 and cost("ab") <= 2 * np.log10(26) + 1e-9
    kinds = lambda t: [s[0] for s in secret_scan.all_spans(t, secret_scan.default_ranks())]
    assert kinds("my password is xK9#mQ2$vL now") == ["guess"]
    assert kinds("login: hunter2!") == [] and kinds("pwd = qwertyuiop") == []


def test_random_field():
    field = pii.train()
    cases = {
        "my name is Alice Cooper.": [("name", "Alice Cooper")],
        "please call (499) 555-6503 now": [("model_phone", "(499) 555-6503")],
        "his SSN: 222-33-4444": [("national_id", "222-33-4444")],
        "The house was sold and the people left.": [], "": [],
    }
    for text, want in cases.items():
        assert [(k, text[a:b]) for k, a, b in pii.field_spans(field, [text])[0]] == want
    # Batched decoding, with lines skipped, is the same as full decoding line by line.
    batch = [pii._parse(line)[0] for line in pii.LABELLED]
    together = pii.field_spans(field, ["\n".join(batch)])[0]
    alone, at = [], 0
    for text, spans in zip(batch, pii.field_spans(field, batch)):
        alone += [(k, a + at, b + at) for k, a, b in spans]
        at += len(text) + 1
    assert together == alone


def test_viterbi_against_all_paths():
    import itertools
    field = pii.train()
    w = pii.words_of(pii.code_points("Call Dr. Ann at 555-123-4567"))
    scores = field.scores(w)
    best = max(itertools.product(range(len(pii.LABELS)), repeat=len(scores)), key=lambda p: sum(
        scores[i, y] for i, y in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:])))
    assert tuple(field.labels(w)) == best


# ---- near duplicates and lines ---------------------------------------------------------------------

def groups(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_near_duplicates_brute_force(spark, texts):
    base = "one two three four five six seven eight nine ten".split()
    rng = random.Random(5)
    rows = dict(texts)
    for i in range(120):
        words = base * 6
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows[10_000 + i] = " ".join(f"{w}{j // 10}" for j, w in enumerate(words))
    sets = {}
    for d, t in rows.items():
        lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", lower)
        sets[d] = {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in near.near_duplicates(df, words=4).collect():
        d = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[d]), want[d], want[d] == d)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    one, two = near.sketch(np.unique(x[:800])), near.sketch(np.unique(x[100:]))
    assert (one != np.iinfo(np.uint64).max).all()
    assert abs((one == two).mean() - 700 / 900) < 0.08
    assert (near.sketch(x[:1]) != np.iinfo(np.uint64).max).all()


def test_shingles_of_pieces(monkeypatch):
    text = "Äb CD\te\x0bf  ghij " * 40
    whole = shingles.shingle_set(text, 3)
    monkeypatch.setattr(shingles, "_PIECE", 7)
    assert np.array_equal(shingles.shingle_set(text, 3), whole)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (60, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = groups({n for p in links for n in p if p[0] != p[1]}, [p for p in links if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines_brute_force(spark, texts):
    rows = dict(list(sorted(texts.items()))[:60])
    line = "this is a rather common line of some sixty characters in it"
    rows[9001], rows[9002] = f"{line}\nother text", f"own words here\n{line.upper()}!!\n{line}"
    rows[9003] = line.replace("sixty", "sixti")
    first = {}
    for d, t in sorted(rows.items()):
        for p, text in enumerate(t.split("\n")):
            n = lines.normal(text)
            if len(n) >= lines.LEAST:
                first.setdefault(n, (d, p))
    names = list(first)

    # An edit changes two runs of two characters in each line at most.
    grams = [collections.Counter(x[i:i + 2] for i in range(len(x) - 1)) for x in names]
    pairs = [(i, j, names[i], names[j]) for i in range(len(names)) for j in range(i + 1, len(names))
             if 4 * max(len(names[i]), len(names[j])) <= 5 * min(len(names[i]), len(names[j]))
             and sum(((grams[i] - grams[j]) | (grams[j] - grams[i])).values())
             <= 0.8 * max(len(names[i]), len(names[j])) + 1e-9]
    pairs = pd.DataFrame(pairs, columns=["i", "j", "a", "b"])
    links = duckdb.sql("select i, j from pairs where levenshtein(a, b)"
                       " <= 0.2 * greatest(length(a), length(b)) + 1e-9").fetchall()
    owner = {}
    for i, top in groups(range(len(names)), links).items():
        owner[top] = min(owner.get(top, ((10**9, 0), 0)), (first[names[i]], i))
    keep = {names[i]: place for place, i in owner.values()}
    want = {d: "\n".join(x for p, x in enumerate(t.split("\n"))
                         if len(lines.normal(x)) < lines.LEAST or keep.get(lines.normal(x)) == (d, p))
            for d, t in rows.items()}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in lines.deduplicate(df).collect()} == want
    assert want[9002] == "own words here"


# ---- language ---------------------------------------------------------------------------------------

def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"select doc_id, lang from '{folder}/documents.parquet'").fetchall())
    rows = catalog.QUERIES["op9_language_id"](spark, folder).collect()
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_language_reads_long_texts_in_pieces(monkeypatch):
    text = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich. " * 30
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "PIECE", 37)
    assert np.array_equal(language.gram_counts(text), whole)


def test_near_duplicates_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    want = con.execute(catalog.ORACLES["op7_near_duplicates"]).fetchall()
    assert {tuple(r) for r in result(spark, "op7_near_duplicates")} == set(want)


def test_lines_recall_against_edit_similarity(spark):
    """All lines of the given table against edit similarity alone, without SimHash or blocks."""
    found = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    names = {lines.normal(x) for t, in found for x in (t or "").split("\n")}
    names = sorted((n for n in names if len(n) >= 5), key=lambda n: (len(n), n))
    size = np.array([len(n) for n in names])
    # An edit changes two runs of two characters in each line at most: a bound for all pairs.
    runs = np.zeros((len(names), 1024), np.int16)
    for i, n in enumerate(names):
        points = lines.code_points(n).astype(np.int64)
        runs[i] = np.bincount((points[:-1] * 31 + points[1:]) % 1024, minlength=1024)
    pairs = []
    for i in range(len(names)):
        stop = np.searchsorted(size, size[i] / 0.8 + 1e-6, "right")
        gap = np.abs(runs[i + 1:stop] - runs[i]).sum(axis=1)
        near = np.flatnonzero(gap <= 4 * np.floor(0.2 * size[i + 1:stop] + 1e-9))
        pairs += [(i, i + 1 + int(j)) for j in near]
    text = spark.createDataFrame(pd.DataFrame({"i": range(len(names)), "line": names}))
    both = spark.createDataFrame(pd.DataFrame(pairs, columns=["a", "b"])).repartition(64).join(
        text.toDF("a", "la"), "a").join(text.toDF("b", "lb"), "b")
    truth = [(r["a"], r["b"]) for r in both.where(
        "levenshtein(la, lb, cast(floor(0.2D * length(lb) + 1e-9D) as int)) >= 0").collect()]
    nodes = {i for pair in truth for i in pair}
    want = {i for i, top in groups(nodes, truth).items() if i != top}
    df = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    gone = {r["doc_id"] for r in lines.deduplicate(df).where("text = ''").collect()}
    assert gone <= want and len(gone) >= 0.95 * len(want) >= 100


def test_the_count_bound_loses_no_pair():
    rng = np.random.default_rng(6)
    letters = list("abcd ")
    rows = []
    for size in rng.integers(1, 40, 300):
        one = "".join(rng.choice(letters, size))
        two = list(one)
        for _ in range(rng.integers(0, 12)):
            at = int(rng.integers(0, len(two) + 1))
            two[at:at + int(rng.integers(0, 2))] = rng.choice(letters, int(rng.integers(0, 2))).tolist()
        rows.append((len(rows), -1, one, "".join(two)))
    frame = pd.DataFrame(rows, columns=["a", "b", "la", "lb"])
    close = {r[0] for r in duckdb.sql(
        "select a from frame where levenshtein(la, lb) <= floor(0.2 * greatest(length(la), length(lb)) + 1e-9)"
    ).fetchall()}
    got = set(pd.concat(lines._possible(0.8)(iter([frame])))["a"])
    assert close <= got and len(got) < len(rows) and len(close) > 30


def _recall(change):
    """Share of lines that meet and pass the estimate with a changed copy of themselves."""
    found = duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    names = sorted({lines.normal(x) for t, in found for x in (t or "").split("\n")})
    rng = np.random.default_rng(4)
    names = [n for n in names if len(n) >= 40 and " " in n]
    names = [names[i] for i in rng.choice(len(names), 1000, replace=False)]
    code, blocks = lines.describe(names + [change(n, rng) for n in names])
    gap = np.bitwise_count(code[:1000] ^ code[1000:])
    return np.mean([bool(set(blocks[i]) & set(blocks[1000 + i])) and gap[i] <= lines.DISTANCE
                    for i in range(1000)])


def _letters_changed(share):
    def change(line, rng):
        out = list(line)
        for i in rng.choice(len(out), max(1, int(share * len(out))), replace=False):
            out[i] = chr(97 + rng.integers(26))
        return "".join(out)
    return change


def _word_changed(line, rng):
    words = line.split(" ")
    words[rng.integers(len(words))] = "other"
    return " ".join(words)


def test_lines_recall_of_edits():
    found = {name: _recall(change) for name, change in {
        "word": _word_changed, 0.02: _letters_changed(0.02), 0.05: _letters_changed(0.05),
        0.1: _letters_changed(0.1), 0.15: _letters_changed(0.15)}.items()}
    # Letters changed here and there leave few pieces whole: the README states these figures.
    assert found["word"] >= 0.9 and found[0.02] >= 0.8 and found[0.05] >= 0.5


def test_a_block_larger_than_memory_goes_on_whole(monkeypatch):
    """Blocks cut by frames are compared as one; those beyond the bound are all kept."""
    rng = np.random.default_rng(2)
    band = np.sort(np.r_[rng.integers(0, 300, 1000), np.full(80, 7), np.full(500, 301)])
    code = rng.integers(0, 1 << 62, len(band))
    code[1::3] = code[0:len(band) - 1:3][:len(code[1::3])] ^ 5
    frame = pd.DataFrame({"band": band, "node": range(len(band)), "s": code, "size": 50})
    monkeypatch.setattr(lines, "HELD", 200)
    parts = [frame.iloc[i:i + 37] for i in range(0, len(frame), 37)]
    got = pd.concat(lines._with_a_match(0.8)(iter(parts)))
    want = {i for i in range(len(band)) for j in range(len(band))
            if i != j and band[i] == band[j]
            and np.bitwise_count(code[i] ^ code[j]) <= lines.DISTANCE}
    hot = set(np.flatnonzero(band == 301).tolist())
    assert len(got) == got["node"].nunique() and set(got["node"]) == want | hot


def test_short_lines_are_deduplicated(spark):
    rows = [(1, "own words\nAll rights reserved.\nok"), (2, "ALL RIGHTS RESERVED\n\n---\nOK!"),
            (3, "all rights reservd\nno\n---"), (4, "你好世界\n版权所有"), (5, "版权所有。\n\nother")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate(df).collect()}
    assert got == {1: rows[0][1], 2: "\n---", 3: "no\n---", 4: rows[3][1], 5: "\nother"}


def test_neighbours_beyond_the_lists_read(spark):
    """Rows of the sample that set a query's bound are answers even if its lists lack them."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.Counter(r["query_id"] for r in neighbours.search(df, F.col("id") % 50 == 0).collect())
    assert set(got.values()) == {10} and len(got) == 60


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, 0.001 * i]) for i in range(1, 13)]
    rows += [(i, [1.0, float(i)]) for i in range(2, 14)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = neighbours.Index(np.array([[1.0, 0.0]]), np.zeros((1, 1), dtype=int), np.inf)
    vectors = neighbours._valid(df, "vec_id", "embedding")
    got = neighbours.nearest(vectors.where("id = 0"), neighbours.build(vectors, index), index)
    assert [r["vec_id"] for r in got.orderBy("rank").collect()] == list(range(1, 11))


def test_copies_are_judged_one_by_one(spark):
    ask = "If {} has {} apples and buys {} more apples at {} km, how many does {} have now?"
    item = ask.format("Tom", "1,200", "2.5", 3, "Tom")
    docs = spark.createDataFrame([
        (1, item + " Then " + ask.format("Ann", 8, 9, 4, "Ann")),
        (2, " Next: ".join(ask.format(n, i, i + 3, i + 5, n) for i, n in enumerate(("Ann", "Bob", "Eve")))),
        (3, item + " word" * 300 + " He has 7 apples and buys 6 more apples at 9 km."),
        (4, item.replace("more", "some more") + " So " + ask.format("Ann", 8, 9, 4, "Ann").replace("more", "many more")),
        (5, ask.format("Ann", "12", "7", 4, "Bob") + " Next: " + ask.format("Bob", 1, 2, 4, "Ann")),
    ], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["reparameterised"] for r in templates.contaminated(docs, items, share=0.7).collect()}
    # A smaller share, for a word put into each copy.
    assert {i: got[i] for i in (1, 2, 3, 4)} == {1: False, 2: True, 3: False, 4: False}
    got = {r["doc_id"] for r in templates.contaminated(docs, items).collect()}
    assert got == {1, 2, 3}


def test_letters_in_one_case_are_scored(spark):
    rows = [(1, "pwd: qzxvkwpjmtrb"), (2, "the passphrase is HGTRQWPLMZ"), (3, "password is required here")]
    rows += [(10 + i, "what is required is written down") for i in range(secret_scan.WORD_DOCS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["secrets"]["value"] for r in secret_scan.scan(df).collect()}
    assert {i: v for i, v in got.items() if v} == {1: ["qzxvkwpjmtrb"], 2: ["HGTRQWPLMZ"]}
