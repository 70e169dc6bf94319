"""Ranked lexical search over an index of strata of equal length normaliser.

A document of n terms has the normaliser m = 75 + 25 * n * N div L (N documents with terms, L
terms in all).  With m fixed, what a term adds to a score depends on its occurrences tf only,
apart from the term's weight; so documents are grouped into strata of equal m, a stratum keeps
its postings by term and tf, and impacts are computed once for each tf in it.

``index`` writes one row per unit.  A stratum is one unit, or several if its postings exceed
``UNIT``; which one a document is in depends on its id.  Tasks read units and hold at most
``BUFFER`` postings of them at a time.  An item's bound in a unit is its score if every term
had its largest impact there.  Each item visits the buffered units in falling order of its
bounds and stops at the first below its ``k``-th best score.  The first pass lets each item
visit its best unit of each buffer only; the k-th best scores so found start the second pass,
which visits every other unit that its bound does not rule out.  Results are exact.

Items go to the tasks in blocks of at most ``BLOCK`` terms each (or one item); so do
thresholds, one number per item of a block.

Defined cases: documents without terms (null or empty text) are no documents of the index;
rows with a null id take no part; rows of one document id are documents of their own; rows
of one item id are one item with the terms of all of them, and items without known terms have
no rows; equal scores go by smaller id; an empty table gives no rows; texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

UNIT = 1 << 19
BUFFER = 1 << 23
BLOCK = 1 << 18
_FLAT = 1 << 18

# Fixed value: what terms consist of; only A-Z are lower-cased.
_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_BYTES = bytes(c if c in _TERM else 32 for c in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _described(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, words, tfs) of each row with terms; words are joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, words, tfs, ends = [], [], [], [], [0]
            for key_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms(value)
                if not found:
                    continue
                counts = Counter(found)
                ids.append(key_)
                n.append(len(found))
                words.append(b" ".join(counts))
                tfs.extend(counts.values())
                ends.append(len(tfs))
                if len(tfs) >= _FLAT:
                    yield out(ids, n, words, tfs, ends)
                    ids, n, words, tfs, ends = [], [], [], [], [0]
            yield out(ids, n, words, tfs, ends)

    def out(ids: list, n: list, words: list, tfs: list, ends: list) -> pa.RecordBatch:
        offsets = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
            pa.array(words, pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
        ], names=["id", "n", "words", "tfs"])

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.where("id is not null and text is not null").mapInArrow(
        run, "id long, n long, words string, tfs array<int>")


_UNIT_ROW = ("m long, part int, docs array<long>, words array<string>, first array<int>, "
             "tfs array<long>, ends array<int>, postings array<int>")


def _packed(m: int, part: int, ids: list, words: list[str], tfs: list) -> pa.RecordBatch:
    """One unit: per word its groups of equal tf, per group its documents."""
    order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
    sizes = np.array([len(t) for t in tfs], dtype=np.int64)
    place = np.empty(len(ids), dtype=np.int32)
    place[order] = np.arange(len(ids), dtype=np.int32)
    doc = np.repeat(place, sizes)
    tf = np.concatenate([t.to_numpy() for t in tfs]).astype(np.int64)
    coded = pc.split_pattern(pa.array(words, pa.large_string()), " ").flatten().cast(
        pa.string()).dictionary_encode()
    code = coded.indices.to_numpy()
    by = np.lexsort((doc, tf, code))
    doc, tf, code = doc[by], tf[by], code[by]
    edge = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])]))
    first = np.searchsorted(code[edge], np.arange(len(coded.dictionary) + 1))
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays([
        pa.array([m], pa.int64()), pa.array([part], pa.int32()),
        one(np.array(ids, dtype=np.int64)[order], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
        one(first.astype(np.int32), pa.int32()), one(tf[edge], pa.int64()),
        one(np.append(edge[1:], len(doc)).astype(np.int32), pa.int32()), one(doc, pa.int32()),
    ], names=["m", "part", "docs", "words", "first", "tfs", "ends", "postings"])


def _units(described: DataFrame, documents: int, total: int, unit: int) -> DataFrame:
    """The index: a row for each unit of a stratum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, words, tfs = None, [], [], []
        for batch in batches:
            m, part, doc = (batch.column(i).to_pylist() for i in range(3))
            for row in range(batch.num_rows):
                if at != (m[row], part[row]):
                    if ids:
                        yield _packed(*at, ids, words, tfs)
                    at, ids, words, tfs = (m[row], part[row]), [], [], []
                ids.append(doc[row])
                words.append(batch.column(3)[row].as_py())
                tfs.append(batch.column(4)[row].values)
        if ids:
            yield _packed(*at, ids, words, tfs)

    rows = described.withColumn(
        "m", F.expr(f"75 + cast((25 * cast(n as decimal(19,0)) * {documents}) div {max(total, 1)} as long)"))
    # Written first, so that its size is known when the join is planned; few strata are large.
    parts = stored(rows.groupBy("m").agg(
        F.ceil(F.sum(F.size("tfs")) / F.lit(unit)).cast("int").alias("parts")).where("parts > 1"))
    return (rows.join(parts, "m", "left")
            .withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
            .select("m", "part", "id", "words", "tfs")
            .repartition("m", "part").sortWithinPartitions("m", "part", "id")
            .mapInArrow(run, _UNIT_ROW))


class _Unit:
    """A unit as a task holds it: the postings of a block's terms, impacts once per tf."""

    def __init__(self, row: dict[str, pa.Scalar], known: pa.Array) -> None:
        m = row["m"].as_py()
        get = lambda name: row[name].values.to_numpy()
        self.docs = get("docs")
        first, tfs, ends, postings = get("first"), get("tfs"), get("ends"), get("postings")
        at = pc.index_in(known, value_set=row["words"].values)
        self.has = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        code = at.drop_null().to_numpy().astype(np.int64)
        kinds, kind = np.unique(tfs, return_inverse=True)
        impact = ((1_000_000_000 * kinds) // (1000 * kinds + 12 * m))[kind]
        starts = np.concatenate([[0], ends[:-1]])
        # Of each known term: where its documents lie, and its largest impact (that of the last tf).
        self.start = starts[first[code]] if len(code) else code
        self.stop = ends[first[code + 1] - 1] if len(code) else code
        self.top = impact[first[code + 1] - 1] if len(code) else code
        lengths = self.stop - self.start
        take = _ranges(self.start, lengths)
        self.postings = postings[take]
        self.impacts = np.repeat(impact, ends - starts)[take]
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths


def _ranges(start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(start - before, lengths)


class _Block:
    """Items whose terms are sent to the tasks together, and their best documents so far."""

    def __init__(self, items: list[int], known: list[str], item: np.ndarray, term: np.ndarray,
                 weight: np.ndarray, least: np.ndarray, k: int) -> None:
        self.items, self.known, self.k = items, pa.array(known, pa.string()), k
        self.item, self.term, self.weight = item, term, weight
        self.start = np.searchsorted(item, np.arange(len(items) + 1))
        self.least = least.copy()
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)

    def bounds(self, unit: _Unit) -> np.ndarray:
        """Of each item, the score of a document with every term's largest impact."""
        top = np.zeros(len(self.known), dtype=np.int64)
        top[unit.has] = unit.top
        out = np.zeros(len(self.items), dtype=np.int64)
        np.add.at(out, self.item, self.weight * top[self.term])
        return out

    def visit(self, unit: _Unit, at: int) -> None:
        """Score the unit's documents for an item."""
        mine = slice(self.start[at], self.start[at + 1])
        where = np.searchsorted(unit.has, self.term[mine])
        there = where < len(unit.has)
        there[there] = unit.has[where[there]] == self.term[mine][there]
        code, weight = where[there], self.weight[mine][there]
        lengths = unit.stop[code] - unit.start[code]
        take = _ranges(unit.start[code], lengths)
        scores = np.zeros(len(unit.docs), dtype=np.int64)
        np.add.at(scores, unit.postings[take], unit.impacts[take] * np.repeat(weight, lengths))
        good = np.flatnonzero((scores > 0) & (scores >= self.least[at]))
        if not len(good):
            return
        score = np.concatenate([self.best[at][0], scores[good]])
        doc = np.concatenate([self.best[at][1], unit.docs[good]])
        order = np.lexsort((doc, -score))[:self.k]
        self.best[at] = score[order], doc[order]
        if len(order) == self.k:
            self.least[at] = max(self.least[at], score[order[-1]])


def _visited(units: DataFrame, block: tuple, k: int, buffer: int, seeds: bool) -> DataFrame:
    """(item, id, score): the best documents of each buffer of units, by one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, size = _Block(*block, k), [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                unit = _Unit({n: batch.column(n)[row] for n in batch.schema.names}, state.known)
                if not len(unit.has):
                    continue
                held.append(unit)
                size += len(unit.postings) + len(unit.docs)
                if size >= buffer:
                    through(state, held)
                    held, size = [], 0
        through(state, held)
        for at, (score, doc) in enumerate(state.best):
            if len(doc):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(doc), state.items[at], dtype=np.int64)), pa.array(doc),
                    pa.array(score)], names=["item", "id", "score"])

    def through(state: _Block, held: list[_Unit]) -> None:
        if not held:
            return
        bounds = np.stack([state.bounds(u) for u in held])
        for at in range(len(state.items)):
            order = np.argsort(-bounds[:, at], kind="stable")
            for place in order[:1] if seeds else order:
                if bounds[place, at] <= 0 or bounds[place, at] < state.least[at]:
                    break
                state.visit(held[place], at)

    return units.mapInArrow(run, "item long, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def index(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, unit: int = UNIT,
) -> tuple[DataFrame, DataFrame, int]:
    """The written units, the documents' terms, and the number of documents with terms."""
    described = stored(_described(docs, key, text))
    documents, total = described.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return stored(_units(described, documents, total, unit)), described, documents


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", *, k: int = 20, unit: int = UNIT,
    buffer: int = BUFFER, block: int = BLOCK,
) -> DataFrame:
    """Each item's ``k`` best documents: item key, rank, document key, score."""
    units, described, documents = index(docs, key, text, unit=unit)
    asked = stored(
        _described(items, item_key, item_text)
        .select(F.col("id").alias("item"), F.explode(F.arrays_zip(
            F.split("words", " ").alias("word"), F.col("tfs").alias("c"))).alias("of"))
        .select("item", "of.word", "of.c")
        .groupBy("item", "word").agg(F.sum("c").alias("c")))
    # Occurrences in documents of the items' terms; words are counted before they are shuffled.
    frequency = described.select(F.explode(F.split("words", " ")).alias("word")).join(
        asked.select("word").distinct(), "word").groupBy("word").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(
        F.lit(2.0 * documents + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    weighted = stored(asked.join(frequency, "word").select(
        "item", "word", (F.col("c") * weight).alias("weight")))
    # Terms are measured with their bytes, so that a block's size is bounded.
    size, = weighted.agg(F.sum(1 + F.floor(F.octet_length("word") / 16))).first()
    count = -(-2 * (size or 0) // block)
    found = None
    for number in range(count):
        mine = F.pmod(F.xxhash64("item"), F.lit(count)) == number
        parts = _block(weighted.where(mine))
        if not parts[0]:
            continue
        start = np.zeros(len(parts[0]), dtype=np.int64)
        seeds = stored(_visited(units, (*parts, start), k, buffer, True))
        # One number for each item of the block.
        for item, least in _ranked(seeds, k).where(F.col("rank") == k).select("item", "score").collect():
            start[parts[0].index(item)] = least
        best = _visited(units, (*parts, start), k, buffer, False)
        found = best if found is None else found.union(best)
    if found is None:
        found = asked.select("item", F.col("item").alias("id"), F.lit(0).cast("long").alias("score")).where("false")
    return _ranked(found, k).select(
        F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")


def _block(rows: DataFrame) -> tuple:
    """Items of a block of bounded size, their terms and weights, by item."""
    got = rows.orderBy("item", "word").toArrow()
    items = sorted(set(got["item"].to_pylist()))
    known = sorted(set(got["word"].to_pylist()))
    item = np.searchsorted(np.array(items, dtype=np.int64), got["item"].to_numpy())
    place = {w: i for i, w in enumerate(known)}
    term = np.array([place[w] for w in got["word"].to_pylist()], dtype=np.int64)
    return items, known, item, term, got["weight"].to_numpy()


def op11_lexical_search(spark, folder: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
