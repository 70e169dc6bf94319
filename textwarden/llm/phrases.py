"""Phrases whose words occur together more often than apart.

A text is cut at ``PIECES`` into pieces, and those at blanks and tabs into words.  Every run
of up to ``longest`` words within a piece gets a fingerprint from prefix polynomials
over its words' hashes: with P[i] the sum of code[j] * B**j over j < i, the fingerprint of
words i to i+k is (P[i+k] - P[i]) * B**-i modulo 2**64, salted with the language and k, mixed and
shortened to ``SPARE`` bits more than it takes to number all runs.

Documents are gathered into chunks of about ``CHUNK`` words, which are written.  A chunk counts
its fingerprints, and sends them, sorted and packed, to ranges of fingerprints; the chunk's
number is the pointer to their occurrences.  A range adds up the counts of all chunks and
answers each chunk with those of its fingerprints that occur ``least`` times in all.  The
chunk then reads its text again, and only the runs with these fingerprints are written out and
counted, by their words.  So the counts are exact: runs that collide come apart in the text,
and what is rarer than ``least`` without the other is dropped.  No string of a run with a rare
fingerprint ever leaves its task.  The number of ranges follows the number of words, so that
a range's fingerprints fit into a task whatever the corpus' size.

A candidate is a run of two words or more.  Its score is the least, over its cuts in two, of
10**6 * a * a / (l * r), rounded down, in exact decimals (a, l, r: occurrences of the run and
the two parts).  A candidate inside a longer one of at least ``share`` percent of its
occurrences is dropped.

Defined cases: a null text is empty; a null language is ``und``; ids are not used, so rows
with a null or a repeated id are read and counted like all others; equal phrases of two
languages are two; an empty table gives no rows; texts are read whole; other columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, stored, table

# What ends a piece; what separates words.
PIECES = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

LONGEST, LEAST, SHARE, FIRST = 3, 10, 50, 2000
CHUNK = 1 << 19
RANGE = 1 << 20
# Bits of a fingerprint beyond the logarithm of the number of runs.
SPARE = 20
_UPPER = bytes(range(65, 91))
_BYTES = bytes.maketrans(_UPPER + PIECES + b"\t", _UPPER.lower() + b"." * len(PIECES) + b" ")
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []
_SALTS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(size, 1 << 17), factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS


class _Words(dict):
    """Numbers of words in the order they are met; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def tokens(text: str | None) -> list[bytes]:
    """Words of a text in lower case, with a full stop for every end of a piece."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES)
    # No other white space is left, so splitting at any is splitting at blanks.
    return data.replace(b".", b" . ").split()


class Runs:
    """The runs of words of a chunk: word numbers, and fingerprints from prefix polynomials."""

    def __init__(self, data: bytes, langs: list[str], lengths: list[int], bits: int = 64) -> None:
        numbers, found = _Words(), data.split()
        self.ids = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
        self.words, self.cut = list(numbers), np.uint64(64 - bits)
        code = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        self.langs = sorted(set(langs))
        place = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.repeat(np.array([place[x] for x in langs], dtype=np.int32), lengths)
        salt = [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 3) for x in self.langs]
        self.salt = np.array(salt, dtype=np.uint64)
        self.sums = np.zeros(len(found) + 1, dtype=np.uint64)
        np.cumsum(code[self.ids] * _powers(len(found))[0][:len(found)], out=self.sums[1:])
        self.ends = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum(self.ids == 0, out=self.ends[1:])

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of k words start, and their fingerprints."""
        size = len(self.ids) - k + 1
        if size <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(self.ends[k:] == self.ends[:size])
        value = (self.sums[start + k] - self.sums[start]) * _powers(len(self.ids))[1][start]
        return start, mix(value + (self.salt[self.lang[start]] ^ _SALTS[k])) >> self.cut


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as the bytes of their differences, the lowest of all first; planes of
    zeros at the top are left out."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes[::-1].any(axis=1))) if planes.any() else 1
    return bytes([used]) + planes[:used].tobytes()


def unpack(data: bytes) -> np.ndarray:
    used = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(used, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :used] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)


def _chunks(docs: DataFrame, chunk: int) -> DataFrame:
    """Rows of some documents each: number of the chunk, languages and lengths, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, lengths, parts, held = [], [], [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = tokens(text)
                found.append(b".")
                langs.append(lang)
                lengths.append(len(found))
                parts.append(b" ".join(found))
                held += len(found)
                if held >= chunk:
                    yield out(langs, lengths, parts, held)
                    langs, lengths, parts, held = [], [], [], 0
        if parts:
            yield out(langs, lengths, parts, held)

    def out(langs: list, lengths: list, parts: list, held: int) -> pa.RecordBatch:
        # Rows are written before their numbers are used.
        return pa.RecordBatch.from_pydict({
            "chunk": pa.array([uuid.uuid4().int >> 65], pa.int64()), "held": pa.array([held], pa.int64()),
            "langs": pa.array([langs], pa.list_(pa.string())),
            "lengths": pa.array([lengths], pa.list_(pa.int32())),
            "data": pa.array([zlib.compress(b" ".join(parts), 1)], pa.binary())})

    return docs.mapInArrow(
        run, "chunk long, held long, langs array<string>, lengths array<int>, data binary")


def _read(batch: pa.RecordBatch, row: int, bits: int) -> Runs:
    get = lambda name: batch.column(name)[row].as_py()
    return Runs(zlib.decompress(get("data")), get("langs"), get("lengths"), bits)


def _sent(chunks: DataFrame, ranges: int, longest: int, bits: int) -> DataFrame:
    """(part, chunk, fps, counts): a chunk's fingerprints in each range, packed."""
    shift = np.uint64(bits - (ranges - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, runs = batch.column("chunk")[row].as_py(), _read(batch, row, bits)
                yield packed(chunk, np.concatenate([runs.of(k)[1] for k in range(1, longest + 1)]))

    def packed(chunk: int, values: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(values, return_counts=True)
        part = (values >> shift).astype(np.int64)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        last = np.append(first[1:], len(part))
        fps = [pack(values[a:b]) for a, b in zip(first, last)]
        sums = [counts[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                for a, b in zip(first, last)]
        return pa.RecordBatch.from_arrays([
            pa.array(part[first]), pa.array(np.full(len(first), chunk, dtype=np.int64)),
            pa.array(fps, pa.binary()), pa.array(sums, pa.binary())],
            names=["part", "chunk", "fps", "counts"])

    return chunks.select("chunk", "langs", "lengths", "data").mapInArrow(
        run, "part long, chunk long, fps binary, counts binary")


def _answers(sent: DataFrame, least: int, ranges: int) -> DataFrame:
    """(chunk, fps): of each range, the fingerprints of a chunk that are frequent in all.

    There are as many partitions as ranges, so what a task and its Arrow batches hold does not
    grow with the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part, chunk, fps, counts = (batch.column(i)[row].as_py() for i in range(4))
                if part != now and held:
                    yield added(held)
                    held = []
                now = part
                held.append((chunk, fps, counts))
        if held:
            yield added(held)

    def added(held: list) -> pa.RecordBatch:
        each = [unpack(fps) for _, fps, _ in held]
        counts = np.concatenate([
            np.frombuffer(c, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0] for _, _, c in held])
        values, place = np.unique(np.concatenate(each), return_inverse=True)
        # Whole numbers up to 2**53, so exact in doubles.
        often = (np.bincount(place, weights=counts, minlength=len(values)) >= least)[place]
        ends = np.cumsum([len(x) for x in each])
        chosen = [x[often[e - len(x):e]] for x, e in zip(each, ends)]
        some = [i for i, x in enumerate(chosen) if len(x)]
        return pa.RecordBatch.from_arrays([
            pa.array([held[i][0] for i in some], pa.int64()),
            pa.array([pack(chosen[i]) for i in some], pa.binary())], names=["chunk", "fps"])

    return (sent.repartition(ranges, "part").sortWithinPartitions("part")
            .mapInArrow(run, "chunk long, fps binary"))


def _written_out(chunks: DataFrame, longest: int, bits: int) -> DataFrame:
    """(lang, k, phrase, n) in each chunk: all words (k is 0), and the runs answered for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                runs = _read(batch, row, bits)
                answers = batch.column("answers")[row].as_py() or []
                frequent = np.sort(np.concatenate([unpack(x) for x in answers] or [np.zeros(0, np.uint64)]))
                words = np.bincount(runs.lang[runs.ids != 0], minlength=len(runs.langs))
                yield out(runs, 0, np.arange(len(words)), [b""] * len(words), words)
                for k in range(1, longest + 1):
                    yield from counted(runs, k, frequent)

    def counted(runs: Runs, k: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
        start, fp = runs.of(k)
        if not len(frequent) or not len(start):
            return
        # In order, so that the search goes through both from start to end.
        order = np.argsort(fp)
        start, fp = start[order], fp[order]
        hit = frequent[np.minimum(np.searchsorted(frequent, fp), len(frequent) - 1)] == fp
        start, fp = start[hit], fp[hit]
        # A run is its language and words; equal fingerprints of others are runs of their own.
        new = np.ones(len(fp), dtype=bool)
        new[1:] = (fp[1:] != fp[:-1]) | (runs.lang[start[1:]] != runs.lang[start[:-1]])
        for i in range(k):
            new[1:] |= runs.ids[start[1:] + i] != runs.ids[start[:-1] + i]
        first = np.flatnonzero(new)
        at = start[first]
        found = [[runs.words[w] for w in runs.ids[at + i].tolist()] for i in range(k)]
        yield out(runs, k, runs.lang[at], list(map(b" ".join, zip(*found))),
                  np.diff(np.append(first, len(fp))))

    def out(runs: Runs, k: int, lang: np.ndarray, phrases: list, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.DictionaryArray.from_arrays(
                pa.array(lang.astype(np.int32)), pa.array(runs.langs, pa.string())).cast(pa.string()),
            pa.array(np.full(len(n), k, dtype=np.int32)),
            pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64))],
            names=["lang", "k", "phrase", "n"])

    return chunks.select("langs", "lengths", "data", "answers").mapInArrow(
        run, "lang string, k int, phrase string, n long")


def counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, longest: int = LONGEST,
    least: int = LEAST, chunk: int = CHUNK, spare: int = SPARE,
) -> DataFrame:
    """(lang, k, phrase, n) of all runs of up to ``longest`` words that occur ``least`` times,
    and for k = 0 the number of words of each language."""
    chunks = stored(_chunks(docs.select(F.coalesce(F.col(lang), F.lit("und")), text), chunk))
    held, = chunks.agg(F.sum("held")).first()
    total = longest * (held or 0)
    ranges, bits = 1 << (total // RANGE).bit_length(), min(64, total.bit_length() + spare)
    # Written before the chunks are moved: what was sent is off the disks by then.
    answers = stored(_answers(_sent(chunks, ranges, longest, bits), least, ranges)).groupBy("chunk").agg(
        F.collect_list("fps").alias("answers"))
    return _written_out(chunks.join(answers, "chunk", "left"), longest, bits).groupBy(
        "lang", "k", "phrase").agg(F.sum("n").alias("n")).where((F.col("k") == 0) | (F.col("n") >= least))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, longest: int = LONGEST,
    least: int = LEAST, share: int = SHARE, first: int | None = FIRST, chunk: int = CHUNK,
    spare: int = SPARE,
) -> DataFrame:
    """Each language's phrases, best first: lang, rank, phrase, a, l, r, n, score."""
    runs = stored(counts(docs, text, lang, longest=longest, least=least, chunk=chunk, spare=spare)
                  .withColumn("words", F.split("phrase", " ")))
    total = runs.where("k = 0").select("lang", F.col("n").alias("total"))
    known = runs.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    found = runs.where("k > 1")

    def span(words: str, start, length):
        return F.array_join(F.slice(words, start, length), " ")

    # Candidates inside longer ones, by the most frequent of these.
    lengths = [F.struct(F.lit(i).alias("start"), F.lit(n).alias("len"))
               for n in range(2, longest) for i in range(1, longest - n + 2)]
    if lengths:
        inner = found.where("k > 2").select("lang", "words", "k", "n", F.explode(F.array(*lengths)).alias("at"))
        longer = inner.where("at.len < k and at.start + at.len <= k + 1").select(
            "lang", span("words", F.col("at.start"), F.col("at.len")).alias("phrase"), "n",
        ).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
        found = found.join(longer, ["lang", "phrase"], "left").where(
            f"longer is null or 100 * longer < {int(share)} * n").drop("longer")

    cuts = found.select("lang", "phrase", "n", "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "n", "cut", span("words", F.lit(1), F.col("cut")).alias("one"),
                       span("words", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("two"))
    left, right = known.toDF("lang", "one", "l"), known.toDF("lang", "two", "r")
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    scored = cuts.join(left, ["lang", "one"]).join(right, ["lang", "two"]).withColumns({
        "over": F.lit(1_000_000).cast("decimal(7,0)") * wide("n") * wide("n"),
        "under": wide("l") * wide("r")}).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase").agg(
        F.max("n").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(order))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score")


def op13_collocations(spark, folder: str) -> DataFrame:
    """The 2,000 best phrases of two and three words in each language."""
    return collocations(table(spark, folder, "documents"))
