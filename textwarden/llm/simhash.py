"""Near duplicates by SimHash, found with tables of distances to reference fingerprints.

A text's fingerprint has a bit set where more than half of its word shingles' XXH64 values
have it.  Fingerprints are linked when they differ in at most ``BITS_APART`` bits.  Equal
fingerprints are one node.

``REFERENCES`` fixed fingerprints p, each also with one block of its bits inverted (p'), are
the pivots.  Distances to them are the only thing candidates are found by:

* d(x, p) - d(x, p') tells how far x is from p within the block.  Two fingerprints that
  differ in no bit of a block have equal differences for all pivots, and of three blocks two
  bits touch two at most; so linked nodes meet in one of three buckets (block, differences).
* A bucket of more than ``CROWD`` nodes is never expanded into its pairs.  Its nodes agree in
  the block, so the other bits are split into three blocks again, and so on.  Every step
  fixes a third of the bits left, so what is left in the end differs in four bits at most.
* In a bucket of up to ``CROWD`` nodes, pairs whose distances to any pivot differ by more
  than ``BITS_APART`` are discarded (triangle inequality); survivors are verified bit by bit.
  A bucket passes on one link for each of its nodes at most.

No linked pair is missed and no wrong one is linked, whatever the pivots are.

Defined cases: a null text, or one without words, has fingerprint zero and is linked like any
other; a null id takes no part and its row stays, without a component; rows of one id are
nodes of their own fingerprints under that id; an empty table gives no rows; texts are read
whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, stored, table
from .components import components

BITS_APART = 2
REFERENCES = 16
CROWD = 64
_SEED = 42
_PIECE = 1 << 16
_PIVOTS = mix(np.arange(1, REFERENCES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of the lower-cased text, in pieces; a shorter text is one."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return
    joined, k = b" ".join(found), min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    one, count = xxhash.xxh64_intdigest, len(found) - k + 1
    for at in range(0, count, _PIECE):
        stop = min(count, at + _PIECE)
        spans = zip(starts[at:stop].tolist(), ends[at + k - 1:stop + k - 1].tolist())
        yield np.fromiter((one(joined[s:e], _SEED) for s, e in spans), np.uint64, stop - at)


def fingerprint(text: str | None, words: int) -> int:
    """The text's SimHash as an unsigned number; zero without words."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for h in shingle_hashes(text or "", words):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([fingerprint(t if isinstance(t, str) else None, words)
                               for t in frame["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": frame["id"], "fp": values.view(np.int64)})

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        run, "id long, fp long")


def blocks(fixed: int) -> list[int]:
    """The bits not fixed yet, dealt into three blocks."""
    left = [1 << i for i in range(64) if not fixed >> i & 1]
    return [sum(left[i::3]) for i in range(3)]


def distances(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Table of Hamming distances: a row for each value, a column for each pivot."""
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int8)


def bucket_keys(values: np.ndarray, before: np.ndarray, block: int) -> np.ndarray:
    """Buckets by the distances within a block, inside the buckets of before."""
    inside = distances(values, _PIVOTS) - distances(values, _PIVOTS ^ np.uint64(block))
    key = mix(before ^ np.uint64(block))
    for column in inside.astype(np.int64).view(np.uint64).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row (fp, key, fixed) into its three finer buckets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for fixed, part in frame.groupby("fixed"):
                values, before = (part[c].to_numpy().view(np.uint64) for c in ("fp", "key"))
                for block in blocks(int(fixed) & 0xFFFFFFFFFFFFFFFF):
                    now = np.uint64(int(fixed) & 0xFFFFFFFFFFFFFFFF | block).view(np.int64)
                    yield pd.DataFrame({
                        "fp": part["fp"], "fixed": now,
                        "key": bucket_keys(values, before, block).view(np.int64)})

    return rows.select("fp", "key", "fixed").mapInPandas(run, "fp long, fixed long, key long")


def linked_rows(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key: each linked row but the first of its group, and that first one."""
    reach, step, one, two = distances(values, _PIVOTS), 1, [], []
    left = np.arange(max(0, len(values) - 1))
    while len(left):
        left = left[keys[left] == keys[left + step]]
        near = left[np.abs(reach[left] - reach[left + step]).max(axis=1, initial=0) <= BITS_APART]
        near = near[np.bitwise_count(values[near] ^ values[near + step]) <= BITS_APART]
        one.append(near)
        two.append(near + step)
        step += 1
        left = left[left + step < len(values)]
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (one, two))
    label = np.arange(len(values))
    while True:
        before = label.copy()
        np.minimum.at(label, b, label[a])
        np.minimum.at(label, a, label[b])
        label = label[label]
        if np.array_equal(before, label):
            break
    rest = np.flatnonzero(label != np.arange(len(values)))
    return rest, label[rest]


def _links(rows: DataFrame) -> DataFrame:
    """Links (a, b) in buckets of bounded size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame])
            whole = rest["key"].to_numpy() != rest["key"].iloc[-1]
            part, rest = rest[whole], rest[~whole]
            yield linked(part)
        if rest is not None:
            yield linked(rest)

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        values = part["fp"].to_numpy()
        one, two = linked_rows(values.view(np.uint64), part["key"].to_numpy())
        return pd.DataFrame({"a": values[one], "b": values[two]})

    return (rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
            .mapInPandas(run, "a long, b long").distinct())


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links that connect all nodes (column ``fp``) that are connected by close pairs."""
    rows = nodes.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("fixed"))
    found = None
    while True:
        dealt = _dealt(rows)
        sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        members = stored(dealt.join(sizes, "key"))
        # With four bits left a bucket is small whatever its size was.
        last = F.bit_count("fixed") >= 60
        here = _links(members.where((F.col("n") <= crowd) | last))
        found = here if found is None else found.union(here)
        rows = members.where((F.col("n") > crowd) & ~last)
        if rows.isEmpty():
            return found


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = 3,
) -> DataFrame:
    """Per row: id, fingerprint in hexadecimal digits, component id."""
    described = stored(_fingerprints(docs, key, text, words))
    nodes = stored(described.where("id is not null").groupBy("fp").agg(F.min("id").alias("node")))
    parts = components(links(nodes)).withColumnRenamed("node", "fp")
    named = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    where = named.join(least, "component").select("fp", "component_id")
    return described.join(where, "fp", "left").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def op12_simhash(spark, folder: str) -> DataFrame:
    """Components of documents whose fingerprints of three-word shingles are two bits apart."""
    return near_duplicates(table(spark, folder, "documents"), words=3)
