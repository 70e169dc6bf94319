"""Near duplicates: fast similarity sketches, banding, and exact verification.

A sketch has one coordinate per bin.  In each of the first rounds every shingle is placed
in one bin by hash, and an empty bin takes the smallest hash that meets it; the later
rounds give each bin still empty the smallest hash of all shingles, so every coordinate is
filled and the share of equal coordinates is as concentrated around the Jaccard similarity
as with independent samples.  ``ROWS`` coordinates make a band; sets of one band value are
candidates.  At a similarity of 0.8 a pair shares none of the ``BANDS`` bands with
probability 2e-6.  One bit of each of ``BITS`` coordinates rules out pairs whose estimate is
under ``similarity - MARGIN`` (for a pair of just that similarity a deviation of 4.9, chance
6e-7); the rest is verified on the full shingle sets of the texts.  Before the last step, which
takes all pairs that are left in a band, ``ODD`` bits of each set rule out most others without
an error: a bit says whether an odd number of shingles falls on it, so two sets have at least as
many shingles apart as they have bits that differ.

Equal sets are one node.  ``linking`` seeks links so that no group of copies is expanded
into its pairs and no link between different components is lost.

Defined cases: a null text, or one without words, has an empty set and is linked with
nothing; a null id takes no part and keeps its row, without a component; rows of one id
are one node each per set, and joined if they are alike; very long texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, stored, table
from .linking import link_components, shared_members
from .shingles import shingle_set

ROWS, BANDS, BITS = 7, 56, 384
MARGIN = 0.15
ODD = 1024
_MASK = np.uint64(0xFFFFFFFF)
_SEEDS = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def sketch(shingles: np.ndarray, bins: int = ROWS * BANDS) -> np.ndarray:
    """Sketch of a non-empty set: round and hash of the shingle that filled each bin."""
    filled = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    empty, done, n = filled[0], 0, len(shingles)
    while done < bins and (filled == empty).any():
        # Several rounds at a time for small sets; an earlier round always wins.
        rounds = np.arange(done, min(bins, done + max(1, 4096 // n)), dtype=np.uint64)
        h = mix(shingles[None, :] ^ _SEEDS[rounds.astype(np.int64)][:, None])
        place = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        value = (rounds[:, None] << np.uint64(32)) | (h & _MASK)
        np.minimum.at(filled, place.ravel().astype(np.int64), value.ravel())
        done += len(rounds)
    for b in np.flatnonzero(filled == empty):
        h = mix(shingles ^ _SEEDS[bins + b])
        filled[b] = (np.uint64(bins + b) << np.uint64(32)) | (h & _MASK).min()
    return filled


def bands(filled: np.ndarray) -> np.ndarray:
    grid = filled.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, i])
    return key


def _packed(filled: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, as signed integers of 64."""
    bits = (mix(filled[:BITS]) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def odd_bits(shingles: np.ndarray) -> np.ndarray:
    """Of each bit whether an odd number of shingles falls on it, as signed integers of 64."""
    place = (shingles >> np.uint64(40)).astype(np.int64) % ODD
    return np.packbits((np.bincount(place, minlength=ODD) & 1).astype(np.uint8)).view(np.int64)


def _describe(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per row: id, set size, 128-bit set hash, bands, the bits for the estimate and the odd ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for t in frame["text"]:
                s = shingle_set(t if isinstance(t, str) else None, words)
                if not len(s):
                    rows.append((0, 0, 0, None, None, None))
                    continue
                first = int(s.sum(dtype=np.uint64).view(np.int64))
                second = int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                filled = sketch(s)
                rows.append((len(s), first, second, bands(filled).view(np.int64),
                             _packed(filled), odd_bits(s)))
            out = pd.DataFrame(rows, columns=["n", "h1", "h2", "bands", "bits", "odd"])
            out.insert(0, "id", frame["id"].to_numpy())
            yield out

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(
        run, "id long, n long, h1 long, h2 long, bands array<long>, bits array<long>, odd array<long>")


def _differing(one, two) -> Column:
    """How many of two nodes' ``bits`` differ: bits of equal coordinates agree, others do so
    half the time."""
    gap = lambda i: F.bit_count(one("bits")[i].bitwiseXOR(two("bits")[i]))
    return sum((gap(i) for i in range(1, BITS // 64)), gap(0))


def _possible(percent: int):
    """Whether 100 * intersection can reach percent * union, by the sizes and the odd bits."""

    def test(one, two) -> Column:
        gap = lambda i: F.bit_count(one("odd")[i].bitwiseXOR(two("odd")[i]))
        apart = F.greatest(
            sum((gap(i) for i in range(1, ODD // 64)), gap(0)), F.abs(one("n") - two("n")))
        return (100 + percent) * apart <= (100 - percent) * (one("n") + two("n"))

    return test


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for frame in frames:
            keep = []
            for x, y in zip(frame["one"], frame["two"]):
                if known[0] != y:
                    known = (y, shingle_set(y, words))
                one, two = shingle_set(x, words), known[1]
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield frame.loc[keep, ["a", "b"]]

    rows = pairs.join(texts.toDF("a", "one"), "a").join(texts.toDF("b", "two"), "b")
    return rows.mapInPandas(check, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per row: id, set size, component id, and whether the row is its component's first."""
    # Rows without a set have keys of their own, or they would all meet in one partition.
    described = stored(_describe(docs, key, text, words).withColumn(
        "h1", F.when(F.col("n") > 0, F.col("h1")).otherwise(F.xxhash64("id"))))
    filled = described.where("n > 0 and id is not null")
    sets = filled.groupBy("h1", "h2").agg(F.min("id").alias("node"))
    nodes = stored(
        filled.join(sets, ["h1", "h2"]).where("id = node")
        .select("node", "n", "bands", "bits", "odd").dropDuplicates(["node"]))

    members = shared_members(nodes.select(F.explode("bands").alias("band"), "node"))
    texts = stored(
        docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
        .where("node is not null and text is not null")
        .join(members.select("node").distinct(), "node", "left_semi"))

    parts = link_components(
        members, nodes.select("node", "n", "bits", "odd"), _differing,
        int((1 - percent / 100 + MARGIN) / 2 * BITS),
        lambda pairs: _verified(pairs, texts, words, percent), possible=_possible(percent))
    whole = sets.join(parts, "node", "left").select(
        "h1", "h2", F.coalesce("component", "node").alias("component"))
    return described.join(
        whole, ["h1", "h2"], "left"
    ).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
        .alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def op7_near_duplicates(spark, folder: str) -> DataFrame:
    """Components of documents by four-word shingles at a similarity of 0.8."""
    return near_duplicates(table(spark, folder, "documents"), words=4, percent=80)
