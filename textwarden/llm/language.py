"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams (1 to 4, inside
words, word ends marked); a linear layer and softmax give the language.  Embeddings and
layer are trained together by stochastic gradient descent in numpy on a bounded sample of
labelled rows.  A part of the sample that is not trained on sets the temperature of the
softmax and the confidence under which a text is rejected.

Defined cases: a null text or one without letters is ``und`` with score 0 and rejected;
rows without a language or id are never learned from; without any labelled row every text
is ``und``; equal probabilities go to the language first in sort order; repeated rows are
predicted alike.  Long texts are read whole, in pieces.  Other columns are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import annotate, code_points, hash_share, letters_of, mix, per_text

BUCKETS = 1 << 13
DIMENSIONS = 16
GRAMS = (1, 2, 3, 4)
# Rows learned from, for each language, in expectation: the bound of the sample.
ROWS_PER_LANGUAGE = 500
LEAST_STEPS = 400
PIECE = 1 << 18
UNKNOWN = "und"
SCHEMA = "lang_pred string, score double, rejected boolean"


def gram_counts(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of the text's hashed n-grams; all zero if it has no letter."""
    counts = np.zeros(buckets, dtype=np.int64)
    if not text:
        return counts
    points = letters_of(code_points(text.lower()))
    longest = max(GRAMS)
    for at in range(0, len(points), PIECE):
        # A piece also sees the n-grams that start in it and end after it.
        piece = points[max(0, at - 1):at + PIECE + longest - 1]
        first = 1 if at else 0
        if not at:
            piece = np.concatenate([np.array([32], np.uint32), piece])
        if at + PIECE + longest - 1 > len(points):
            piece = np.concatenate([piece, np.array([32], np.uint32)])
        blank = piece == 32
        value = piece.astype(np.uint64)
        starts = min(len(piece), PIECE + 1)
        code = np.zeros(len(piece), dtype=np.uint64)
        inner = np.zeros(len(piece), dtype=bool)
        for n in range(1, longest + 1):
            size = len(piece) - n + 1
            if size <= 0:
                break
            code = code[:size] * np.uint64(0x100000001B3) + value[n - 1:n - 1 + size]
            # Blanks only at the ends; an n-gram of a blank alone says nothing.
            if n >= 3:
                inner = inner[:size] | blank[n - 2:n - 2 + size]
            else:
                inner = np.zeros(size, dtype=bool)
            if n not in GRAMS:
                continue
            use = ~inner
            use &= ~(blank[:size] & blank[n - 1:n - 1 + size])
            use[:first] = False
            use[starts:] = False
            hashed = mix(code[use] + np.uint64(n))
            counts += np.bincount(
                (hashed & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets
            )
    return counts


@dataclass
class LanguageModel:
    """What a task needs: the product of embeddings and layer, and the calibration."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return (counts @ self.weights) / counts.sum() + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = gram_counts(text)
        if not self.languages or not counts.any():
            return UNKNOWN, 0.0, True
        p = softmax(self.logits(counts)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)

    def predict_batch(self, texts: list[str | None]) -> pd.DataFrame:
        return pd.DataFrame([self.predict(t) for t in texts],
                            columns=["lang_pred", "score", "rejected"])

    def column(self, text: Column) -> Column:
        return per_text(self.predict_batch, SCHEMA)(text)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    counts: np.ndarray, labels: np.ndarray, languages: list[str], *, epochs: int = 6,
    batch: int = 32, rate: float = 0.5, max_false_rejections: float = 0.001, seed: int = 7,
) -> LanguageModel:
    """Fit on rows of n-gram counts (float32); every fifth row calibrates instead."""
    rng = np.random.default_rng(seed)
    x = counts / counts.sum(axis=1, keepdims=True)
    held = np.arange(len(x)) % 5 == 4 if len(x) >= 25 else np.zeros(len(x), dtype=bool)
    rows, k = np.flatnonzero(~held), len(languages)
    # N-grams differ in frequency by orders of magnitude.  Training sees them scaled to
    # like spread and rows of unit length on average; the scale then joins the embeddings.
    scale = 1.0 / np.sqrt(x[rows].mean(axis=0) + 1e-6)
    scale /= np.sqrt(np.mean([((x[r] * scale) ** 2).sum() for r in rows]))
    x *= scale
    embed = rng.normal(0, 0.3, (x.shape[1], DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.3, (DIMENSIONS, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    truth = np.eye(k, dtype=np.float32)[labels]
    steps, done = max(LEAST_STEPS, epochs * -(-len(rows) // batch)), 0
    while done < steps:
        rng.shuffle(rows)
        for at in range(0, len(rows), batch):
            pick = rows[at:at + batch]
            step = rate * max(0.05, 1 - done / steps)
            hidden = x[pick] @ embed
            error = (softmax(hidden @ layer + bias) - truth[pick]) / len(pick)
            back = error @ layer.T
            layer -= step * hidden.T @ error
            bias -= step * error.sum(axis=0)
            embed -= step * (x[pick].T @ back)
            done += 1
    model = LanguageModel(languages, scale[:, None] * (embed @ layer), bias, 1.0, 0.0)
    test = np.flatnonzero(held) if held.any() else np.arange(len(x))
    z = x[test] @ (embed @ layer) + bias
    losses = []
    grid = np.geomspace(0.002, 5, 50)
    for t in grid:
        p = softmax(z / t)[np.arange(len(test)), labels[test]]
        losses.append(-np.log(np.maximum(p, 1e-9)).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    best = np.sort(softmax(z / model.temperature).max(axis=1))
    # Rejects what is less sure than all but a few held-out rows, and only if it is far
    # from sure: at most half the way from a blind guess to certainty.
    cut = best[int(max_false_rejections * len(best))]
    model.threshold = float(min(0.9 * cut, 0.5 + 0.5 / k))
    return model


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from at most about ``rows_per_language`` labelled rows of each language.

    A row is in the sample if a hash of its key falls below the language's share, so the
    sample does not depend on partitions or order.
    """
    rows = docs.select(
        F.col(key).cast("string").alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where("key is not null and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    shares = F.create_map(*[
        F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, rows_per_language / n))
    ])
    chosen = rows.where(hash_share(F.col("key"), "language") < shares[F.col("lang")])

    def features(batches):
        for frame in batches:
            hit = [gram_counts(t) for t in frame["text"]]
            used = [np.flatnonzero(c) for c in hit]
            yield pd.DataFrame({
                "key": frame["key"], "lang": frame["lang"], "bucket": [u.astype(np.int32).tobytes() for u in used],
                "n": [c[u].tobytes() for c, u in zip(hit, used)],
            })

    found = chosen.mapInPandas(
        features, "key string, lang string, bucket binary, n binary"
    ).where(F.length("bucket") > 0).toPandas()
    found = found.assign(order=pd.util.hash_array(found["key"].to_numpy(dtype=object)))
    found = found.sort_values(["order", "key"], ignore_index=True)
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(found), BUCKETS), dtype=np.float32)
    for i, (bucket, n) in enumerate(zip(found["bucket"], found["n"])):
        counts[i, np.frombuffer(bucket, np.int32)] = np.frombuffer(n, np.int64)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    at = {name: i for i, name in enumerate(languages)}
    return train(counts, found["lang"].map(at).to_numpy(), languages)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text",
             out_col: str = "language") -> DataFrame:
    """Add ``out_col`` struct<lang_pred, score, rejected>."""
    return annotate(docs, text, out_col, model.predict_batch, SCHEMA)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def op9_language_id(spark, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model, out_col="found").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score"
    )
