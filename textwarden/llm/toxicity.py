"""Toxicity by nearest labelled examples.

Labelled examples, a bounded sample of each class, are TF-IDF vectors over the terms
(words and word beginnings) that tell the classes apart.  Their inverted index is cut into blocks of examples, and each term
knows its largest weight in every block.  A text's nearest examples by cosine are found
exactly: blocks are visited by falling upper bound, until no bound left can reach the
``NEIGHBOURS``-th best similarity.  Neighbours vote with weights that grow with similarity
against the prior, and a logistic curve fitted on leave-one-out votes of the sample, weighted
to the class shares of all labelled rows, turns votes into calibrated scores.  The neighbours
are the evidence.

Bounds: the sample has at most about ``PER_CLASS`` rows of each class, the vocabulary at most
``TERMS`` terms, those of the largest difference between the classes.

Defined cases: null and empty texts, and texts without a known term, have no neighbours and
get the calibrated score of a vote of 0, the lowest; without labelled rows of both classes every score is the
share of toxic rows (0 without any); equal similarities prefer the smaller example id; labels
that are null or other than 0 and 1 are not learned from; repeated labels count as repeated;
texts are read whole; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import annotate, hash_share, table

PER_CLASS = 1500
TERMS = 4000
# A term must occur in so many examples, and differ between classes by so many deviations.
LEAST_EXAMPLES, LEAST_Z = 5, 4.0
BLOCK = 1024
NEIGHBOURS = 25
# Tokens a task keeps the terms of: a bound on memory only.
TOKENS_KEPT = 200_000
PRIOR_WEIGHT = 0.5
SCHEMA = ("score double, neighbours array<long>, similarities array<double>, "
          "labels array<int>")
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")


def terms_of(token: str) -> list[str]:
    """Terms of what stands between white space: its words, and their beginnings, marked by
    a dash, for inflected forms."""
    words = _WORD.findall(token)
    return words + [w[:size] + "-" for w in words for size in PREFIXES if len(w) > size]


def term_counts(text: str | None) -> Counter:
    out: Counter = Counter()
    for token, n in Counter(text.lower().split()).items() if text else ():
        for term in terms_of(token):
            out[term] += n
    return out


@dataclass
class ToxicityModel:
    """Vocabulary with idf, the blocked index of examples, and the calibration."""

    prior: float = 0.0
    terms: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # Per term: its examples (positions, rising) and weights.
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    # Per term: largest weight in each block; and where each block begins in the postings.
    bounds: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    starts: list[np.ndarray] = field(default_factory=list)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    slope: float = 1.0
    offset: float = 0.0
    # Known terms of the tokens met so far; most tokens have none.
    met: dict[str, list[int]] = field(default_factory=dict)

    def known(self, text: str | None) -> dict[int, int]:
        """Counts of the vocabulary's terms in a text."""
        out: dict[int, int] = {}
        if len(self.met) > TOKENS_KEPT:
            self.met.clear()
        for token, n in Counter(text.lower().split()).items() if text else ():
            at = self.met.get(token)
            if at is None:
                at = [self.terms[t] for t in terms_of(token) if t in self.terms]
                if len(token) < 64:
                    self.met[token] = at
            for term in at:
                out[term] = out.get(term, 0) + n
        return out

    def vector(self, known: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text, of unit length."""
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.fromiter(known.keys(), np.int64, len(known))
        weight = (1 + np.log(np.fromiter(known.values(), float, len(known)))) * self.idf[at]
        return at, weight / np.linalg.norm(weight)

    def vector_of(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        return self.vector({self.terms[w]: n for w, n in counts.items() if w in self.terms})

    def index(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rows = np.concatenate([np.full(len(t), i) for i, (t, _) in enumerate(vectors)])
        terms = np.concatenate([t for t, _ in vectors])
        weights = np.concatenate([w for _, w in vectors])
        order = np.lexsort((rows, terms))
        rows, terms, weights = rows[order], terms[order], weights[order]
        edge = np.searchsorted(terms, np.arange(len(self.terms) + 1))
        blocks = -(-len(vectors) // BLOCK)
        self.bounds = np.zeros((len(self.terms), blocks))
        np.maximum.at(self.bounds, (terms, rows // BLOCK), weights)
        for a, b in zip(edge[:-1], edge[1:]):
            self.postings.append((rows[a:b], weights[a:b]))
            self.starts.append(np.searchsorted(rows[a:b], np.arange(blocks + 1) * BLOCK))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, leave: int = -1,
                k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples of positive cosine."""
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        upper = weights @ self.bounds[terms]
        order = np.argsort(-upper, kind="stable")
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for first in range(0, len(order), 2):
            some = order[first:first + 2]
            # No block from here on can hold a nearer example (a rounding error aside).
            if upper[some[0]] <= 0 or (len(best) == k and upper[some[0]] < best[-1] - 1e-12):
                break
            found_at, found = [best_at], [best]
            for block in some:
                base = block * BLOCK
                sums = np.zeros(min(BLOCK, len(self.ids) - base))
                for t, w in zip(terms, weights):
                    a, b = self.starts[t][block], self.starts[t][block + 1]
                    if a < b:
                        at, value = self.postings[t]
                        sums[at[a:b] - base] += w * value[a:b]
                hit = np.flatnonzero(sums > 0)
                found_at.append(hit + base)
                found.append(sums[hit])
            at, sim = np.concatenate(found_at), np.concatenate(found)
            if leave >= 0:
                at, sim = at[at != leave], sim[at != leave]
            keep = np.lexsort((self.ids[at], -sim))[:k]
            best_at, best = at[keep], sim[keep]
        return best_at, best

    def vote(self, at: np.ndarray, sim: np.ndarray) -> float:
        """Share of toxic neighbours, by squared cosine, held towards an even chance."""
        weight = sim**2
        total = weight.sum() + PRIOR_WEIGHT
        return float((weight @ self.labels[at] + 0.5 * PRIOR_WEIGHT) / total) if len(at) else 0.0

    def score(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * vote + self.offset, -40, 40))))

    def predict(self, text: str | None) -> tuple[float, list[int], list[float], list[int]]:
        if not self.terms:
            return self.prior, [], [], []
        at, sim = self.nearest(*self.vector(self.known(text)))
        return (self.score(self.vote(at, sim)), self.ids[at].tolist(), sim.tolist(),
                self.labels[at].tolist())

    def predict_batch(self, texts: list[str | None]) -> pd.DataFrame:
        return pd.DataFrame([self.predict(t) for t in texts],
                            columns=["score", "neighbours", "similarities", "labels"])


def train(ids: np.ndarray, counts: list[Counter], labels: np.ndarray,
          prior: float) -> ToxicityModel:
    """Model from sampled examples; ``prior`` is the toxic share of all labelled rows."""
    model = ToxicityModel(prior=prior)
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    if not n1 or not n0:
        return model
    order = np.argsort(ids, kind="stable")
    ids, labels, counts = ids[order], labels[order], [counts[i] for i in order]
    seen = (Counter(), Counter())
    for c, label in zip(counts, labels):
        seen[label].update(c.keys())
    scored = []
    for term in seen[0].keys() | seen[1].keys():
        a, b = seen[1][term], seen[0][term]
        if a + b >= LEAST_EXAMPLES:
            p = (a + b + 1) / (n0 + n1 + 2)
            z = abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
            if z >= LEAST_Z:
                scored.append((-z, term, a + b))
    chosen = sorted(scored)[:TERMS]
    if not chosen:
        return model
    model.terms = {term: i for i, (_, term, _) in enumerate(chosen)}
    model.idf = np.array([1 + np.log((1 + n0 + n1) / (1 + df)) for _, _, df in chosen])
    vectors = [model.vector_of(c) for c in counts]
    model.ids, model.labels = ids, labels.astype(np.int64)
    model.index(vectors)
    votes = np.array([model.vote(*model.nearest(t, w, leave=i)) for i, (t, w) in enumerate(vectors)])
    weight = np.where(labels == 1, prior / n1, (1 - prior) / n0)
    # Newton's method for slope and offset of the logistic curve, lightly penalised.
    x, beta = np.stack([votes, np.ones_like(votes)], axis=1), np.array([4.0, -2.0])
    scale = weight * len(votes)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (scale * (labels - p)) - 0.01 * beta
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    model.slope, model.offset = float(beta[0]), float(beta[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from labelled rows: at most about ``per_class`` of each class, by a hash of ids."""
    marked = labels.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label")
    ).where("id is not null and label in (0, 1)")
    n = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if not n:
        return ToxicityModel()
    prior = n.get(1, 0) / sum(n.values())
    share = F.when(F.col("label") == 1, min(1.0, per_class / n.get(1, 1))).otherwise(
        min(1.0, per_class / n.get(0, 1)))
    marked = marked.where(hash_share(F.col("id"), "toxicity") < share)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(
        "text is not null")
    # The sample is bounded; joined by broadcast, so no text is moved for it.
    chosen = rows.join(F.broadcast(marked), "id")

    def tally(batches):
        for frame in batches:
            found = [term_counts(t) for t in frame["text"]]
            yield pd.DataFrame({
                "id": frame["id"], "label": frame["label"],
                "terms": [" ".join(c.keys()) for c in found],
                "n": [np.fromiter(c.values(), np.int32, len(c)).tobytes() for c in found],
            })

    found = chosen.mapInPandas(tally, "id long, label int, terms string, n binary").toPandas()
    counts = [
        Counter(dict(zip(t.split(" "), np.frombuffer(n, np.int32).tolist()))) if t else Counter()
        for t, n in zip(found["terms"], found["n"])
    ]
    return train(found["id"].to_numpy(), counts, found["label"].to_numpy(), prior)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text",
          out_col: str = "toxicity") -> DataFrame:
    """Add ``out_col``: score, and the nearest examples with their cosines and labels."""
    return annotate(docs, text, out_col, model.predict_batch, SCHEMA)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def op4_toxicity(spark, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    learned = labels.where(~held_out(F.col("doc_id")))
    model = fit(docs, learned)
    return score(docs.select("doc_id", "text"), model, out_col="found").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("found.neighbours").alias("evidence"))
