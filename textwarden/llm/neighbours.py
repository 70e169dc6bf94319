"""Approximate nearest neighbours over balanced posting lists.

Centroids come from a bounded sample, halved again and again along its widest split into
equal parts, so lists are balanced.  A graph that links each centroid to its nearest ones is
searched best first to find the lists of a vector.  Every vector goes to its nearest list and,
if it lies near a boundary, to up to three more: those within ``REPLICA_RATIO`` of the nearest
distance that are not closer to a list already chosen than to the vector.  A query reads the
lists whose centroids are within a ratio of its nearest centroid's distance; the ratio is
calibrated on the sample to reach ``RECALL``.  Rows farther than the k-th nearest sampled row
are not sent on; the k nearest sampled rows are candidates of every query, so a bound never
costs a row.  Lists are cut into blocks of bounded size, and
so are the queries of a list, so that a common vector fills no single task.  Distances are
exact, in double precision, on the original vectors.

Defined cases: vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows with a null id; a repeated id counts once, with
its nearest vector; ties go to the smaller id; a query without candidates has no rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, stored, table

SAMPLE = 8_192  # rows the index is fitted on, in expectation
LISTS = (8, 4096)  # fewest and most lists; between them the root of the number of rows
DEGREE = 16
REPLICAS, REPLICA_RATIO = 4, 1.15
RECALL = 0.985
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
RESULT = "query_id long, rank int, vec_id long, score double"


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T
    return np.maximum(d, 0)


@dataclass
class Index:
    """Centroids, their neighbour graph, and how far queries look."""

    centroids: np.ndarray
    graph: np.ndarray
    ratio: float
    # The sampled vectors and their ids: they bound what a query's k nearest can be.
    sample: np.ndarray | None = None
    sample_ids: np.ndarray | None = None

    def bounds(self, x: np.ndarray, ids: np.ndarray, k: int,
               ) -> tuple[np.ndarray, list[list[tuple[int, float]]]]:
        """For each query a squared distance within which k other rows are known to lie, and
        the sampled rows within it with their exact distances."""
        if self.sample is None:
            return np.full(len(x), np.inf), [[] for _ in range(len(x))]
        gap = _squares(x, self.sample)
        gap[ids[:, None] == self.sample_ids[None, :]] = np.inf
        slack = 1e-9 * ((x * x).sum(1) + (self.sample**2).sum(1).max())
        kth = np.partition(gap, min(k, len(self.sample)) - 1, axis=1)[:, min(k, len(self.sample)) - 1]
        limit, near = kth + slack, []
        for q in range(len(x)):
            at = np.flatnonzero((gap[q] <= limit[q]) & np.isfinite(gap[q]))
            exact = np.sqrt(((self.sample[at] - x[q]) ** 2).sum(axis=1))
            order = np.lexsort((self.sample_ids[at], exact))[:k]
            near.append([(int(self.sample_ids[at[i]]), float(exact[i])) for i in order])
        return limit, near

    def search(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``want`` nearest centroids of each row found by best-first search, and their
        distances; rows advance together."""
        n, c = len(x), len(self.centroids)
        want = min(want, c)
        if n > 256:
            parts = [self.search(x[at:at + 256], want) for at in range(0, n, 256)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        norms = (self.centroids**2).sum(1)
        found = np.full((n, c), np.inf)
        spread = np.unique(np.linspace(0, c - 1, min(c, 2 * DEGREE)).astype(int))
        square = (x * x).sum(1)[:, None]

        def visit(rows: np.ndarray, nodes: np.ndarray) -> None:
            dots = np.einsum("nd,nkd->nk", x[rows], self.centroids[nodes])
            found[rows[:, None], nodes] = np.maximum(square[rows] + norms[nodes] - 2 * dots, 0)

        rows = np.arange(n)
        visit(rows, np.broadcast_to(spread, (n, len(spread))))
        open_ = np.ones((n, c), dtype=bool)
        while len(rows):
            view = found[rows]
            limit = np.partition(view, want - 1, axis=1)[:, want - 1]
            waiting = np.where(open_[rows], view, np.inf)
            step = min(4, c)
            best = np.argpartition(waiting, step - 1, axis=1)[:, :step]
            near = np.take_along_axis(waiting, best, 1)
            go = (near <= limit[:, None]) & np.isfinite(near)
            active = go.any(axis=1)
            rows, best = rows[active], best[active]
            if not len(rows):
                break
            open_[rows[:, None], best] = False
            visit(rows, self.graph[best].reshape(len(rows), -1))
        order = np.argsort(found, axis=1, kind="stable")[:, :want]
        return order, np.sqrt(np.take_along_axis(found, order, 1))

    def lists(self, x: np.ndarray) -> list[list[int]]:
        """Posting lists of each vector, nearest first."""
        order, dist = self.search(x, 2 * DEGREE)
        out = []
        for nodes, away in zip(order, dist):
            chosen = [int(nodes[0])]
            for node, d in zip(nodes[1:], away[1:]):
                if len(chosen) == REPLICAS or not d <= REPLICA_RATIO * away[0]:
                    break
                gaps = ((self.centroids[chosen] - self.centroids[node]) ** 2).sum(1)
                if (gaps > d * d).all():
                    chosen.append(int(node))
            out.append(chosen)
        return out

    def probes(self, x: np.ndarray, sizes: np.ndarray, least: int) -> list[list[int]]:
        """Lists each query reads: within the ratio, and on until they hold ``least`` rows."""
        order, dist = self.search(x, len(self.centroids))
        out = []
        for nodes, away in zip(order, dist):
            n = int(np.count_nonzero(away <= self.ratio * away[0] + 1e-12))
            full = np.cumsum(sizes[nodes])
            n = max(n, int(np.searchsorted(full, least)) + 1)
            out.append(nodes[:n].tolist())
        return out


def _halved(x: np.ndarray, parts: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Means of ``parts`` equal parts of x."""
    done, work = [], [(x, parts)]
    while work:
        rows, k = work.pop()
        if k <= 1 or len(rows) < 2:
            done.append(rows.mean(axis=0))
            continue
        one, two = rows[rng.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            side = rows @ (one - two)
            order = np.argsort(side, kind="stable")
            half = len(rows) * (k // 2) // k
            low, high = order[:half], order[half:]
            one, two = rows[high].mean(axis=0), rows[low].mean(axis=0) if half else two
        work += [(rows[low], k // 2), (rows[high], k - k // 2)] if half else [(rows, 1)]
    return done


def fit_sample(x: np.ndarray, lists: int, k: int = 10, seed: int = 3) -> Index:
    """Index from sampled vectors."""
    rng = np.random.default_rng(seed)
    centroids = np.unique(np.stack(_halved(x, min(lists, len(x)), rng)), axis=0)
    for _ in range(2):
        near = _squares(x, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centroids))
        # A centroid keeps its place if it would take more than twice an even share.
        move = (n > 0) & (n <= 2 * len(x) / len(centroids))
        centroids[move] = sums[move] / n[move, None]
    centroids = np.unique(centroids, axis=0)
    gaps = _squares(centroids, centroids)
    graph = np.argsort(gaps, axis=1, kind="stable")[:, 1:DEGREE + 1]
    if graph.shape[1] == 0:
        graph = np.zeros((len(centroids), 1), dtype=int)
    # Every centroid is also reached from the one before it.
    graph = np.concatenate([graph, np.roll(np.arange(len(centroids)), -1)[:, None]], axis=1)
    index = Index(centroids, graph, math.inf)
    if len(x) > k + 1:
        queries = rng.choice(len(x), min(256, len(x)), replace=False)
        gap = _squares(x[queries], x)
        gap[np.arange(len(queries)), queries] = np.inf
        truth = np.argpartition(gap, k - 1, axis=1)[:, :k]
        member = index.lists(x)
        order, dist = index.search(x[queries], len(centroids))
        needed = []
        for q in range(len(queries)):
            away = np.full(len(centroids), np.inf)
            away[order[q]] = dist[q] / max(dist[q, 0], 1e-12)
            needed += [min(away[c] for c in member[t]) for t in truth[q]]
        index.ratio = float(np.quantile(needed, RECALL))
    return index


def _valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part, vectors as doubles."""
    vec = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("id"), vec.alias("vec")).where(
        "id is not null and vec is not null and size(vec) > 0"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(vec, x -> x <> 0)")
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (lengths["n"] if lengths else -1))


def fit(rows: DataFrame, total: int, sample: int = SAMPLE) -> Index:
    """Fit on at most about ``sample`` of the valid rows, chosen by a hash of their id."""
    share = min(1.0, sample / total)
    chosen = rows.where(hash_share(F.col("id"), "neighbours") < share).orderBy("id").toPandas()
    if not len(chosen):
        chosen = pd.DataFrame([rows.orderBy("id").first().asDict()])
    # A repeated id counts once among the k nearest, so it bounds only once.
    chosen = chosen.drop_duplicates("id")
    x = np.stack(chosen["vec"].to_list())
    index = fit_sample(x, int(min(max(math.sqrt(total), LISTS[0]), LISTS[1])))
    index.sample, index.sample_ids = x, chosen["id"].to_numpy()
    return index


def _pieces(series: pd.Series, size: int = 256):
    for at in range(0, len(series), size):
        yield np.stack(series.iloc[at:at + size].to_list()).astype(float)


def build(rows: DataFrame, index: Index) -> DataFrame:
    """Postings (list, first, id, vec); ``first`` marks a vector's nearest list."""

    def place(batches):
        for frame in batches:
            if not len(frame):
                continue
            lists = [p for x in _pieces(frame["vec"]) for p in index.lists(x)]
            frame["list"] = lists
            frame["first"] = [[True] + [False] * (len(p) - 1) for p in lists]
            yield frame.explode(["list", "first"])[["list", "first", "id", "vec"]]

    return rows.mapInPandas(place, "list int, first boolean, id long, vec array<double>")


def nearest(queries: DataFrame, postings: DataFrame, index: Index, k: int = 10) -> DataFrame:
    """The k nearest rows found for each query (id, vec): query_id, rank, vec_id, score."""
    counts = postings.groupBy("list").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("first"), 1)).alias("own")).collect()
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    for row in counts:
        sizes[row["list"]] = row["own"]

    def probe(batches):
        for frame in batches:
            if not len(frame):
                continue
            frame["list"] = [p for x in _pieces(frame["vec"])
                             for p in index.probes(x, sizes, k + 1)]
            ids = frame["id"].to_numpy()
            frame["bound"] = np.concatenate([
                index.bounds(x, ids[256 * i:256 * i + len(x)], k)[0]
                for i, x in enumerate(_pieces(frame["vec"]))])
            yield frame.explode("list")[["list", "id", "vec", "bound"]]

    def sampled(batches):
        for frame in batches:
            if not len(frame):
                continue
            ids, at, out = frame["id"].to_numpy(), 0, []
            for x in _pieces(frame["vec"]):
                own = ids[at:at + len(x)]
                for name, near in zip(own, index.bounds(x, own, k)[1]):
                    out += [(int(name), v, d) for v, d in near]
                at += len(x)
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    asked = queries.mapInPandas(probe, "list int, id long, vec array<double>, bound double")
    waiting = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}
    blocks = {r["list"]: -(-r["n"] // BLOCK_ROWS) for r in counts}
    chunks = {name: -(-n // BLOCK_QUERIES) for name, n in waiting.items()}

    def lookup(values: dict[int, int]) -> Column:
        array = [values.get(i, 1) for i in range(len(index.centroids))]
        return F.element_at(F.lit(array), F.col("list") + 1)

    def salt(values: dict[int, int]) -> Column:
        return F.pmod(F.xxhash64("id"), lookup(values).cast("long")).cast("int")

    def every(values: dict[int, int]) -> Column:
        return F.explode(F.sequence(F.lit(0), lookup(values) - 1))

    # A cell is one block of a list's rows with one chunk of its queries.
    asked = asked.select("list", every(blocks).alias("block"), salt(chunks).alias("chunk"), "id", "vec", "bound")
    held = postings.select("list", salt(blocks).alias("block"), every(chunks).alias("chunk"), "id", "vec")

    def cell(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(one) and len(two):
            y, names = np.stack(two["vec"].to_list()), two["id"].to_numpy()
            at = 0
            for x in _pieces(one["vec"]):
                gap = _squares(x, y)
                slack = 1e-9 * ((x * x).sum(1).max() + (y * y).sum(1).max())
                own = one["id"].to_numpy()[at:at + len(x)]
                gap[gap > one["bound"].to_numpy()[at:at + len(x), None] + slack] = np.inf
                gap[own[:, None] == names[None, :]] = np.inf
                for q in range(len(x)):
                    # The k-th over distinct ids: more rows are taken while ids repeat.
                    want, finite = k, int(np.count_nonzero(np.isfinite(gap[q])))
                    while finite:
                        take = min(want, finite)
                        kth = np.partition(gap[q], take - 1)[take - 1]
                        near = np.flatnonzero((gap[q] <= kth + slack) & np.isfinite(gap[q]))
                        if len(near) == finite or len(np.unique(names[near])) >= k:
                            break
                        want *= 2
                    if not finite:
                        continue
                    exact = np.sqrt(((y[near] - x[q]) ** 2).sum(axis=1))
                    order = np.lexsort((names[near], exact))
                    seen: dict[int, float] = {}
                    for i in order:
                        seen.setdefault(int(names[near[i]]), float(exact[i]))
                        if len(seen) == k:
                            break
                    out += [(int(own[q]), v, d) for v, d in seen.items()]
                at += len(x)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    cells = ["list", "block", "chunk"]
    found = asked.groupBy(*cells).cogroup(held.groupBy(*cells)).applyInPandas(
        cell, "query_id long, vec_id long, score double")
    known = queries.mapInPandas(sampled, "query_id long, vec_id long, score double")
    best = found.union(known).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = best.groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def search(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding",
           k: int = 10) -> DataFrame:
    """Nearest rows of those that ``queries`` (a condition on ``id``) selects, among all rows."""
    rows = _valid(df, key, vector)
    total = rows.count()
    if not total:
        return df.sparkSession.createDataFrame([], RESULT)
    index = fit(rows, total)
    return nearest(rows.where(queries), stored(build(rows, index)), index, k)


def op1_nearest(spark, folder: str) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100."""
    return search(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)
