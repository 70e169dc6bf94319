"""Similarity of embeddings to topics.

Rows are scored in Arrow batches against a shared topic matrix: no shuffle, no row is
repeated per topic, and only the embedding column travels to Python.  Topics are sent to
executors in groups of bounded size; when one group cannot hold them all, the groups are
scored in successive passes that carry the best topic so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder
from .batch import call_per_text
from .stage import ALLOW, BLOCK, WARN, Stage, Verdict, add_verdict

# Bytes of topic vectors shared with every executor at a time.
TOPIC_GROUP_BYTES = 128 << 20
# Similarities held at once while scoring a batch.
_CELLS = 4_000_000

_SCORE = T.StructType(
    [
        T.StructField("best", T.DoubleType()),
        T.StructField("topic", T.StringType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("all", T.ArrayType(T.DoubleType())),
        T.StructField("error", T.StringType()),
    ]
)


_VECTOR = T.ArrayType(T.FloatType())
Embedder = Callable[[list[str]], Sequence]


@dataclass(frozen=True)
class Topic:
    name: str
    embedding: Sequence[float]


def embed_column(
    df: DataFrame,
    text_col: str,
    embed: Callable[[list[str]], Sequence],
    out_col: str = "embedding",
    **options,
) -> DataFrame:
    """Add the embedding of a text column; ``{out_col}_error`` where embedding failed.

    ``embed`` maps a list of texts to one vector each.  It is called on executors, so a
    model it loads on first use is loaded once per worker.
    """
    answer = f"__{out_col}_answer"
    df = call_per_text(df, F.col(text_col), embed, _VECTOR, answer, vectors=True, **options)
    got = F.col(answer)
    return df.withColumns({out_col: got["value"], f"{out_col}_error": got["error"]}).drop(answer)


def embed_topics(descriptions: Sequence[str], embed: Callable[[list[str]], Sequence]) -> list[Topic]:
    """Topics from their descriptions, embedded once when the query is built."""
    if not descriptions:
        return []
    return [Topic(d, list(v)) for d, v in zip(descriptions, embed(list(descriptions)))]


def _topic_stream(topics: DataFrame | Iterable[Topic]) -> Iterator[Topic]:
    if isinstance(topics, DataFrame):
        rows = topics.select("topic_idx", "topic", "embedding").orderBy("topic_idx")
        for row in rows.toLocalIterator():
            yield Topic(row.topic, row.embedding)
    else:
        yield from topics


def _groups(topics: DataFrame | Iterable[Topic], limit: int) -> Iterator[list[Topic]]:
    group: list[Topic] = []
    size = 0
    for topic in _topic_stream(topics):
        width = 8 * len(topic.embedding)
        if group and size + width > limit:
            yield group
            group, size = [], 0
        group.append(topic)
        size += width
    if group:
        yield group


def _scores(vectors: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Cosines of rows and topics; 0 where a vector has no length."""
    lengths = np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(matrix, axis=1)[None, :]
    dots = vectors @ matrix.T
    return np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths != 0)


def _score_udf(group: list[Topic], spark, keep_all: bool):
    names = [t.name for t in group]
    width = len(group[0].embedding)
    if any(len(t.embedding) != width for t in group):
        raise ValueError("topic embeddings differ in length")
    # Equal topics are scored once, so that they tie exactly and the first one wins.
    distinct, position = np.unique(
        np.array([t.embedding for t in group], dtype=np.float64), axis=0, return_inverse=True
    )
    shared = spark.sparkContext.broadcast((names, distinct, position.reshape(-1)))

    @F.arrow_udf(_SCORE)
    def score(embeddings: pa.Array) -> pa.Array:
        names, matrix, position = shared.value
        n = len(embeddings)
        lengths = np.diff(embeddings.offsets.to_numpy()) if n else np.zeros(0, dtype=int)
        present = np.asarray(embeddings.is_valid())
        flat = embeddings.flatten()
        usable = present & (lengths == width)
        if flat.null_count:
            holes = np.asarray(flat.is_null())
            owner = np.repeat(np.arange(n)[present], lengths[present])
            usable[np.unique(owner[holes])] = False
        kept = np.flatnonzero(usable)
        picked = embeddings.take(pa.array(kept)).flatten()
        vectors = picked.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        best, which, total = np.zeros(n), np.zeros(n, dtype=int), np.zeros(n)
        everything = []
        step = max(_CELLS // len(names), 1)
        for at in range(0, len(kept), step):
            part = _scores(vectors[at:at + step], matrix)[:, position]
            rows = kept[at:at + step]
            which[rows] = part.argmax(axis=1)
            best[rows] = part.max(axis=1)
            total[rows] = part.sum(axis=1)
            if keep_all:
                everything.append(part.ravel())
        off = ~usable
        sizes = np.where(usable, len(names), 0)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        if keep_all:
            cells = np.concatenate(everything) if everything else np.zeros(0)
            every = pa.ListArray.from_arrays(
                pa.array(offsets, mask=np.append(off, False)), pa.array(cells))
        else:
            every = pa.nulls(n, pa.list_(pa.float64()))
        bad = present & off
        errors = [
            f"embedding has {size} dimensions, topics have {width}" if size != width
            else "embedding holds NULL"
            for size in lengths[bad]
        ]
        error = np.full(n, None, dtype=object)
        error[bad] = errors
        return pa.StructArray.from_arrays(
            [
                pa.array(best, mask=off),
                pa.array([names[i] if ok else None for i, ok in zip(which, usable)], pa.string()),
                pa.array(total, mask=off),
                every,
                pa.array(error, pa.string()),
            ],
            names=[f.name for f in _SCORE],
        )

    return score


def score_topics(
    df: DataFrame,
    embedding: Column,
    topics: DataFrame | Iterable[Topic],
    out_col: str,
    *,
    aggregation: str = "max",
    keep_all: bool = True,
    group_bytes: int = TOPIC_GROUP_BYTES,
    failure: Column | None = None,
) -> DataFrame:
    """Add ``struct<score, topic, all, error>`` of an embedding against all topics.

    A NULL embedding gets no score but an error: ``failure``, what kept the row from being
    embedded, or that there is none.  With ``max`` the first topic of the highest similarity
    is named.
    """
    running: Column | None = None
    count, groups = 0, 0
    pending = _groups(topics, group_bytes)
    group = next(pending, None)
    while group is not None:
        following = next(pending, None)
        fresh, name = f"__{out_col}_{groups}", f"__{out_col}_so_far"
        df = df.withColumn(
            fresh, _score_udf(group, df.sparkSession, keep_all)(embedding)
        )
        now = F.col(fresh)
        if running is None:
            df = df.withColumn(name, now)
        else:
            merged = F.struct(
                F.greatest(running["best"], now["best"]).alias("best"),
                F.when(now["best"] > running["best"], now["topic"])
                .otherwise(running["topic"]).alias("topic"),
                (running["total"] + now["total"]).alias("total"),
                F.concat(running["all"], now["all"]).alias("all"),
                F.coalesce(running["error"], now["error"]).alias("error"),
            )
            df = df.withColumn(name, merged)
        df = df.drop(fresh)
        running = F.col(name)
        count += len(group)
        groups += 1
        if following is not None:
            # One group of topics in memory at a time: finish this pass first.
            folder = scratch_folder(df.sparkSession)
            df.write.parquet(folder)
            df = df.sparkSession.read.schema(df.schema).parquet(folder)
        group = following
    problem = None
    if count == 0:
        problem = "no topics given"
    elif aggregation not in ("max", "mean"):
        problem = f"Unknown aggregation method: {aggregation}"
    if problem:
        empty = F.struct(
            F.lit(None).cast("double").alias("score"),
            F.lit(None).cast("string").alias("topic"),
            F.lit(None).cast("array<double>").alias("all"),
            (F.lit(problem) if failure is None else F.coalesce(failure, F.lit(problem)))
            .alias("error"),
        )
        df = df.withColumn(out_col, empty)
    else:
        mean = aggregation == "mean"
        df = df.withColumn(
            out_col,
            F.struct(
                (running["total"] / count if mean else running["best"]).alias("score"),
                (F.lit(None).cast("string") if mean else running["topic"]).alias("topic"),
                running["all"].alias("all"),
                F.coalesce(
                    running["error"], F.lit(None).cast("string") if failure is None else failure,
                    F.when(embedding.isNull(), "no embedding")
                ).alias("error"),
            ),
        )
    return df.drop(f"__{out_col}_so_far")


def _three(score: Column) -> Column:
    return F.format_string("%.3f", score)


class _SemanticStage(Stage):
    """What both checks share: where a row's embedding and the topics' come from."""

    def __init__(self, name: str, embedding_col: str, embed: Embedder | None, options: dict):
        super().__init__(name)
        self.embedding_col, self.embed = embedding_col, embed
        self.options = {"share": "batch", **options}

    def _embedded(
        self, df: DataFrame, text_col: str, active: Column | None
    ) -> tuple[DataFrame, Column, Column | None, list[str]]:
        """The rows with their embeddings, what went wrong, and columns to drop afterwards.

        With ``embed``, the text is embedded as the stages before left it, and only where
        they did not block.
        """
        if self.embed is None:
            vector = F.col(self.embedding_col)
            return df, vector if active is None else F.when(active, vector), None, []
        answer, text = f"__{self.name}_embedded", F.col(text_col)
        df = call_per_text(
            df, text if active is None else F.when(active, text), self.embed, _VECTOR, answer,
            vectors=True, **self.options)
        return df, F.col(answer)["value"], F.col(answer)["error"], [answer]

    def _topics(
        self, topics: DataFrame | Sequence[Topic | str], failure: Column | None
    ) -> tuple[DataFrame | Sequence[Topic], Column | None]:
        """Topics, described ones embedded; if that fails, every row has the failure."""
        if isinstance(topics, DataFrame) or not any(isinstance(t, str) for t in topics):
            return topics, failure
        if self.embed is None:
            raise ValueError("topics given as descriptions need embed")
        try:
            return embed_topics(topics, self.embed), failure
        except Exception as error:  # the user's function; checks fail open
            return [], F.lit(str(error))


class SemanticTopic(_SemanticStage):
    """Allow rows whose embedding is similar enough to the topics, block the others.

    Rows bring their embedding in ``embedding_col``, or ``embed`` makes it from the text when
    the check runs; then topics may be descriptions.  ``embed_options`` go to
    ``call_per_text``: by default each Arrow batch embeds its distinct texts, without a
    shuffle.  Anything that prevents a score is a warning: checks fail open.
    """

    def __init__(
        self,
        topics: DataFrame | Sequence[Topic | str],
        similarity_threshold: float = 0.75,
        aggregation: str = "max",
        embedding_col: str = "embedding",
        keep_all: bool = True,
        name: str = "SemanticSimilarity",
        group_bytes: int = TOPIC_GROUP_BYTES,
        embed: Embedder | None = None,
        **embed_options,
    ):
        super().__init__(name, embedding_col, embed, embed_options)
        self.topics, self.threshold, self.aggregation = topics, similarity_threshold, aggregation
        self.keep_all, self.group_bytes = keep_all, group_bytes

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        found = f"__{self.name}_score"
        df, embedding, failure, temporary = self._embedded(df, text_col, active)
        topics, failure = self._topics(self.topics, failure)
        df = score_topics(
            df, embedding, topics, found, aggregation=self.aggregation, keep_all=self.keep_all,
            group_bytes=self.group_bytes, failure=failure,
        )
        return add_verdict(df, self.name, text_col, active, self._decide(F.col(found))).drop(
            found, *temporary)

    def _decide(self, found: Column) -> Verdict:
        return _topic_verdict(found, self.threshold)


def _topic_verdict(found: Column, threshold: float) -> Verdict:
    score, error = found["score"], found["error"]
    near = score >= threshold
    return Verdict(
        F.when(error.isNotNull(), WARN).when(near, ALLOW).otherwise(BLOCK),
        F.when(error.isNotNull(), F.concat(F.lit("Semantic similarity check failed: "), error))
        .when(near, F.concat(F.lit("Topic match (similarity: "), _three(score), F.lit(")")))
        .otherwise(
            F.concat(F.lit("Off-topic (similarity: "), _three(score), F.lit(f" < {threshold})"))
        ),
        F.struct(
            score.alias("similarity_score"),
            found["all"].alias("all_similarities"),
            F.when(near, found["topic"]).alias("matched_topic"),
            F.when(error.isNull(), F.lit(float(threshold))).alias("threshold"),
            error.alias("error"),
        ),
    )


class SemanticAllowBlock(_SemanticStage):
    """Block rows similar to a blocked topic; otherwise the allowed topics decide.

    Both topic sets are scored in the same pass, with one embedding of a text.  A row whose
    blocked topics cannot be scored is not blocked for it.
    """

    def __init__(
        self,
        allowed_topics: DataFrame | Sequence[Topic | str],
        blocked_topics: DataFrame | Sequence[Topic | str] | None = None,
        allow_threshold: float = 0.70,
        block_threshold: float = 0.75,
        embedding_col: str = "embedding",
        keep_all: bool = True,
        name: str = "MultiModalSemantic",
        embed: Embedder | None = None,
        **embed_options,
    ):
        super().__init__(name, embedding_col, embed, embed_options)
        self.allowed, self.blocked = allowed_topics, blocked_topics
        self.allow_threshold, self.block_threshold = allow_threshold, block_threshold
        self.keep_all = keep_all

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        near, far = f"__{self.name}_allow", f"__{self.name}_block"
        df, embedding, failure, temporary = self._embedded(df, text_col, active)
        topics, problem = self._topics(self.allowed, failure)
        df = score_topics(
            df, embedding, topics, near, keep_all=self.keep_all, failure=problem)
        allow = _topic_verdict(F.col(near), self.allow_threshold)
        if self.blocked is None or (isinstance(self.blocked, Sequence) and not self.blocked):
            return add_verdict(df, self.name, text_col, active, allow).drop(near, *temporary)
        topics, problem = self._topics(self.blocked, failure)
        df = score_topics(df, embedding, topics, far, keep_all=self.keep_all, failure=problem)
        block = _topic_verdict(F.col(far), self.block_threshold)
        score = F.col(far)["score"]
        hit = F.coalesce(F.col(far)["error"].isNull() & (score >= self.block_threshold), F.lit(False))
        said = F.concat(
            F.lit("Content matches blocked topic (similarity: "), _three(score), F.lit(")")
        )
        verdict = Verdict(
            F.when(hit, BLOCK).otherwise(allow.action),
            F.when(hit, said).otherwise(allow.reason),
            F.when(hit, block.metadata).otherwise(allow.metadata),
        )
        return add_verdict(df, self.name, text_col, active, verdict).drop(near, far, *temporary)
