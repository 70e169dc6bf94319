"""Calling a user's batch function on a text column, each distinct text once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder
from .replies import ReplyStore


def _batched(fn: Callable[[list[str]], Sequence], schema: T.StructType, batch_size: int):
    """Arrow function: struct of one value and one error per text, NULL texts left out.

    ``fn`` gets up to ``batch_size`` distinct texts.  It answers with one value per text;
    an exception object in place of a value, or raised for the whole batch, becomes data,
    so one bad reply fails no task.
    """

    def call(texts: list[str]) -> dict[str, tuple]:
        try:
            values = list(fn(texts))
            if len(values) != len(texts):
                raise ValueError(f"{len(values)} answers for {len(texts)} texts")
        except Exception as error:  # the user's function: any failure is an answer
            values = [error] * len(texts)
        return {
            text: (None, str(value)) if isinstance(value, Exception) else (value, None)
            for text, value in zip(texts, values)
        }

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            wanted = series.dropna().unique().tolist()
            answers: dict = {}
            for at in range(0, len(wanted), batch_size):
                answers.update(call(wanted[at:at + batch_size]))
            rows = [answers.get(text, (None, None)) for text in series]
            yield pd.DataFrame(
                {"value": pd.Series([r[0] for r in rows], dtype=object),
                 "error": pd.Series([r[1] for r in rows], dtype=object)}
            )

    # A model may answer differently each time: never move or repeat the call.
    return F.pandas_udf(run, schema).asNondeterministic()


def _vector_rows(answers: Sequence, n: int) -> tuple[pa.Array, list[str | None]]:
    """Vectors of ``n`` texts as one Arrow list array, and what went wrong instead.

    A matrix becomes the array's values as it is; no row turns into a Python list.
    """
    if len(answers) != n:
        raise ValueError(f"{len(answers)} answers for {n} texts")
    if isinstance(answers, np.ndarray) and answers.ndim == 2:
        matrix = np.ascontiguousarray(answers, dtype=np.float32)
        ends = np.arange(n + 1, dtype=np.int32) * matrix.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel())), [None] * n
    errors: list[str | None] = [None] * n
    rows: list[np.ndarray] = []
    for i, answer in enumerate(answers):
        row = np.zeros(0, np.float32)
        if isinstance(answer, Exception):
            errors[i] = str(answer)
        else:
            try:
                row = np.asarray(answer, dtype=np.float32).reshape(-1)
            except (TypeError, ValueError) as error:
                errors[i] = str(error)
        rows.append(row)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    missing = np.array([e is not None for e in errors] + [False])
    values = np.concatenate(rows) if rows else np.zeros(0, np.float32)
    return pa.ListArray.from_arrays(pa.array(ends, mask=missing), pa.array(values)), errors


def _batched_vectors(fn: Callable[[list[str]], Sequence], schema: T.StructType, batch_size: int):
    """As ``_batched``, for functions that answer with one vector per text."""
    kind = pa.list_(pa.float32())

    def call(texts: list[str]) -> tuple[pa.Array, list[str | None]]:
        try:
            return _vector_rows(fn(texts), len(texts))
        except Exception as error:  # the user's function: any failure is an answer
            return pa.nulls(len(texts), kind), [str(error)] * len(texts)

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            coded = texts.dictionary_encode()
            wanted = coded.dictionary.to_pylist()
            parts = [call(wanted[at:at + batch_size]) for at in range(0, len(wanted), batch_size)]
            vectors = pa.concat_arrays([v for v, _ in parts]) if parts else pa.nulls(0, kind)
            errors = pa.array([e for _, some in parts for e in some], pa.string())
            yield pa.StructArray.from_arrays(
                [vectors.take(coded.indices), errors.take(coded.indices)],
                names=["value", "error"])

    return run.asNondeterministic()


def call_per_text(
    df: DataFrame,
    text: Column,
    fn: Callable[[list[str]], Sequence],
    value_type: T.DataType,
    out_col: str,
    *,
    share: str = "table",
    batch_size: int = 64,
    concurrency: int | None = None,
    store: bool = False,
    replies: ReplyStore | None = None,
    settings: str = "",
    vectors: bool = False,
) -> DataFrame:
    """Add ``out_col struct<value, error>``; NULL text is not sent and gets NULL.

    ``share="table"`` sends each distinct text of the table once, at the price of a
    shuffle for the distinct texts and one for the join back.  ``share="batch"`` needs no
    shuffle and only saves repeats within an Arrow batch: right for cheap functions.
    ``concurrency`` is the number of tasks calling the function at a time.  ``store``
    writes the answers to the shared scratch folder, so that several uses of the result
    see the same ones; ``replies`` keeps them in a lasting store, under the text and
    ``settings``, and asks only what is not there yet.  ``vectors`` says that ``fn`` answers
    with vectors, one array each or a matrix: they go back as Arrow arrays.
    """
    schema = T.StructType(
        [T.StructField("value", value_type), T.StructField("error", T.StringType())]
    )
    call = (_batched_vectors if vectors else _batched)(fn, schema, batch_size)
    if share == "batch":
        if store or replies is not None:
            raise ValueError('storing answers needs share="table"')
        return df.withColumn(out_col, call(text))
    if share != "table":
        raise ValueError(f'share must be "table" or "batch", not {share!r}')

    sent, key = f"__{out_col}_text", f"__{out_col}_key"
    df = df.withColumn(sent, text)
    # Distinct over the one column: combined in each task before the shuffle, so a text
    # that makes up a third of the table leaves each task once.
    texts = df.select(sent).filter(F.col(sent).isNotNull()).distinct()
    told = F.sha2(F.col(sent), 256) if replies is None else replies.key(F.col(sent), settings)
    if replies is not None:
        asked = texts.select(told.alias("key"), F.col(sent).alias("text"))
        answers = replies.ask(asked, call, schema).toDF(key, out_col)
    else:
        if concurrency:
            texts = texts.repartition(concurrency)
        answers = texts.withColumn(out_col, call(F.col(sent))).select(told.alias(key), out_col)
    if store:
        folder = scratch_folder(df.sparkSession)
        answers.write.parquet(folder)
        answers = df.sparkSession.read.schema(answers.schema).parquet(folder)
    # Joined back on a digest rather than on whole texts; a text shared by many rows is split
    # by the adaptive skew join, its other side being a single row.
    return df.withColumn(key, scattered_key(df, told)).join(answers, key, "left").drop(key, sent)


def scattered_key(df: DataFrame, digest: Column) -> Column:
    """The digest to join by; rows without one get keys of their own that match nothing, or
    they would all meet in one partition.

    The keys depend on nothing but the row, so a task that runs again sends each row to the
    same place.
    """
    hashable = [
        f.name for f in df.schema
        if not {"map", "variant"} & set(re.findall(r"\w+", f.dataType.simpleString()))
    ]
    return F.coalesce(digest, F.concat(F.lit("-"), F.xxhash64(*hashable).cast("string")))
