"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import get_ident

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder


# Spark's setting to remove a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes that Spark gathers for a Python function at once; what a task holds on both sides.
FRAME_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Narrow rows that one task writes.
FILE_ROWS = 1 << 16
_SETTINGS = {CLEANUP: "true", FRAME_BYTES: str(1 << 22)}


# By thread: the folders written in each block of ``steps`` that is open, outermost first.
_BLOCKS: dict[int, tuple[list[str], ...]] = {}


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block at whose end all that was ``stored`` in it is removed from the scratch folder.

    It gives the function to store what is read after its end: such rows stay, or go with the
    block around this one.
    """
    me, own = get_ident(), []
    around = _BLOCKS.get(me, ())

    def keep(df: DataFrame, rows: int | None = None) -> DataFrame:
        now, _BLOCKS[me] = _BLOCKS[me], around
        try:
            return stored(df, rows)
        finally:
            _BLOCKS[me] = now

    _BLOCKS[me] = (*around, own)
    try:
        yield keep
    finally:
        if around:
            _BLOCKS[me] = around
        else:
            del _BLOCKS[me]
        for folder in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows written to the shared scratch folder and read back: cuts lineage, survives
    lost executors, and is computed once however often it is read.

    What was shuffled to make them is removed as soon as they are written; otherwise the
    shuffles of all steps would lie on the executors' disks until the driver collects garbage.
    Python functions get frames of few bytes: ten thousand whole texts are much for a task.
    ``rows`` is a bound of their number, for narrow rows of a light last step: they are written
    by a task for ``FILE_ROWS`` of them, or one for each core, and not by one for each partition.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, rows // FILE_ROWS))
    folder, before = scratch_folder(spark), {k: spark.conf.get(k, None) for k in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    if blocks := _BLOCKS.get(get_ident()):
        blocks[-1].append(folder)
    try:
        df.write.parquet(folder)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def per_text(fn: Callable[[list[str | None]], pd.DataFrame], schema: str):
    """Arrow function over a text column: struct of ``schema`` per text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield fn([t if isinstance(t, str) else None for t in series])

    # Costly: never evaluated twice for one row by a filter pushed below it.
    return F.pandas_udf(run, schema).asNondeterministic()


def annotate(df: DataFrame, text: str | Column, out_col: str, fn, schema: str) -> DataFrame:
    """Add one struct column; a column of that name is replaced, all others stay."""
    column = F.col(text) if isinstance(text, str) else text
    return df.withColumn(out_col, per_text(fn, schema)(column))


def hash_share(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key only, for bounded samples."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)) / F.lit(float(1 << 40))


_LETTERS: list[np.ndarray] = []


def letters_of(points: np.ndarray) -> np.ndarray:
    """Code points with a blank for whatever is not a letter."""
    if not _LETTERS:
        # Planes 0 and 1; what is assigned above them are letters.
        _LETTERS.append(np.array([c if chr(c).isalpha() else 32 for c in range(0x20000)], np.uint32))
    low = points < 0x20000
    if low.all():
        return _LETTERS[0][points]
    return np.where(low, _LETTERS[0][np.where(low, points, 32)], points)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, wrapping arithmetic."""
    h = h.astype(np.uint64, copy=False)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
