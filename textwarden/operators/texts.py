"""Long texts set aside while the rows around them are shuffled.

A log often sends the same text many times.  Rows that carry a digest in its place are small
to shuffle, sort and keep in a state; the texts come back from a table that holds each of them
at least once.  There they are moved once per table row, however often the log sends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGEST_BYTES = 32


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def set_aside(df: DataFrame, text_col: str, ref: str, id_col: str) -> DataFrame:
    """A digest, in column ``ref``, in place of the text.

    Without a text a shorter value made of the id stands there: NULL would send all such rows
    to one task of the join.
    """
    no_text = F.encode(F.xxhash64(id_col).cast("string"), "utf-8")
    return df.withColumn(ref, F.coalesce(_digest(F.col(text_col)), no_text)).drop(text_col)


def bring_back(df: DataFrame, texts: DataFrame, text_col: str, ref: str) -> DataFrame:
    """The texts again, from column ``text_col`` of ``texts``, in place of their digests.

    A text that ``texts`` lacks is an error, never NULL.  The join is by sorting, whatever the
    size of the table: no task holds all texts, and copies come out, and are written, side by
    side, where they compress to little.
    """
    each = (
        texts.select(_digest(F.col(text_col)).alias(ref), text_col).where(F.col(ref).isNotNull())
        .groupBy(ref).agg(F.first(text_col).alias(text_col))
    )
    lost = F.when(
        F.length(ref) == _DIGEST_BYTES,
        F.raise_error(F.lit("a text of the log is not among those to take it from")).cast("string"))
    return (
        df.join(each.hint("merge"), ref, "left")
        .withColumn(text_col, F.coalesce(F.col(text_col), lost)).drop(ref)
    )
