"""Which column holds the text under test.

A column that is absent or NULL counts as an absent field.  An empty string is present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _field(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _last_message(df: DataFrame, name: str = "messages") -> Column:
    """Content of the last message; '' when it has none, NULL when there are no messages."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    last = F.try_element_at(F.col(name), F.lit(-1))
    element = df.schema[name].dataType.elementType
    content = last["content"] if element.typeName() == "struct" else last
    return F.when(F.size(F.col(name)) > 0, F.coalesce(content, F.lit("")))


def content_input(df: DataFrame) -> Column:
    """A request's text: input, else the last message, else content, else ''."""
    return F.coalesce(
        _field(df, "input"), _last_message(df), _field(df, "content"), F.lit("")
    )


def content_output(df: DataFrame) -> Column:
    """An answer's text: the last message, else output, else content, else ''."""
    return F.coalesce(
        _last_message(df), _field(df, "output"), _field(df, "content"), F.lit("")
    )


def content_code(df: DataFrame) -> Column:
    """Code under test: code, else generated_code, else the request's text."""
    return F.coalesce(_field(df, "code"), _field(df, "generated_code"), content_input(df))


def request_metadata(df: DataFrame, name: str = "metadata") -> Column:
    """The request's metadata map, empty when there is none."""
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.col(name), empty) if name in df.columns else empty


def last_turns(
    turns: DataFrame, conversation: str = "conv_id", order: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """The last turn of each conversation kept one row per turn.

    The maximum is combined before the shuffle, so a conversation of any length
    sends one row per input partition.
    """
    last = turns.groupBy(conversation).agg(
        # One row wins whole; equal turns are told apart by role and text.
        F.max(F.struct(order, role, text)).alias("__last")
    )
    return last.select(conversation, "__last.*")
