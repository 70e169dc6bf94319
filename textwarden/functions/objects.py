"""JSON objects inside text.

Spark's JSON functions accept input Python's parser rejects (trailing text, single
quotes), so the parse itself is one small Arrow function.  Everything around it,
including cutting the object out of the text, stays in the JVM, and texts without
braces never leave it.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_STRINGS_ARROW = pa.list_(pa.string())
_OBJECT = T.StructType().add("json", T.StringType()).add("keys", _STRINGS)
_VERDICT = (
    T.StructType()
    .add("json", T.StringType())
    .add("has_is_safe", T.BooleanType())
    .add("unsafe", T.BooleanType())
    .add("reason", T.StringType())
    .add("confidence", T.DoubleType())
    .add("confidence_ok", T.BooleanType())
    .add("violations", _STRINGS)
    .add("violations_ok", T.BooleanType())
    .add("metadata_ok", T.BooleanType())
)


def json_slice(text: Column) -> Column:
    """The text from the first ``{`` to the last ``}``, NULL when there is none."""
    start = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1
    both = F.contains(text, F.lit("{")) & F.contains(text, F.lit("}"))
    return F.when(both & (end >= start), F.substring(text, start, end - start + 1))


def _loads(text):
    try:
        value = json.loads(text)
        json.dumps(value)  # what nests too deep to be written again is no object either
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _number(value) -> float | None:
    """The value as a double; None for what is no number or too large for one."""
    try:
        return float(value) if isinstance(value, (int, float)) else None
    except OverflowError:
        return None


def _storable(text: str) -> str:
    """Lone surrogates, which JSON escapes can name, become question marks."""
    return text.encode("utf-8", "replace").decode()


def _verdict_row(text):
    value = _loads(text) if text is not None else None
    if value is None:
        return (None,) * len(_VERDICT)
    confidence = _number(value.get("confidence", 1.0))
    violations = value.get("violations", [])
    violations = list(violations) if isinstance(violations, str) else violations
    listed = isinstance(violations, list) and all(isinstance(v, str) for v in violations)
    reason = value.get("reason", "No reason provided")
    return (
        json.dumps(value),
        "is_safe" in value,
        not value.get("is_safe", True),
        _storable(reason if isinstance(reason, str) else str(reason)),
        confidence,
        confidence is not None,
        [_storable(v) for v in violations] if listed else None,
        listed,
        isinstance(value.get("metadata", {}), dict),
    )


@F.arrow_udf(_OBJECT)
def _parse_object(texts: pa.Array) -> pa.Array:
    values = [None if t is None else _loads(t) for t in texts.to_pylist()]
    return pa.StructArray.from_arrays(
        [
            pa.array([None if v is None else json.dumps(v) for v in values], pa.string()),
            pa.array([None if v is None else [_storable(k) for k in v] for v in values], _STRINGS_ARROW),
        ],
        names=_OBJECT.fieldNames(),
    )


@F.arrow_udf(_VERDICT)
def _parse_verdict(texts: pa.Array) -> pa.Array:
    columns = zip(*[_verdict_row(t) for t in texts.to_pylist()])
    kinds = (
        pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.float64(), pa.bool_(),
        _STRINGS_ARROW, pa.bool_(), pa.bool_(),
    )
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
    if not arrays:
        arrays = [pa.nulls(0, kind) for kind in kinds]
    return pa.StructArray.from_arrays(arrays, names=_VERDICT.fieldNames())


def extract_json(text: Column) -> Column:
    """``struct<json, keys>`` of the object in the text; both NULL when it does not parse."""
    return _parse_object(json_slice(text))


def read_verdict(text: Column) -> Column:
    """The fields of a model's JSON reply, with Python's notion of truth for ``is_safe``."""
    return _parse_verdict(json_slice(text))
