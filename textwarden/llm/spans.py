"""Digest columns of span lists, made with column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest_columns(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """Counts of base spans per kind, hash of the base spans, and all spans as a string.

    ``spans`` is a struct of parallel arrays kind, start, end and base, in output order.
    """
    rows = F.arrays_zip(f"{spans}.kind", f"{spans}.start", f"{spans}.end", f"{spans}.base")

    def joined(array: Column) -> Column:
        return F.array_join(F.transform(
            array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter(rows, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in kinds]
    return [*counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(rows).alias("spans")]
