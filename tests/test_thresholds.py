"""The threshold curve against counting by hand."""

import random

import pytest
from pyspark.sql import functions as F

from textwarden.operators.metrics import best_threshold, threshold_curve

SCHEMA = "s double, e boolean"


def by_hand(rows):
    rows = [(None if s is None or s != s else s, e) for s, e in rows if e is not None]
    out = {}
    for t in {s for s, _ in rows if s is not None}:
        allowed = [(s is not None and s >= t, e) for s, e in rows]
        out[t] = (sum(a for a, _ in allowed), sum(a and e for a, e in allowed),
                  sum(a == e for a, e in allowed), len(rows))
    return out


@pytest.mark.parametrize("values", [7, 500, 100000])
def test_curve(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values) / values, rng.random() < 0.4) for _ in range(900)]
    # A third of all rows share one score.
    rows += [(0.25, rng.random() < 0.5) for _ in range(450)]
    rows += [(None, True), (float("nan"), False), (0.5, None), (0.0, True), (-0.0, False)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    curve = threshold_curve(df, F.col("s"), F.col("e"))
    got = {r["threshold"]: (r["allowed"], r["hits"], r["correct"], r["total"])
           for r in curve.collect()}
    expected = by_hand(rows)
    assert got == expected
    (best,) = best_threshold(curve).collect()
    top = max(c for _, _, c, _ in expected.values())
    assert best["correct"] == top
    assert best["threshold"] == max(t for t, v in expected.items() if v[2] == top)


def test_nothing_to_learn_from(spark):
    for rows in ([], [(None, True)], [(0.5, None)]):
        curve = threshold_curve(spark.createDataFrame(rows, SCHEMA), F.col("s"), F.col("e"))
        assert curve.collect() == [] and best_threshold(curve).collect() == []
