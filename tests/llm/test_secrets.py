"""Guess costs against exhaustive segmentation, at every length; words of the documents."""

import math
import random
import time
from itertools import combinations

import pytest

from textwarden.llm import secret_scan
from textwarden.llm.secret_scan import Ranks, default_ranks, log_guesses, special_parts

RANKS = Ranks(default_ranks())


def exhaustive(value):
    """The cheapest of all segmentations, tried one by one."""
    n, brute = len(value), math.log10(secret_scan._charset(value))
    cost = {(i, j): (j - i) * brute for i in range(n) for j in range(i + 1, n + 1)}
    for i, j, c in special_parts(value, RANKS):
        cost[i, j] = min(cost[i, j], c)
    best = math.inf
    for k in range(1, n + 1):
        for cuts in combinations(range(1, n), k - 1):
            edges = (0, *cuts, n)
            total = sum(cost[a, b] for a, b in zip(edges, edges[1:]))
            best = min(best, total + math.log10(math.factorial(k)))
    return best


def all_rows(value):
    """The same by every row of the dynamic programme."""
    n, brute = len(value), math.log10(secret_scan._charset(value))
    into = {}
    for i, j, c in special_parts(value, RANKS):
        into.setdefault(j, []).append((i, c))
    before, best = [0.0] + [math.inf] * n, math.inf
    for k in range(1, n + 1):
        row = [math.inf] * (n + 1)
        for j in range(1, n + 1):
            row[j] = min([before[i] + (j - i) * brute for i in range(j)]
                         + [before[i] + c for i, c in into.get(j, [])])
        best, before = min(best, row[n] + math.log10(math.factorial(k))), row
    return best


PIECES = ["password", "qwerty", "2024-05-01", "1999", "abcd", "9876", "aaaa", "xyxyxy", "drowssap",
          "p@ssw0rd", "the", "Love", "X", "7", "kq", "=", "İ", "ß", "asdf"]


@pytest.mark.parametrize("seed", range(60))
def test_cost_equals_exhaustive_segmentation(seed):
    rng = random.Random(seed)
    value = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 4)))[:10]
    assert log_guesses(value, RANKS) == pytest.approx(exhaustive(value), abs=1e-9)


@pytest.mark.parametrize("seed", range(12))
def test_cost_of_long_values(seed):
    rng = random.Random(seed)
    value = "".join(rng.choice(PIECES + ["the", "of", "and"] * 5) for _ in range(rng.randint(20, 45)))
    assert log_guesses(value, RANKS) == pytest.approx(all_rows(value), abs=1e-9)


def test_no_switch_of_length():
    for unit in ("a", "=", "ab", "-=", "pass"):
        costs = [log_guesses(unit * k, RANKS) for k in (20, 60, 130, 500)]
        assert costs == sorted(costs) and costs[-1] < secret_scan.MIN_LOG_GUESSES, unit
    assert secret_scan.all_spans("login: " + "=" * 130, RANKS) == []
    rng = random.Random(3)
    value = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789") for _ in range(300))
    ((kind, a, b, _, cost),) = secret_scan.all_spans("login: " + value, RANKS)
    assert (kind, a, b) == ("guess", 7, 307) and 300 < cost < 300 * math.log10(62)


@pytest.mark.parametrize("value", ["-=" * 10_000, "a" * 20_000, "thepassword" * 2_000])
def test_very_long_values_end(value):
    began = time.time()
    assert log_guesses(value, RANKS) > 0
    assert time.time() - began < 60


def test_words_that_most_documents_hold(spark):
    rows = []
    for i in range(60):
        words = ["everywhere"] + ["half"] * (i % 2) + ["third"] * (i % 3 == 0) + ["rare"] * (i == 4)
        rows.append((i, " ".join(words * 2)))
    df = spark.createDataFrame([*rows, (99, None), (100, "")], "doc_id long, text string")
    assert secret_scan.document_words(df) == ["everywhere", "half", "third"]
    assert secret_scan.document_words(df, most=2) == ["everywhere", "half"]
    assert secret_scan.document_words(df, most=0) == []
    # Words in equally many documents stay or go together.
    even = spark.createDataFrame([(i, "alpha beta gamma") for i in range(12)], df.schema)
    assert secret_scan.document_words(even, most=2) == []
    assert secret_scan.document_words(even, most=3) == ["alpha", "beta", "gamma"]


def test_counts_beyond_the_exact_range(spark):
    df = spark.range(9000).selectExpr(
        "id as doc_id", "concat('all ', if(id < 8000, 'most ', ''), if(id < 20, 'few', '')) as text")
    assert secret_scan.document_words(df) == ["all", "most", "few"]
    assert secret_scan.document_words(df, most=1) == ["all"]
