import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from textwarden.operators.ratelimit import Limits, RateLimit, judge_run, rate_limit

SECOND = 1_000_000


def by_hand(requests, minute, hour):
    """The rule, request by request: id -> (result, reason, hour count, minute count)."""
    history, out = {}, {}
    for rid, user, us, active in sorted(requests, key=lambda r: (r[2], r[0])):
        if not active:
            out[rid] = (None, None, None, None)
            continue
        seen = history.setdefault("anonymous" if user is None else user, deque())
        while seen and us - seen[0] > 3600 * SECOND:
            seen.popleft()
        recent = sum(1 for t in seen if us - t < 60 * SECOND)
        if hour and len(seen) >= hour:
            out[rid] = ("block", f"Rate limit exceeded: {hour} requests per hour", len(seen), None)
        elif minute and recent >= minute:
            out[rid] = ("block", f"Rate limit exceeded: {minute} requests per minute", None, recent)
        else:
            seen.append(us)
            out[rid] = ("allow", "Rate limit check passed", None, None)
    return out


def by_spark(spark, requests, minute, hour, **options):
    df = spark.createDataFrame(requests, "id long, user_id string, ts long, active boolean")
    stage = RateLimit(minute, hour, **options)
    out = stage.apply(df.repartition(5), "", F.col("active")).collect()
    assert len(out) == len(requests)
    return {
        r.id: (r.RateLimit_result, r.RateLimit_reason,
               r.RateLimit_metadata and r.RateLimit_metadata.requests_count,
               r.RateLimit_metadata and r.RateLimit_metadata.requests_last_minute)
        for r in out
    }


def requests(seed, n, users, spacing, inactive=0.0):
    """Random requests; many ties and exact distances of 60 s and 3600 s."""
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(n):
        now += rng.choice(spacing)
        user = rng.choice(users)
        rows.append((i, user, now, rng.random() >= inactive))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("minute,hour,times,expected", [
    (2, None, [0, 10, 20, 60, 61, 70], "aababa"),
    (None, 2, [0, 10, 3600, 3601, 3610, 3611], "aababa"),
    (None, None, [0, 0, 0], "aaa"),
    (0, 0, [0, 0, 0], "aaa"),
])
def test_edges(spark, minute, hour, times, expected):
    rows = [(i, "u", t * SECOND, True) for i, t in enumerate(times)]
    got = by_spark(spark, rows, minute, hour)
    assert "".join(got[i][0][0] for i in range(len(rows))) == expected
    assert got == by_hand(rows, minute, hour)


DENSE = [0, 0, SECOND, 7 * SECOND, 20 * SECOND, 60 * SECOND, 61 * SECOND]
MIXED = [0, SECOND, 60 * SECOND, 60 * SECOND - 1, 600 * SECOND, 3600 * SECOND, 3600 * SECOND + 1]


@pytest.mark.parametrize("spacing", [DENSE, MIXED], ids=["dense", "mixed"])
@pytest.mark.parametrize("minute,hour", [(3, None), (None, 7), (2, 9)])
def test_equals_the_rule(spark, spacing, minute, hour):
    rows = requests(1, 1500, ["a", "b", None, "anonymous", "c"], spacing, inactive=0.1)
    assert by_spark(spark, rows, minute, hour) == by_hand(rows, minute, hour)


@pytest.mark.parametrize("spacing", [DENSE, MIXED], ids=["dense", "mixed"])
@pytest.mark.parametrize("minute,hour,piece", [(3, None, 40), (None, 7, 25), (2, 9, 200)])
def test_hot_users_in_pieces(spark, spacing, minute, hour, piece):
    """A third of all rows on one user, cut into many pieces: nothing changes."""
    rows = requests(2, 1500, ["hot", "hot", "warm", None, "x", "y"], spacing, inactive=0.05)
    got = by_spark(spark, rows, minute, hour, hot_rows=200, piece_rows=piece)
    assert got == by_hand(rows, minute, hour)


def test_saturated_user_in_pieces(spark):
    """Requests every 50 ms for over an hour: phase carries through every piece."""
    rows = [(i, "hot", i * 1_300_000 + (i % 3), True) for i in range(4000)]
    got = by_spark(spark, rows, 4, 30, hot_rows=1000, piece_rows=100)
    assert got == by_hand(rows, 4, 30)


def test_time_zone_free(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = [(i, "u", f"2024-03-31 0{h}:59:59.5") for i, h in enumerate([0, 1, 2, 3])]
    df = spark.createDataFrame(rows, "id long, user_id string, t string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = df.withColumn("ts", F.col("t").cast("timestamp_ntz"))
        out = rate_limit(df, max_requests_per_hour=1).orderBy("id").collect()
        assert [r.RateLimit_result for r in out] == ["allow", "block", "allow", "block"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_states_compose():
    import numpy as np

    rng = random.Random(3)
    times = np.cumsum([rng.choice(DENSE) for _ in range(500)]).astype("int64")
    limits = Limits(3, 11)
    whole, counts, _ = judge_run(times, [], limits)
    state, parts = [], []
    for at in range(0, 500, 37):
        code, count, state = judge_run(times[at:at + 37], state, limits)
        parts += list(zip(code, count))
        assert len(state) <= limits.memory
    assert parts == list(zip(whole, counts))
