"""Users that share a state of the streaming limiter."""

import random

import pytest

from textwarden.streaming.ratelimit import rate_limit_stream
from textwarden.streaming.runs import run_available

from test_ratelimit import DENSE, MIXED, by_hand, requests
from test_streaming import DAY, START, as_stream, told

BIG = 2**50


@pytest.mark.parametrize("groups, spacing", [(1, DENSE), (2, MIXED)], ids=["one", "two"])
def test_users_in_one_state_keep_their_own_quota(spark, tmp_path, groups, spacing):
    rows = [(BIG + i, u, t + START, True)
            for i, u, t, _ in requests(7, 500, ["a", "b", "c", "d", None], spacing)]
    rows.sort(key=lambda r: r[2])
    end = rows[-1][2]
    batches = []
    for at in range(0, 500, 125):
        part = [r[:3] for r in rows[at:at + 125]]
        random.Random(at).shuffle(part)
        batches.append(part)
    # A request without an id waits with the others and does not change theirs.
    batches[1].append((None, "nobody", rows[200][2]))
    batches.append([(-1, "end", end + DAY)])
    stream = as_stream(spark, tmp_path, batches, "id long, user_id string, ts long")
    out = run_available(rate_limit_stream(stream, 2, 9, watermark="1 minute", groups=groups)).collect()
    got = {r.id: told(r) for r in out if r.id is not None}
    assert got == by_hand(rows, 2, 9)
    assert [r.user for r in out if r.id is None] == ["nobody"] and len(out) == 501
