"""Exact per-user rate limiting of a table of requests.

A request is admitted when fewer than ``per_hour`` admitted requests of its user lie in
the last 3600 s (3600 s old still counts) and fewer than ``per_minute`` in the last 60 s
(60 s old no longer counts).  Blocked requests use no quota, so a decision depends on
earlier decisions and no window frame expresses it.  It does follow from very little,
though: the times of the latest ``max(per_hour, per_minute)`` admitted requests.

Plan: rows are hash-partitioned by user and sorted by time inside each partition, one
exchange; an Arrow function walks the sorted times carrying that short list.  Only its
few inputs travel to Python, the rest of the row stays in the JVM.  With a table to take
them from again (``texts``), texts stay out of that exchange as well (see ``texts.py``).

A user with too many rows for one task is cut into pieces of bounded size along time.
The pieces are spread like users, and each starts from the admitted times its
predecessor ends with.  ``_entry_states`` finds those: one parallel pass over all pieces
settles each piece that starts or contains an hour without requests, and the rest are
walked piece after piece, skipping those in which quota cannot come free.  Every task of
every pass handles one bounded piece.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..session import scratch_folder
from .stage import ALLOW, BLOCK, Stage, Verdict, add_verdict, result_columns
from .texts import bring_back, set_aside

MINUTE_US = fixed.MINUTE_SECONDS * 1_000_000
HOUR_US = fixed.HOUR_SECONDS * 1_000_000

# Broadcast states never exceed this many bytes: pieces are made larger instead.
_STATE_BYTES = 64 << 20

PASS, OVER_HOUR, OVER_MINUTE = 0, 1, 2


@dataclass(frozen=True)
class Limits:
    """Requests per minute and per hour; None or 0 switches a limit off."""

    per_minute: int | None = None
    per_hour: int | None = None

    @property
    def memory(self) -> int:
        """How many admitted times a later decision can depend on."""
        return max(self.per_minute or 0, self.per_hour or 0)

    def free_at(self, admitted: list[int]) -> int | None:
        """Earliest microsecond at which the next request is admitted; None: any time."""
        free = None
        if self.per_hour and len(admitted) >= self.per_hour:
            free = admitted[-self.per_hour] + HOUR_US + 1
        if self.per_minute and len(admitted) >= self.per_minute:
            minute = admitted[-self.per_minute] + MINUTE_US
            free = minute if free is None else max(free, minute)
        return free

    def recent(self, admitted: list[int]) -> list[int]:
        return admitted[-self.memory:] if self.memory else []


def admit(times: list[int], before: list[int], limits: Limits) -> list[int]:
    """Positions of the admitted ones among sorted times, given earlier admitted times.

    Runs of blocked requests are jumped over by binary search.
    """
    admitted = list(before)
    positions = []
    i, n = 0, len(times)
    while i < n:
        free = limits.free_at(admitted)
        if free is not None and times[i] < free:
            i = bisect_left(times, free, i + 1)
            continue
        admitted.append(times[i])
        positions.append(i)
        i += 1
    return positions


def judge_run(
    times: np.ndarray, before: list[int], limits: Limits
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Verdict code and request count for one user's sorted times, and the state after."""
    n = len(times)
    code = np.full(n, PASS, dtype=np.int32)
    count = np.zeros(n, dtype=np.int32)
    positions = admit(times.tolist(), before, limits) if limits.memory else []
    history = np.concatenate([np.asarray(before, dtype=np.int64), times[positions]])
    if limits.memory and len(positions) < n:
        passed = np.zeros(n, dtype=bool)
        passed[positions] = True
        earlier = len(before) + np.cumsum(passed) - passed
        in_hour = earlier - np.searchsorted(history, times - HOUR_US, side="left")
        in_minute = earlier - np.searchsorted(history, times - MINUTE_US, side="right")
        over_hour = ~passed & bool(limits.per_hour) & (in_hour >= (limits.per_hour or 0))
        over_minute = ~passed & ~over_hour
        code[over_hour], code[over_minute] = OVER_HOUR, OVER_MINUTE
        count[over_hour], count[over_minute] = in_hour[over_hour], in_minute[over_minute]
    return code, count, limits.recent(history.tolist())


def _walk(
    batches: Iterator[tuple[pd.Series, ...]], limits: Limits, entry: dict
) -> Iterator[pd.DataFrame]:
    """Fold batches of (run key parts, time, active) that arrive in sorted order."""
    key, state = None, []
    for user, piece, us, active in batches:
        size = len(us)
        code, count = np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32)
        users, pieces, on = user.to_numpy(), piece.to_numpy(), active.to_numpy(dtype=bool)
        times = us.to_numpy(dtype=np.int64)
        changed = (users[1:] != users[:-1]) | (pieces[1:] != pieces[:-1])
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), size] if size else [0]
        for lo, hi in zip(starts, starts[1:]):
            run = (users[lo], int(pieces[lo]))
            if run != key:
                key, state = run, entry.get(run, [])
            rows = np.flatnonzero(on[lo:hi]) + lo
            code[rows], count[rows], state = judge_run(times[rows], state, limits)
        yield pd.DataFrame({"code": code, "count": count})


def _verdict_udf(limits: Limits, entry):
    schema = T.StructType(
        [T.StructField("code", T.IntegerType()), T.StructField("count", T.IntegerType())]
    )

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from _walk(batches, limits, entry.value if entry is not None else {})

    # Marked non-deterministic because it depends on the order of rows: the optimizer
    # then neither drops the sort below it nor moves or repeats the call.
    return F.pandas_udf(run, schema).asNondeterministic()


# ---- users too large for one task ----------------------------------------

@dataclass
class _Piece:
    user: str
    number: int
    first: int
    last: int
    entry: list[int] | None = None
    exit: list[int] | None = None
    trial: list[int] = field(default_factory=list)


def _cut(rows: DataFrame, piece_rows: int) -> list[_Piece]:
    """Cut each hot user's time line at whole seconds into pieces of about ``piece_rows``.

    Works on counts per second, combined before the shuffle.  The result has at most one
    row per ``piece_rows`` requests and two per user.
    """
    per_second = (
        rows.groupBy("user", F.floor(F.col("us") / F.lit(1_000_000)).alias("second"))
        .agg(F.count("*").alias("n"), F.min("us").alias("first"), F.max("us").alias("last"))
    )
    before = F.sum("n").over(Window.partitionBy("user").orderBy("second")) - F.col("n")
    cut = (
        per_second.withColumn("number", F.floor(before / piece_rows))
        .groupBy("user", "number")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .orderBy("user", "number")
    )
    return [_Piece(r.user, i, r.first, r.last) for i, r in enumerate(cut.toLocalIterator())]


def _piece_of(pieces: list[_Piece], spark):
    """Column function: number of the piece a request falls in, 0 for other users."""
    cuts = defaultdict(lambda: ([], []))
    for p in pieces:
        cuts[p.user][0].append(p.first)
        cuts[p.user][1].append(p.number + 1)
    shared = spark.sparkContext.broadcast(
        {u: (np.array(f, dtype=np.int64), np.array(n, dtype=np.int32)) for u, (f, n) in cuts.items()}
    )

    @F.pandas_udf("int")
    def number(user: pd.Series, us: pd.Series) -> pd.Series:
        out = np.zeros(len(us), dtype=np.int32)
        users, times = user.to_numpy(), us.to_numpy(dtype=np.int64)
        for name in set(users) & shared.value.keys():
            at = np.flatnonzero(users == name)
            first, numbers = shared.value[name]
            # Every request of a hot user was counted, so none precedes the first cut;
            # inactive ones were not and may go to any piece.
            where = np.searchsorted(first, times[at], side="right") - 1
            out[at] = numbers[np.maximum(where, 0)]
        return pd.Series(out)

    return number


def _exit_states(slim: DataFrame, limits: Limits, entry: dict[int, list[int]]) -> dict:
    """Run pieces from the given entry states: piece -> (state after, any idle hour)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, last, idle = None, [], None, False
        for pdf in batches:
            pieces, times = pdf["piece"].to_numpy(), pdf["us"].to_numpy(dtype=np.int64)
            changed = np.flatnonzero(pieces[1:] != pieces[:-1]) + 1
            starts = [0, *changed.tolist(), len(pdf)] if len(pdf) else [0]
            for lo, hi in zip(starts, starts[1:]):
                if pieces[lo] != key:
                    if key is not None:
                        yield pd.DataFrame({"piece": [key], "state": [state], "idle": [idle]})
                    key, last, idle = pieces[lo], None, False
                    state = entry.get(int(key), [])
                part = times[lo:hi]
                gaps = np.diff(part, prepend=part[0] if last is None else last)
                idle = idle or bool((gaps > HOUR_US).any())
                last = part[-1]
                _, _, state = judge_run(part, state, limits)
        if key is not None:
            yield pd.DataFrame({"piece": [key], "state": [state], "idle": [idle]})

    ran = (
        slim.repartition("piece").sortWithinPartitions("piece", "us")
        .mapInPandas(run, "piece int, state array<long>, idle boolean")
    )
    return {r.piece: (list(r.state), r.idle) for r in ran.toLocalIterator()}


def _entry_states(slim: DataFrame, pieces: list[_Piece], limits: Limits) -> dict:
    """For every piece, the admitted times its first decision depends on."""
    trial = _exit_states(slim, limits, {})
    for p in pieces:
        p.trial, idle = trial[p.number + 1]
        # After an hour without requests nothing earlier matters.
        if idle:
            p.exit = p.trial
    while True:
        ready: list[_Piece] = []
        previous = None
        for p in pieces:
            fresh = previous is None or previous.user != p.user
            if p.entry is None and fresh:
                p.entry = []
            elif p.entry is None and previous.exit is not None:
                horizon = p.first - HOUR_US
                p.entry = [t for t in previous.exit if t >= horizon]
            if p.exit is None and p.entry is not None:
                free = limits.free_at(p.entry)
                if not p.entry:
                    p.exit = p.trial
                elif free is not None and free > p.last:
                    p.exit = p.entry
                else:
                    ready.append(p)
            previous = p
        if all(p.exit is not None for p in pieces):
            break
        # Only pieces whose entry is final run, each of them once.
        known = {p.number + 1: p.entry for p in ready}
        states = _exit_states(slim.filter(F.col("piece").isin(list(known))), limits, known)
        for p in ready:
            p.exit = states[p.number + 1][0]
    return {(p.user, p.number + 1): p.entry for p in pieces if p.entry}


# ---- the operator --------------------------------------------------------

def micros(df: DataFrame, ts_col: str) -> Column:
    """Event time as integer microseconds, whatever the session's time zone."""
    kind = df.schema[ts_col].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(ts_col))
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(
            f"cast(cast(cast(`{ts_col}` - timestamp_ntz'1970-01-01' as interval second)"
            " as decimal(20, 6)) * 1000000 as bigint)"
        )
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.col(ts_col).cast("long")
    raise TypeError(f"{ts_col} must be a timestamp or integer microseconds, not {kind}")


def user_key(user: Column) -> Column:
    return F.coalesce(user.cast("string"), F.lit(fixed.ANONYMOUS_USER))


def rate_verdict(user: Column, code: Column, count: Column, limits: Limits) -> Verdict:
    hour = f"Rate limit exceeded: {limits.per_hour} requests per hour"
    minute = f"Rate limit exceeded: {limits.per_minute} requests per minute"
    return Verdict(
        F.when(code == PASS, ALLOW).when(code > PASS, BLOCK),
        F.when(code == PASS, "Rate limit check passed")
        .when(code == OVER_HOUR, hour)
        .when(code == OVER_MINUTE, minute),
        F.struct(
            user.alias("user_id"),
            F.when(code == OVER_HOUR, count).alias("requests_count"),
            F.when(code == OVER_MINUTE, count).alias("requests_last_minute"),
        ),
    )


class RateLimit(Stage):
    """Rate limiting as a stage.

    ``id_col`` orders requests of equal time and must be unique per user.  ``hot_rows``
    is the number of rows from which a user is cut into pieces: "auto" is
    ``smallest_hot_user``, whatever the size of the table, None skips the count (for
    inputs known to be even).  ``texts`` is a table whose text column holds every text that
    reaches this stage; rows then carry a digest through the exchange instead of the text.
    """

    def __init__(
        self,
        max_requests_per_minute: int | None = None,
        max_requests_per_hour: int | None = None,
        user_col: str = "user_id",
        ts_col: str = "ts",
        id_col: str = "id",
        hot_rows: int | str | None = "auto",
        piece_rows: int | None = None,
        texts: DataFrame | None = None,
        name: str = "RateLimit",
    ):
        super().__init__(name)
        self.limits = Limits(max_requests_per_minute or None, max_requests_per_hour or None)
        self.user_col, self.ts_col, self.id_col = user_col, ts_col, id_col
        self.hot_rows, self.piece_rows, self.texts = hot_rows, piece_rows, texts

    # A user with fewer rows is never cut: one task handles them in seconds.
    smallest_hot_user = 5_000_000

    def _hot_users(self, df: DataFrame) -> tuple[DataFrame, int] | None:
        """Users over the threshold, and the threshold.

        One pass over the user column, combined before the shuffle.  Only users above a
        fixed number of rows reach the driver, so their number is at most the row count
        divided by it.
        """
        if self.hot_rows is None or not self.limits.memory:
            return None
        fixed_limit = self.hot_rows if self.hot_rows != "auto" else self.smallest_hot_user
        large = F.when(F.col("count") > fixed_limit, F.struct("user", "count"))
        row = (
            df.groupBy(user_key(F.col(self.user_col)).alias("user")).count()
            .agg(F.collect_list(large).alias("large"))
            .first()
        )
        found = [(u.user,) for u in row.large or []]
        if not found:
            return None
        return df.sparkSession.createDataFrame(found, "user string"), fixed_limit

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        on = F.lit(True) if active is None else F.coalesce(active, F.lit(False))
        user, us, piece, flag, answer, ref = (
            f"__{self.name}_{x}" for x in ("user", "us", "piece", "on", "answer", "ref")
        )
        keyed = df.withColumns(
            {user: user_key(F.col(self.user_col)), us: micros(df, self.ts_col), flag: on}
        )
        number, entry = F.lit(0), None
        hot = self._hot_users(df)
        if hot is not None:
            number, entry = self._split(keyed, user, us, flag, *hot)
        if self.texts is not None:
            keyed = set_aside(keyed, text_col, ref, self.id_col)
        walk = _verdict_udf(self.limits, entry)
        got = F.col(answer)
        judged = (
            keyed.withColumn(piece, number)
            .repartition(user, piece)
            .sortWithinPartitions(user, piece, us, self.id_col)
            .withColumn(answer, walk(F.col(user), F.col(piece), F.col(us), F.col(flag)))
        )
        verdict = rate_verdict(F.col(user), got["code"], got["count"], self.limits)
        judged = add_verdict(judged, self.name, text_col, F.col(flag), verdict).drop(
            user, us, piece, flag, answer
        )
        if self.texts is not None:
            judged = bring_back(judged, self.texts, text_col, ref)
        return judged.select(*[f"`{c}`" for c in df.columns], *result_columns(self.name))

    def _split(
        self, keyed: DataFrame, user: str, us: str, flag: str, hot: DataFrame, threshold: int
    ):
        spark = keyed.sparkSession
        folder = scratch_folder(spark)
        # Written once, so whatever comes before this stage is not computed per pass.
        (
            keyed.filter(F.col(flag))
            .select(F.col(user).alias("user"), F.col(us).alias("us"))
            .join(F.broadcast(hot), "user", "left_semi")
            .write.parquet(f"{folder}/requests")
        )
        rows = spark.read.schema("user string, us long").parquet(f"{folder}/requests")
        piece_rows = self.piece_rows or threshold
        pieces = _cut(rows, piece_rows)
        while len(pieces) * self.limits.memory * 8 > _STATE_BYTES:
            piece_rows *= 2
            fewer = _cut(rows, piece_rows)
            if len(fewer) == len(pieces):
                break
            pieces = fewer
        number = _piece_of(pieces, spark)
        (
            rows.select(number(F.col("user"), F.col("us")).alias("piece"), "us")
            .repartition("piece")
            .write.partitionBy("piece").parquet(f"{folder}/pieces")
        )
        slim = spark.read.schema("us long, piece int").parquet(f"{folder}/pieces")
        entry = spark.sparkContext.broadcast(_entry_states(slim, pieces, self.limits))
        return number(F.col(user), F.col(us)), entry


def rate_limit(df: DataFrame, **options) -> DataFrame:
    """Add rate-limit verdicts to a table of requests."""
    return RateLimit(**options).apply(df, text_col="")
