"""The rate limiter on a stream.

Requests wait in a state until the watermark passes them and are then judged by user in
order of (time, id), so on-time requests get exactly the batch operator's verdicts.  Spark
drops requests older than the watermark.  State per user is what one watermark delay
brings plus the admitted times of the last hour.  A call of the Python function costs the
same whether it judges one user or a hundred, so users share states, ``groups`` in all;
each is removed an hour after its last admitted request.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ratelimit import (
    HOUR_US,
    Limits,
    judge_run,
    micros,
    rate_verdict,
    user_key,
)
from ..operators.stage import Stage, Verdict, add_verdict, result_columns
from ..operators.texts import bring_back, set_aside


def _keep_judging(limits: Limits, id_type: T.DataType, output: list[str]):
    # Nullable, or one NULL would turn all whole numbers into fractions.
    whole = isinstance(id_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))

    def judge(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        users, us, ids, past_users, past_us = state.get if state.exists else ([], [], [], [], [])
        past: dict[str, list[int]] = {}
        for user, at in zip(past_users, past_us):
            past.setdefault(user, []).append(at)
        known = pd.DataFrame({
            "user": list(users), "us": pd.Series(list(us), dtype="int64"),
            "id": pd.Series(list(ids), dtype="Int64" if whole else None)})
        parts = [known, *(pdf[["user", "us", "id"]] for pdf in batches)]
        # An empty frame has no type for ids to agree with.
        rows = pd.concat([p for p in parts if len(p)] or [known], ignore_index=True)
        if whole:
            rows["id"] = rows["id"].astype("Int64")
        passed = state.getCurrentWatermarkMs() * 1000
        is_ready = rows["us"].to_numpy(dtype=np.int64) <= passed
        if is_ready.any():
            yield _judge_users(rows[is_ready], past, limits)[output]
        past = {user: at for user, at in past.items() if at and at[-1] + HOUR_US >= passed}
        waiting = rows[~is_ready]
        if len(waiting):
            wake = int(waiting["us"].min()) // 1000 + 1
        elif past:
            wake = (max(at[-1] for at in past.values()) + HOUR_US) // 1000 + 1
        else:
            if state.exists:
                state.remove()
            return
        held = waiting["id"].astype(object)
        state.update((
            waiting["user"].tolist(), waiting["us"].tolist(), held.where(held.notna(), None).tolist(),
            [user for user, at in past.items() for _ in at], [t for at in past.values() for t in at]))
        state.setTimeoutTimestamp(max(wake, state.getCurrentWatermarkMs() + 1))

    return judge


def _judge_users(rows: pd.DataFrame, past: dict[str, list[int]], limits: Limits) -> pd.DataFrame:
    """Verdicts of many users' rows; ``past``, their admitted times, is brought up to date."""
    number, names = pd.factorize(rows["user"])
    rows = rows.assign(number=number).sort_values(["number", "us", "id"], ignore_index=True)
    number, times = rows["number"].to_numpy(), rows["us"].to_numpy(dtype=np.int64)
    code, count = np.empty(len(rows), dtype=np.int32), np.empty(len(rows), dtype=np.int32)
    starts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(rows)]
    for lo, hi in zip(starts, starts[1:]):
        user = names[number[lo]]
        code[lo:hi], count[lo:hi], past[user] = judge_run(times[lo:hi], past.get(user, []), limits)
    return rows.assign(code=code, count=count)


def rate_limit_stream(
    requests: DataFrame,
    max_requests_per_minute: int | None = None,
    max_requests_per_hour: int | None = None,
    user_col: str = "user_id",
    ts_col: str = "ts",
    id_col: str = "id",
    watermark: str = "10 minutes",
    name: str = "RateLimit",
    groups: int = 1024,
) -> DataFrame:
    """Rate-limit verdicts of a streaming table of requests.

    The result has the request's id, user and time in microseconds, and the verdict
    columns; join other columns back by id.  Use output mode append.  Users are dealt to
    ``groups`` states by a hash; it stays the same for the life of a checkpoint.
    """
    limits = Limits(max_requests_per_minute or None, max_requests_per_hour or None)
    slim = requests.select(
        user_key(F.col(user_col)).alias("user"),
        F.col(id_col).alias("id"),
        micros(requests, ts_col).alias("us"),
    ).withColumns({
        "__event_time": F.timestamp_micros("us"),
        "__group": F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int"),
    })
    id_type = slim.schema["id"].dataType
    output = T.StructType(
        [
            T.StructField("user", T.StringType()),
            T.StructField("id", id_type),
            T.StructField("us", T.LongType()),
            T.StructField("code", T.IntegerType()),
            T.StructField("count", T.IntegerType()),
        ]
    )
    state = T.StructType(
        [
            T.StructField("users", T.ArrayType(T.StringType())),
            T.StructField("us", T.ArrayType(T.LongType())),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("past_users", T.ArrayType(T.StringType())),
            T.StructField("past_us", T.ArrayType(T.LongType())),
        ]
    )
    judged = (
        slim.withWatermark("__event_time", watermark)
        .groupBy("__group")
        .applyInPandasWithState(
            _keep_judging(limits, id_type, output.fieldNames()), output, state, "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    verdict = rate_verdict(F.col("user"), F.col("code"), F.col("count"), limits)
    return add_verdict(judged, name, "", None, verdict).select(
        F.col("id").alias(id_col), "user", "us", f"{name}_result", f"{name}_reason",
        f"{name}_metadata",
    )


# ---- as a stage of a chain -----------------------------------------------

LATE = 3
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _Limiter(StatefulProcessor):
    """One user's requests: rows that wait in a list, admitted times and clock in a value.

    A timer fires when the watermark passes the first waiting row, and another one an hour
    after the last admitted time, when nothing depends on it any more.
    """

    def __init__(self, limits: Limits, on_arrival: bool, id_type: T.DataType):
        self.limits, self.on_arrival, self.id_type = limits, on_arrival, id_type

    def init(self, handle) -> None:
        row = T.StructType([
            T.StructField("us", T.LongType()), T.StructField("id", self.id_type),
            T.StructField("row", T.StringType())])
        self.handle = handle
        self.waiting = handle.getListState("waiting", row)
        self.past = handle.getValueState("past", "admitted array<long>, clock long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        new = []
        for frame in rows:
            on = frame["on"].to_numpy(dtype=bool)
            if not on.all():
                yield _answers(frame["row"][~on], -1, 0)
            late = on & (frame["us"].to_numpy() <= passed) & (not self.on_arrival)
            if late.any():
                yield _answers(frame["row"][late], LATE, 0)
            new.append(frame[on & ~late])
        got = pd.concat(new, ignore_index=True)
        if not len(got):
            return
        if self.on_arrival:
            yield self._judged(got.sort_values(["us", "id"], ignore_index=True), passed)
            self._wake_for_cleaning(passed)
            return
        self.waiting.appendList(list(zip(got["us"].tolist(), got["id"].tolist(), got["row"])))
        self._wake(int(got["us"].min()) // 1000 + 1, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if self.waiting.exists():
            held = pd.DataFrame(list(self.waiting.get()), columns=["us", "id", "row"])
            held = held.sort_values(["us", "id"], ignore_index=True)
            ready = int(np.searchsorted(held["us"].to_numpy(), passed, side="right"))
            if ready:
                yield self._judged(held.iloc[:ready], 0)
                rest = held.iloc[ready:]
                if len(rest):
                    self.waiting.put(list(zip(rest["us"].tolist(), rest["id"].tolist(), rest["row"])))
                else:
                    self.waiting.clear()
            if ready < len(held):
                self._wake(int(held["us"].iloc[ready]) // 1000 + 1, passed)
        self._wake_for_cleaning(passed)

    def _judged(self, rows: pd.DataFrame, passed: int) -> pd.DataFrame:
        admitted, clock = self.past.get() if self.past.exists() else ([], passed)
        # On arrival a user's clock never runs back.
        times = rows["us"].to_numpy(dtype=np.int64)
        times = np.maximum(times, max(clock, passed)) if self.on_arrival else times
        code, count, admitted = judge_run(times, list(admitted), self.limits)
        self.past.update(([int(t) for t in admitted], int(times[-1])))
        return _answers(rows["row"], code, count)

    def _wake(self, at: int, passed: int) -> None:
        """A timer for ``at``, unless one that has not expired yet comes first."""
        if not any(passed < t * 1000 <= at * 1000 for t in self.handle.listTimers()):
            self.handle.registerTimer(at)

    def _wake_for_cleaning(self, passed: int) -> None:
        if not self.past.exists():
            return
        last = self.past.get()[1] + HOUR_US
        if last < passed:
            self.past.clear()
        else:
            self._wake(last // 1000 + 1, passed)

    def close(self) -> None:
        pass


def _answers(rows: pd.Series, code, count) -> pd.DataFrame:
    return pd.DataFrame({"row": rows.to_numpy(), "code": code, "count": count})


class StreamRateLimit(Stage):
    """Rate limiting of a stream of requests as a stage: every column of a row stays.

    ``judge="event"`` decides in order of event time: rows wait until the watermark passes
    them, and get the verdicts that ``RateLimit`` gives to the whole table.  A row that
    comes after the watermark has passed it is late: it uses no quota, is blocked, and its
    metadata say so (``late``); ``late_rows`` and ``on_time_rows`` tell the two outputs apart.
    ``judge="arrival"`` decides at once, in order of arrival and by event time within a
    trigger; a user's clock never runs back, so a row with an earlier time counts as of the
    latest time seen.  Rows that an earlier stage has blocked pass at once without a verdict.

    The state needs the RocksDB store, which is set here in place of Spark's default.  Rows go
    through the state as JSON, so variants and maps without string keys are refused.  With
    ``texts``, a table whose text column holds every text that reaches this stage, a digest
    goes through the state instead of the text, which is taken from there afterwards.
    """

    def __init__(
        self, max_requests_per_minute: int | None = None, max_requests_per_hour: int | None = None,
        user_col: str = "user_id", ts_col: str = "ts", id_col: str = "id",
        watermark: str = "10 minutes", judge: str = "event", texts: DataFrame | None = None,
        name: str = "RateLimit",
    ):
        super().__init__(name)
        if judge not in ("event", "arrival"):
            raise ValueError(f'judge must be "event" or "arrival", not {judge!r}')
        self.limits = Limits(max_requests_per_minute or None, max_requests_per_hour or None)
        self.user_col, self.ts_col, self.id_col = user_col, ts_col, id_col
        self.watermark, self.on_arrival, self.texts = watermark, judge == "arrival", texts

    def apply(self, df: DataFrame, text_col: str, active: Column | None = None) -> DataFrame:
        for field in df.schema:
            if any(not _survives_json(t) for t in _types(field.dataType)):
                raise TypeError(f"{field.name} cannot wait in the state: {field.dataType.simpleString()}")
        spark = df.sparkSession
        if "HDFSBacked" in spark.conf.get(_PROVIDER):
            spark.conf.set(_PROVIDER, _ROCKS)
        on = F.lit(True) if active is None else F.coalesce(active, F.lit(False))
        ref = f"__{self.name}_ref"
        columns = [f"`{c}`" for c in df.columns]
        df = df.withColumn("__on", on)
        if self.texts is not None:
            df = set_aside(df, text_col, ref, self.id_col)
        kept = df.drop("__on")
        # The event time itself is left out below: the limiter, not Spark, sorts out late rows.
        rows = df.withColumn("__event_time", F.timestamp_micros(micros(df, self.ts_col))).withWatermark(
            "__event_time", self.watermark).select(
            user_key(F.col(self.user_col)).alias("user"), F.col(self.id_col).alias("id"),
            micros(df, self.ts_col).alias("us"), F.col("__on").alias("on"),
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in kept.columns]), _JSON).alias("row"))
        judged = rows.groupBy("user").transformWithStateInPandas(
            _Limiter(self.limits, self.on_arrival, rows.schema["id"].dataType),
            "row string, code int, count int", "append", "EventTime")
        whole = judged.select(F.from_json("row", kept.schema, _JSON).alias("row"), "code", "count")
        code, count, user = "__code", "__count", user_key(F.col(self.user_col))
        whole = whole.select("row.*", F.col("code").alias(code), F.col("count").alias(count))
        verdict = rate_verdict(user, F.col(code), F.col(count), self.limits)
        late = F.col(code) == LATE
        verdict = Verdict(
            verdict.action,
            F.when(late, "Request came after its time had been judged").otherwise(verdict.reason),
            verdict.metadata.withField("late", late))
        whole = add_verdict(whole, self.name, text_col, F.col(code) >= 0, verdict).drop(code, count)
        if self.texts is not None:
            whole = bring_back(whole, self.texts, text_col, ref)
        return whole.select(*columns, *result_columns(self.name))


def _types(kind: T.DataType) -> Iterator[T.DataType]:
    yield kind
    for inner in (
        [f.dataType for f in kind] if isinstance(kind, T.StructType)
        else [kind.elementType] if isinstance(kind, T.ArrayType)
        else [kind.valueType] if isinstance(kind, T.MapType) else []
    ):
        yield from _types(inner)


def _survives_json(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return isinstance(kind.keyType, T.StringType)
    return not isinstance(kind, (T.VariantType, T.DayTimeIntervalType, T.YearMonthIntervalType))


def _is_late(name: str) -> Column:
    return F.coalesce(F.col(f"{name}_metadata.late"), F.lit(False))


def late_rows(screened: DataFrame, name: str = "RateLimit") -> DataFrame:
    """The second output of the limiter: rows that came too late to be judged."""
    return screened.where(_is_late(name))


def on_time_rows(screened: DataFrame, name: str = "RateLimit") -> DataFrame:
    return screened.where(~_is_late(name))
