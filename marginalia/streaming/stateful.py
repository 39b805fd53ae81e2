"""Streams with keyed state and timers: breakers that close again, and rows gathered by number or by time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

TRANSITIONS = "host string, at timestamp, state string, until timestamp, streak long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


class Breaker:
    """One host's breaker: `limit` transient failures in a row open it for `cooldown` microseconds from the last of them; any success ends the row."""

    def __init__(self, limit: int, cooldown: int, streak: int = 0, until: int = 0) -> None:
        self.limit, self.cooldown, self.streak, self.until = limit, cooldown, streak, until

    def passes(self, now: int) -> list[tuple[int, str, int, int]]:
        """Time goes on to `now`: (at, state, until, streak) of what that changes."""
        if self.until and now >= self.until:
            at, self.until = self.until, 0
            return [(at, "closed", at, self.streak)]
        return []

    def meets(self, at: int, status: str) -> list[tuple[int, str, int, int]]:
        """An outcome at a time that is no earlier than any before."""
        out = self.passes(at)
        if status == "success":
            self.streak = 0
        elif status == "failed":
            self.streak += 1
            if self.streak >= self.limit and self.cooldown > 0 and at + self.cooldown > self.until:
                self.until = at + self.cooldown
                out.append((at, "open", self.until, self.streak))
        return out


class BreakerProcessor(StatefulProcessor):
    """Outcomes wait in the state until the watermark has passed them, and are then met in the order of their time, so batches and late rows don't matter. Timers
    stand at the time of each outcome and where a breaker closes."""

    def __init__(self, limit: int, cooldown: int) -> None:
        self.limit, self.cooldown = limit, cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, status string")
        self.breaker = handle.getValueState("breaker", "streak long, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            at = frame["ts"].astype("datetime64[us]").astype("int64")
            self.waiting.appendList([(int(a), s) for a, s in zip(at, frame["status"])])
            for ms in sorted({-(-int(a) // 1000) for a in at}):
                self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        waiting = sorted(self.waiting.get())
        due, rest = [w for w in waiting if w[0] <= now], [w for w in waiting if w[0] > now]
        breaker = Breaker(self.limit, self.cooldown, *(self.breaker.get() if self.breaker.exists() else (0, 0)))
        out = [t for at, status in due for t in breaker.meets(at, status)] + breaker.passes(now)
        if due:
            self.waiting.put(rest) if rest else self.waiting.clear()
        self.breaker.update((breaker.streak, breaker.until))
        if breaker.until:
            self.handle.registerTimer(-(-breaker.until // 1000))
        if out:
            time = lambda x: pd.Timestamp(x, unit="us")
            yield pd.DataFrame({"host": [key[0]] * len(out), "at": [time(t[0]) for t in out], "state": [t[1] for t in out], "until": [time(t[2]) for t in out], "streak": [t[3] for t in out]})

    def close(self) -> None:
        pass


def cooling_breakers(stream: DataFrame, limit: int = 3, cooldown: float = 60.0, late: str = "10 minutes") -> DataFrame:
    """(host, at, state, until, streak): each time that a host's breaker opens, is held open longer, or closes, in event time.

    stream: (ts, host, status). Outcomes of one instant count in the order of their status; what comes later than `late` is dropped by the watermark. What the watermark
    has not passed yet shows in a later batch.
    """
    prepare(stream.sparkSession)
    rows = stream.select("ts", "host", "status").withWatermark("ts", late)
    return rows.groupBy("host").transformWithStateInPandas(BreakerProcessor(limit, round(cooldown * 1_000_000)), TRANSITIONS, "Append", "EventTime")


class GatheringProcessor(StatefulProcessor):
    """Rows are held until `most` are there, or until the oldest has waited `wait` milliseconds."""

    def __init__(self, names: list[str], most: int, wait: int) -> None:
        self.names, self.most, self.wait = names, most, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "row string")
        self.about = handle.getValueState("about", "n long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, timer = self.about.get() if self.about.exists() else (0, 0)
        for frame in rows:
            self.held.appendList([(r,) for r in frame["row"]])
            n += len(frame)
        if n >= self.most:
            if timer:
                self.handle.deleteTimer(timer)
            return self._given(key, "rows")
        if not timer:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.wait
            self.handle.registerTimer(timer)
        self.about.update((n, timer))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._given(key, "timer")

    def _given(self, key, why: str) -> Iterator[pd.DataFrame]:
        rows = [r for (r,) in self.held.get()]
        self.held.clear()
        self.about.clear()
        yield pd.DataFrame({"shard": [key[0]] * len(rows), "why": [why] * len(rows), "row": rows})

    def close(self) -> None:
        pass


def gathered(stream: DataFrame, shards: int = 8, most: int = 20, seconds: float = 20.0) -> DataFrame:
    """The stream's rows with why (rows or timer), given out together once a shard has `most` of them, or `seconds` after the first of them came.

    Rows are dealt to shards by their hash, so one hot key is spread, and each shard counts and waits by itself; a shard holds fewer than `most` rows and a batch.
    """
    prepare(stream.sparkSession)
    schema: StructType = stream.schema
    packed = stream.select(F.pmod(F.xxhash64(F.to_json(F.struct("*"))), F.lit(shards)).alias("shard"), F.to_json(F.struct("*")).alias("row"))
    out = packed.groupBy("shard").transformWithStateInPandas(GatheringProcessor(schema.fieldNames(), most, round(seconds * 1000)), "shard long, why string, row string", "Append", "ProcessingTime")
    return out.select("why", F.from_json("row", schema).alias("r")).select("why", "r.*")
