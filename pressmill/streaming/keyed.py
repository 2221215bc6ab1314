"""What has been tried and seen, as state kept by key: no batch reads the history, only the state of the keys that arrive.

Attempts keeps what became of a key: it is tried until it succeeds, anew each month, and is forgotten KEEP_DAYS after it was last tried, which an
event-time timer sees to. FirstSeen passes a key once a month; its state has a time to live. Both need a state store that holds
such state, which started() asks for.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: How long a key is remembered after it was last tried.
KEEP_DAYS = 30
_DAY_MS = 86_400_000
STORE = "spark.sql.streaming.stateStore.providerClass"
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(ts) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class Attempts(StatefulProcessor):
    """Rows with ts and status become rows with the attempt they were, or `already_done`; status is what trying would give."""

    def __init__(self, keys: list[str], keep_days: int = KEEP_DAYS):
        self.keys, self.keep_ms = keys, keep_days * _DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "status string, attempts int, since long, month string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["ts", "status"], kind="stable")
        known = self.known.get() if self.known.exists() else None
        before, made = known, []
        for ts, status in zip(arrived["ts"], arrived["status"]):
            month, at = f"{ts:%Y-%m}", _ms(ts)
            if known is not None and (known[3] != month or at - known[2] >= self.keep_ms):
                known = None
            if known is not None and known[0] == "success":
                made.append((*key, month, ts, "already_done", known[1]))
                continue
            known = (status, 1 if known is None else known[1] + 1, at, month)
            made.append((*key, month, ts, status, known[1]))
        if known is not before and known is not None:
            if before is not None:
                self.handle.deleteTimer(before[2] + self.keep_ms)
            self.handle.registerTimer(known[2] + self.keep_ms)
            self.known.update(known)
        yield pd.DataFrame(made, columns=[*self.keys, "month", "ts", "status", "attempt"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


class FirstSeen(StatefulProcessor):
    """The first row of a key in each month; a key that has not been seen for the time to live is forgotten."""

    def __init__(self, keys: list[str], ttl_days: int = KEEP_DAYS + 1):
        self.keys, self.ttl_ms = keys, ttl_days * _DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.months = handle.getValueState("months", "months string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.months.get()[0].split() if self.months.exists() else []
        seen, made = list(before), []
        for ts in sorted(pd.concat(list(rows))["seen_at"]):
            month = f"{ts:%Y-%m}"
            if month not in seen:
                seen.append(month)
                made.append((month, *key, ts))
        if made:
            self.months.update((" ".join(seen),))
        yield pd.DataFrame(made, columns=["month", *self.keys, "seen_at"])

    def close(self) -> None:
        pass


def attempts(arrivals: DataFrame, keys: list[str], lateness: str = "40 days", keep_days: int = KEEP_DAYS) -> DataFrame:
    """keys, month, ts, status, attempt for each arrival; arrivals: keys, ts, status. Run it with started()."""
    kinds = ", ".join(f"{k} {arrivals.schema[k].dataType.simpleString()}" for k in keys)
    grouped = arrivals.select(*keys, "ts", "status").withWatermark("ts", lateness).groupBy(*keys)
    return grouped.transformWithStateInPandas(Attempts(keys, keep_days), f"{kinds}, month string, ts timestamp, status string, attempt int", "Append", "EventTime")


def first_seen(links: DataFrame, keys: list[str], ttl_days: int = KEEP_DAYS + 1) -> DataFrame:
    """month, keys, seen_at of the first arrival of each month; links: keys, seen_at. Run it with started(..., timers=False)."""
    kinds = ", ".join(f"{k} {links.schema[k].dataType.simpleString()}" for k in keys)
    return links.select(*keys, "seen_at").groupBy(*keys).transformWithStateInPandas(FirstSeen(keys, ttl_days), f"month string, {kinds}, seen_at timestamp", "Append", "ProcessingTime")


@contextmanager
def _settings(spark: SparkSession, **settings: str):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def started(stream: DataFrame, out: str, checkpoint: str, timers: bool = True) -> StreamingQuery:
    """The stream's rows as Parquet files in `out`, until all that has arrived is read; a later call with the same checkpoint goes on from there.

    timers: whether batches without rows run for the sake of timers; a time to live needs none, and by the clock there would always be one more.
    """
    with _settings(stream.sparkSession, **{STORE: ROCKS, IDLE: str(timers).lower()}):
        return stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
