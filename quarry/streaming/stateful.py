"""Streams with state beyond one aggregation.

* Sliding windows by panes: a row is counted once, in its pane; a window's count
  is the last one's plus the pane that enters minus the pane that leaves.
* Exact per-interval summaries: a chain of built-in aggregations, the first per
  (interval, user, product), so distinct users need no list and a hot interval is
  combined before it is shuffled.
* Running totals in a value state with an idle timer per key.

All emit a window or interval once, when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarry.functions.scalar import fmt_batch_time

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- sliding windows by panes -----------------------------------------------------------

PANE_STATE = "starts array<long>, counts array<long>, end long, running long, timer long"
PANE_OUT = "token string, start_ms long, end_ms long, n long"


def advance(panes: dict[int, int], end: int, running: int, upto: int, length: int, slide: int) -> tuple[list[tuple[int, int]], int, int]:
    """Windows ``(end, n)`` that close up to ``upto``, from the window that ended at
    ``end`` with ``running`` rows, and the new ``(end, running)``. ``panes`` (start ->
    rows) loses those no later window needs. Times are multiples of ``slide``."""
    out, order = [], sorted(panes)
    first, ahead = 0, 0             # places of the first pane kept, and of the first at or after ``end``
    while first < len(order):
        while ahead < len(order) and order[ahead] < end:
            ahead += 1
        if not running:             # skip the empty stretch: on to the window before the first pane
            if ahead == len(order):
                break
            end = order[ahead]
        nxt = end + slide
        if nxt > upto:
            break
        running += panes.get(nxt - slide, 0) - panes.get(nxt - slide - length, 0)
        end = nxt
        if running:
            out.append((end, running))
        gone = end - length if running else end     # without rows the leaving pane was the last one
        while first < len(order) and order[first] < gone:
            del panes[order[first]]
            first += 1
    return out, end, running


class PaneWindows(StatefulProcessor):
    """Per token the panes of one window length, the end and the count of the last
    closed window, and a timer at the end of the next window that has a row."""

    def __init__(self, length: int, slide: int):
        self.length, self.slide = length, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", PANE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, int] = {}
        for pdf in rows:
            for p, n in zip(pdf["pane_ms"].tolist(), pdf["n"].tolist()):
                new[p] = new.get(p, 0) + n
        yield self._step(key, new, timerValues.getCurrentWatermarkInMs(), None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._step(key, {}, timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())

    def _step(self, key: tuple, new: dict[int, int], now: int, expired: int | None) -> pd.DataFrame:
        starts, counts, end, running, timer = self.state.get() if self.state.exists() \
            else ([], [], -(1 << 61) // self.slide * self.slide, 0, None)
        panes = dict(zip(starts, counts))
        for p, n in new.items():
            panes[p] = panes.get(p, 0) + n
        closed, end, running = advance(panes, end, running, now // self.slide * self.slide, self.length, self.slide)
        if timer is not None and timer != expired:
            self.handle.deleteTimer(timer)
        if panes:
            order = sorted(panes)
            nxt = end if running else min([p for p in order if p >= end] or [end])
            timer = max(nxt + self.slide, now + 1)
            self.handle.registerTimer(timer)
            self.state.update((order, [panes[p] for p in order], end, running, timer))
        else:
            self.state.clear()
        return pd.DataFrame({"token": [key[0]] * len(closed), "start_ms": [e - self.length for e, _ in closed],
                             "end_ms": [e for e, _ in closed], "n": [n for _, n in closed]})

    def close(self) -> None:
        pass


def pane_windows(tokens: DataFrame, ts: str = "ts", token: str = "token", length_s: int = 10, slide_s: int = 2,
                 watermark: str = "1 minute") -> DataFrame:
    """STR-2 with an inverse function, on a stream: ``window_start, window_end, token, n``
    of every window that has rows, once the watermark has passed its end.

    Panes (one per token and slide) are counted by a built-in aggregation, so a hot
    token is combined before the shuffle; the state behind it holds a token's
    panes of one window length. ``length_s`` must be a multiple of ``slide_s``.
    Needs the RocksDB state store (``with_rocksdb``)."""
    if length_s % slide_s:
        raise ValueError("the length must be a multiple of the slide")
    timed = tokens.select(F.col(token).cast("string").alias("token"), F.col(ts).alias("ts")).withWatermark("ts", watermark)
    panes = timed.groupBy(F.window("ts", f"{slide_s} seconds").alias("w"), "token").agg(F.count("*").alias("n"))
    rows = panes.select("token", F.window_time("w").alias("at"), F.unix_millis("w.start").alias("pane_ms"), "n")
    out = rows.groupBy("token").transformWithStateInPandas(
        PaneWindows(length_s * 1000, slide_s * 1000), PANE_OUT, "Append", "EventTime")
    return out.select(fmt_batch_time(F.timestamp_millis("start_ms")).alias("window_start"),
                      fmt_batch_time(F.timestamp_millis("end_ms")).alias("window_end"), "token", "n")


# --- exact summaries per interval -----------------------------------------------------------

def exact_summary(df: DataFrame, ts: str = "ts", every: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """STR-3 on a stream over any number of triggers: per interval purchases, exact
    distinct users, revenue and the most popular product (ties: smallest name), once
    the watermark has passed the interval. Rows later than the watermark of the
    trigger before are left out.

    Four aggregations in a row, each emitting an interval when it is complete: per
    user and product; per user (its products, whose first carries the user's 1);
    per product; per interval. State is one row per (interval, user, product)
    while the interval is open."""
    timed = df.select("user", "product", "price", F.col(ts).alias("ts")).withWatermark("ts", watermark)
    fine = timed.groupBy(F.window("ts", every).alias("w"), "user", "product") \
                .agg(F.count("*").alias("n"), F.sum("price").alias("revenue"))
    of_user = fine.groupBy(F.window(F.window_time("w"), every).alias("w"), "user") \
                  .agg(F.array_sort(F.collect_list(F.struct("product", "n", "revenue"))).alias("bought"))   # one per product
    flat = of_user.select("w", F.col("user").isNotNull().alias("_known"), F.posexplode("bought").alias("_at", "b"))
    one = F.when((F.col("_at") == 0) & F.col("_known"), 1).otherwise(0)
    of_product = flat.select("w", F.col("b.product").alias("product"), F.col("b.n").alias("n"), F.col("b.revenue").alias("revenue"),
                             one.alias("users")) \
        .groupBy(F.window(F.window_time("w"), every).alias("w"), "product") \
        .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"), F.sum("users").alias("users"))
    best = F.min(F.when(F.col("product").isNotNull(), F.struct((-F.col("n")).alias("m"), "product")))
    out = of_product.groupBy(F.window(F.window_time("w"), every).alias("w")).agg(
        F.sum("n").alias("purchases"), F.sum("users").alias("unique_users"), F.sum("revenue").alias("revenue"), best.alias("top"))
    return out.select(fmt_batch_time(F.col("w.start")).alias("batch_start"), "purchases", "unique_users", "revenue",
                      F.col("top.product").alias("top_product"), (-F.col("top.m")).alias("top_count"))


# --- running totals with expiry -------------------------------------------------------------

TOTALS_OUT = "user string, purchases long, revenue double, expired boolean"


class TotalsWithExpiry(StatefulProcessor):
    """Count and sum per key in a value state. A key that has been idle (in event
    time) for ``idle_ms`` is reported once more as expired and forgotten."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "purchases long, revenue double, last_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, total, last = self.totals.get() if self.totals.exists() else (0, 0.0, None)
        if self.idle_ms is not None and last is not None and last + self.idle_ms <= timerValues.getCurrentWatermarkInMs():
            # rows and the timer are due in the same trigger: the timer comes first
            self.handle.deleteTimer(last + self.idle_ms)
            yield pd.DataFrame({"user": [key[0]], "purchases": [n], "revenue": [total], "expired": [True]})
            n, total, last = 0, 0.0, None
        newest = last
        for pdf in rows:
            n += len(pdf)
            total += float(pdf["price"].sum())
            newest = max(newest or 0, int(pdf["ts_ms"].max()))
        if self.idle_ms is not None and newest != last:
            if last is not None:
                self.handle.deleteTimer(last + self.idle_ms)
            self.handle.registerTimer(newest + self.idle_ms)
        self.totals.update((n, total, newest))
        yield pd.DataFrame({"user": [key[0]], "purchases": [n], "revenue": [total], "expired": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, total, _ = self.totals.get()
        self.totals.clear()
        yield pd.DataFrame({"user": [key[0]], "purchases": [n], "revenue": [total], "expired": [True]})

    def close(self) -> None:
        pass


def totals_with_expiry(df: DataFrame, ts: str = "ts", watermark: str = "1 hour", idle_ms: int | None = None) -> DataFrame:
    """STR-4/5: ``user, purchases, revenue, expired`` after every trigger for the keys
    it touched, from a value state; with ``idle_ms`` idle keys expire. Needs the
    RocksDB state store (``with_rocksdb``)."""
    timed = df.withWatermark(ts, watermark).select(
        F.col("user").cast("string").alias("user"), F.col("price").cast("double").alias("price"), F.unix_millis(ts).alias("ts_ms"), F.col(ts).alias("ts"))
    return timed.groupBy("user").transformWithStateInPandas(
        TotalsWithExpiry(idle_ms), TOTALS_OUT, "Update", "EventTime" if idle_ms is not None else "None")


class with_rocksdb:
    """The session's streams keep their state in RocksDB while this is entered."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(STORE)
        self.spark.conf.set(STORE, ROCKS)

    def __exit__(self, *error) -> None:
        self.spark.conf.set(STORE, self.before)
