"""Structured Streaming operators.

Every stream operator is written as a DataFrame function that runs the same
way on a batch frame (its "batch twin", checked against SQL) and on a
streaming frame. Windows are event-time windows with a watermark so that
state is released; the reference's arrival-time batches map onto
``trigger(processingTime=...)``.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.readwriter import DataStreamWriter

from quarry.functions.scalar import fmt_batch_time
from quarry.operators.relational import most_popular
from quarry.session import scratch_path

PURCHASE_SCHEMA = "user string, product string, price double"
EVENT_SCHEMA = "user long, product string, price double, ts timestamp"


# --- sources / sinks -----------------------------------------------------------
def stream_source(spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None,
                  **options) -> DataFrame:
    """SRC-8/9: ``socket`` (host/port), ``kafka`` (kafka.bootstrap.servers,
    subscribe="a,b"), or a file format (``text``, ``csv``, ``parquet``) over a
    folder. Kafka rows are reduced to ``value`` as a string."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path) if path is not None else r.load()
    return kafka_values(df) if fmt == "kafka" else df


def kafka_values(df: DataFrame) -> DataFrame:
    """The text of Kafka rows (their key, topic and offsets are left out)."""
    return df.select(F.col("value").cast("string").alias("value"))


def kafka_options(servers: str, topics: list[str]) -> dict:
    """Options for the Kafka source (the connector jar must be on the classpath)."""
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}


def stream_sink(df: DataFrame, checkpoint: str | None = None, fmt: str = "console",
                output_mode: str = "append", trigger: dict | None = None,
                foreach_batch: Callable[[DataFrame, int], None] | None = None,
                query_name: str | None = None, **options) -> DataStreamWriter:
    """SNK-2/3, STR-7/8: configured writer. A checkpoint location is always set
    (defaults to a fresh folder under the shared ``spark.checkpoint.dir``)."""
    spark = df.sparkSession
    w = (df.writeStream.outputMode(output_mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream")))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
    if query_name:
        w = w.queryName(query_name)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w


def run_until_idle(writer: DataStreamWriter, timeout_s: float | None = None, available_now: bool = True):
    """STR-9 for tests/back-fills: start and wait until the input present at
    start is processed. An ``availableNow`` query ends by itself (waiting on
    it, not on "no new data", also works when timeouts keep scheduling
    no-data batches); other triggers are drained with processAllAvailable.

    There is no time limit unless one is given. A query that has not ended by
    then is stopped and raises ``TimeoutError``: its input was not all read. A
    failed query raises its own error."""
    q = writer.start()
    try:
        if available_now:
            ended = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
            if not ended:
                raise TimeoutError(f"the stream was still running after {timeout_s} s; part of its input is unread")
        else:
            q.processAllAvailable()
        if q.exception() is not None:
            raise q.exception()
    finally:
        q.stop()
    return q


# --- parsing -------------------------------------------------------------------
def parse_events(df: DataFrame, col: str = "value") -> DataFrame:
    """STR-6: ``user,product,price`` text lines -> typed rows (bad price -> NULL)."""
    p = F.split(F.col(col), ",")
    return df.select(F.try_element_at(p, F.lit(1)).alias("user"),
                     F.try_element_at(p, F.lit(2)).alias("product"),
                     F.try_element_at(p, F.lit(3)).try_cast("double").alias("price"),
                     *[c for c in df.columns if c != col])


def event_lines(df: DataFrame) -> DataFrame:
    """Inverse of ``parse_events`` (used to feed text streams in tests)."""
    return df.select(F.concat_ws(",", F.col("user").cast("string"), "product",
                                 F.col("price").cast("string")).alias("value"), "ts")


# --- aggregates ---------------------------------------------------------------------
def tokens_of(df: DataFrame, col: str, by: str = "word") -> DataFrame:
    """Token rows of a line column: ``word`` splits on a space, ``char`` on
    the empty pattern (what the per-second stream program actually does)."""
    sep = " " if by == "word" else ""
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.explode(F.split(F.col(col), sep)).alias("token"))


def _timed(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """A stream's event-time column gets its watermark (batches need none)."""
    return df.withWatermark(ts, watermark) if watermark and df.isStreaming else df


def stream_token_counts(df: DataFrame, col: str, ts: str, every: str = "1 second",
                        by: str = "word", watermark: str | None = "1 minute") -> DataFrame:
    """STR-1: token counts per tumbling interval. On a stream the watermark
    closes intervals, so their state is dropped and append mode works."""
    t = tokens_of(_timed(df.select(col, ts), ts, watermark), col, by)
    return (t.groupBy(F.window(ts, every).alias("w"), "token")
            .agg(F.count("*").alias("n"))
            .select(fmt_batch_time(F.col("w.start")).alias("batch_start"), "token", "n"))


def sliding_counts(df: DataFrame, col: str, ts: str, length: str = "10 seconds",
                   slide: str = "2 seconds", by: str = "word", watermark: str | None = "1 minute") -> DataFrame:
    """STR-2: counts over a sliding window (each row adds to length/slide
    windows). Windows whose count would be 0 never appear."""
    t = tokens_of(_timed(df.select(col, ts), ts, watermark), col, by)
    return (t.groupBy(F.window(ts, length, slide).alias("w"), "token")
            .agg(F.count("*").alias("n"))
            .select(fmt_batch_time(F.col("w.start")).alias("window_start"),
                    fmt_batch_time(F.col("w.end")).alias("window_end"), "token", "n"))


def purchase_summary(df: DataFrame, ts: str | None = "ts", every: str = "1 day") -> DataFrame:
    """STR-3: per interval purchases, unique users, revenue and the most
    popular product (ties -> smallest name). With ``ts=None`` the whole frame
    is one batch (the ``foreachBatch`` form; the batch time is added by the
    caller). Empty input gives no row."""
    if ts is None:
        src = df.withColumn("_w", F.lit(0))  # one group: the whole batch
    else:
        src = df.withColumn("_w", F.window(ts, every).start)
    g = ["_w"]
    totals = src.groupBy(*g).agg(F.count("*").alias("purchases"),
                                 F.count_distinct("user").alias("unique_users"),
                                 F.sum("price").alias("revenue"))
    top = most_popular(src, "product", g).withColumnRenamed("product", "top_product") \
        .withColumnRenamed("n", "top_count")
    out = totals.join(top, g)
    if ts is None:
        return out.drop("_w")
    return out.withColumn("batch_start", fmt_batch_time(F.col("_w"))).drop("_w")


def purchase_windows(df: DataFrame, ts: str = "ts", every: str = "10 seconds",
                     watermark: str | None = "1 minute") -> DataFrame:
    """STR-3, continuous form: per event-time window purchases, revenue and
    approximate unique users (exact distinct counts are not allowed on a
    stream; the per-batch exact form is ``purchase_summary_batches``). The
    watermark closes windows so their state is dropped."""
    src = _timed(df, ts, watermark)
    return (src.groupBy(F.window(ts, every).alias("w"))
            .agg(F.count("*").alias("purchases"), F.approx_count_distinct("user").alias("unique_users"),
                 F.sum("price").alias("revenue"))
            .select(fmt_batch_time(F.col("w.start")).alias("batch_start"), "purchases", "unique_users", "revenue"))


def purchase_summary_batches(spark: SparkSession, source: DataFrame, path: str,
                             checkpoint: str | None = None, trigger: dict | None = None,
                             ts: str | None = None, every: str = "1 day"):
    """STR-3 on a stream: each micro-batch is summarised exactly (distinct
    users need the whole batch) inside ``foreachBatch`` into the Parquet folder
    ``path``, which all executors share. A batch overwrites its own folder
    ``batch_id=<id>``, so a batch that runs again is not counted twice. With
    ``ts`` the batch is summarised per interval."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for the totals and for the top product
        try:
            purchase_summary(batch, ts=ts, every=every).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return stream_sink(source, checkpoint, foreach_batch=per_batch, trigger=trigger)


def running_totals(df: DataFrame, key: str = "user", value: str = "price") -> DataFrame:
    """STR-4: running (purchases, revenue) per key. On a stream use output
    mode ``complete`` (or ``update``); the state store keeps one row per key."""
    return df.groupBy(key).agg(F.count("*").alias("purchases"), F.sum(value).alias("revenue"))


STATE_OUT = "user string, purchases long, revenue double"
STATE_SCHEMA = "purchases long, revenue double"


def _make_fold(ttl_ms: int | None):
    def fold(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # idle longer than the TTL: forget the key
            state.remove()
            return
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in pdfs:
            n += int(len(pdf))
            total += float(pdf["price"].sum())
        state.update((n, total))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame({"user": [str(key[0])], "purchases": [n], "revenue": [total]})
    return fold


def stateful_fold(df: DataFrame, key: str = "user", ttl_ms: int | None = None) -> DataFrame:
    """STR-5: a user-written state update (count and sum carried per key
    across micro-batches) with ``applyInPandasWithState``. The state is two
    numbers per key; ``ttl_ms`` drops keys idle for that long (the reference
    keeps every key for ever)."""
    src = df.select(F.col(key).cast("string").alias("user"), F.col("price").cast("double"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    return src.groupBy("user").applyInPandasWithState(_make_fold(ttl_ms), STATE_OUT, STATE_SCHEMA, "update", timeout)
