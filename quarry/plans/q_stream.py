"""Streaming operators (STR-*): running file streams over the given events, and
their batch twins, both checked against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import fixtures as fx
from quarry.plans.registry import query, rounded
from quarry.session import scratch_path
from quarry.streaming import stateful as sf_
from quarry.streaming import streams as st

W = fx.with_fixtures

# Flagship: per-day purchases, unique users, revenue, top product.
PURCHASE_SUMMARY_SQL = W("""
, b AS (SELECT *, time_bucket(INTERVAL 1 day, ts) AS w FROM purchases)
, tot AS (SELECT w, count(*) AS purchases, count(DISTINCT "user") AS unique_users,
                 sum(price) AS revenue FROM b GROUP BY w)
, pc AS (SELECT w, product, count(*) AS n FROM b GROUP BY w, product)
, top AS (SELECT w, product AS top_product, n AS top_count FROM (
            SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, product) AS r FROM pc) WHERE r = 1)
SELECT strftime(tot.w, '%Y-%m-%d %H:%M:%S') AS batch_start, purchases, unique_users,
       round(revenue, 6) AS revenue, top_product, top_count
FROM tot JOIN top ON tot.w = top.w""", "purchases")


def _event_stream(spark, sf, files: int = 4):
    """``events`` as a file stream: written as ``files`` files into the shared
    folder and read from there, two files per trigger."""
    path = scratch_path(spark, "events")
    src = fx.purchases(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    src.repartition(files).write.parquet(path)
    return spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _ran(df, output_mode: str, spark):
    """Run a streaming frame to the end of its input and return its last result.
    Each batch overwrites the result folder (complete mode) or its own (update)."""
    out = scratch_path(df.sparkSession, "stream-out")
    whole = output_mode == "complete"

    def per_batch(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{'all' if whole else f'batch_id={batch_id}'}")

    st.run_until_idle(st.stream_sink(df, output_mode=output_mode, foreach_batch=per_batch, trigger={"availableNow": True}))
    return spark.read.parquet(f"{out}/all" if whole else out)


@query("str03_purchase_summary", PURCHASE_SUMMARY_SQL)
def purchase_summary(spark, sf):
    return rounded(st.purchase_summary(fx.purchases(spark, sf), "ts", "1 day"))


# STR-1: token counts per tumbling interval (batch twin of the per-batch count).
@query("str01_token_counts", W("""
SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS batch_start, token, count(*) AS n
FROM (SELECT ts, unnest(string_split(product, ' ')) AS token FROM purchases) GROUP BY 1, 2""", "purchases"))
def token_counts(spark, sf):
    return st.stream_token_counts(fx.purchases(spark, sf), "product", "ts", "1 hour", "word")


@query("str01_char_counts", W("""
SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS batch_start, token, count(*) AS n
FROM (SELECT ts, unnest(string_split(product, '')) AS token FROM purchases) GROUP BY 1, 2""", "purchases"))
def char_counts(spark, sf):
    """What the per-second program computes as written: character counts."""
    return st.stream_token_counts(fx.purchases(spark, sf), "product", "ts", "1 hour", "char")


# STR-2: 10 s windows sliding every 2 s; a row falls into the 5 windows whose
# start is one of the five 2-second marks at or before it.
@query("str02_sliding_counts", W("""
, b AS (SELECT epoch_us(ts) AS us, product AS token FROM purchases)
, w AS (SELECT token, (us // 2000000 - k) * 2000000 AS start_us FROM b, range(0, 5) t(k))
SELECT strftime(make_timestamp(start_us), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(start_us + 10000000), '%Y-%m-%d %H:%M:%S') AS window_end, token, count(*) AS n
FROM w GROUP BY start_us, token""", "purchases"))
def sliding_counts(spark, sf):
    return st.sliding_counts(fx.purchases(spark, sf), "product", "ts", "10 seconds", "2 seconds", "word")


@query("str04_running_totals", W("""
SELECT "user", count(*) AS purchases, round(sum(price), 6) AS revenue FROM purchases GROUP BY "user\"""",
                                 "purchases"))
def running_totals(spark, sf):
    return rounded(st.running_totals(fx.purchases(spark, sf)))


@query("str01_stream_counts", W("""
SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS batch_start, token, count(*) AS n
FROM (SELECT ts, unnest(string_split(product, ' ')) AS token FROM purchases) GROUP BY 1, 2""", "purchases"))
def stream_counts(spark, sf):
    """STR-1 / STR-7 on a running stream with a watermark."""
    return _ran(st.stream_token_counts(_event_stream(spark, sf), "product", "ts", "1 hour", "word"), "complete", spark)


@query("str02_stream_sliding", W("""
, b AS (SELECT epoch_us(ts) AS us, product AS token FROM purchases)
, w AS (SELECT token, (us // 2000000 - k) * 2000000 AS start_us FROM b, range(0, 5) t(k))
SELECT strftime(make_timestamp(start_us), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(start_us + 10000000), '%Y-%m-%d %H:%M:%S') AS window_end, token, count(*) AS n
FROM w GROUP BY start_us, token""", "purchases"))
def stream_sliding(spark, sf):
    """STR-2 on a running stream."""
    return _ran(st.sliding_counts(_event_stream(spark, sf), "product", "ts", "10 seconds", "2 seconds", "word"),
                "complete", spark)


@query("str03_stream_summary", PURCHASE_SUMMARY_SQL)
def stream_summary(spark, sf):
    """STR-3 on a running stream: exact daily summaries inside ``foreachBatch``.
    One trigger takes the whole back-fill, so a day is in one batch."""
    src = scratch_path(spark, "events")
    rows = fx.purchases(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(4).write.parquet(src)
    out = scratch_path(spark, "purchase-summary")
    stream = st.stream_source(spark, "parquet", src, rows.schema)
    st.run_until_idle(st.purchase_summary_batches(spark, stream, out, trigger={"availableNow": True}, ts="ts"))
    return rounded(spark.read.parquet(out).drop("batch_id"))


_TOTALS_SQL = W("""
SELECT "user"::VARCHAR AS "user", count(*) AS purchases, round(sum(price), 6) AS revenue FROM purchases GROUP BY "user\"""",
                "purchases")


@query("str04_stream_totals", _TOTALS_SQL)
def stream_totals(spark, sf):
    """STR-4 on a running stream (complete mode, several triggers)."""
    totals = _ran(st.running_totals(_event_stream(spark, sf)), "complete", spark)
    return rounded(totals.withColumn("user", F.col("user").cast("string")))


@query("str05_stream_fold", _TOTALS_SQL)
def stream_fold(spark, sf):
    """STR-5 on a running stream: the user-written state carried over the
    triggers; the last update of each user is its total."""
    updates = _ran(st.stateful_fold(_event_stream(spark, sf)), "update", spark)
    last = updates.groupBy("user").agg(F.max(F.struct("batch_id", "purchases", "revenue")).alias("s"))
    return rounded(last.select("user", "s.purchases", "s.revenue"))


@query("str06_parse_events", W("""
, l AS (SELECT concat_ws(',', "user"::VARCHAR, product, price::VARCHAR) AS value FROM purchases)
SELECT string_split(value, ',')[1] AS "user", string_split(value, ',')[2] AS product,
       round(TRY_CAST(string_split(value, ',')[3] AS DOUBLE), 6) AS price FROM l""", "purchases"))
def parse_events(spark, sf):
    lines = st.event_lines(fx.purchases(spark, sf)).select("value")
    return rounded(st.parse_events(lines))


# --- several triggers, late rows, restarts -----------------------------------------------------

STEPS, LATEST_S = 6, 1800      # files of a back-fill; the most a row comes late


def _late_stream(spark, sf):
    """``events`` as a file stream in about the order of time: ``STEPS`` files, two
    per trigger. A row reaches a file up to half an hour (by its user) after its
    time, so files overlap. A last row, days later, lets the watermark pass all."""
    rows = fx.purchases(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    seen = F.unix_timestamp("ts") + F.pmod(F.col("user"), F.lit(7)) * F.lit(LATEST_S // 7)
    span = rows.agg(F.min(seen).alias("lo"), F.max(seen).alias("hi"), F.max("ts").alias("last")).first()
    path = scratch_path(spark, "late-events")
    if span["lo"] is not None:
        width = (span["hi"] - span["lo"]) // STEPS + 1
        chunk = F.floor((seen - F.lit(span["lo"])) / F.lit(width))
        for i in range(STEPS):      # one write after the other: files are taken in the order of their times
            rows.where(chunk == i).coalesce(1).write.mode("append").parquet(path)
        end = rows.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != "ts"],
                                   (F.lit(span["last"]) + F.expr("INTERVAL 5 DAYS")).alias("ts")).select(*rows.columns)
        end.write.mode("append").parquet(path)
    else:
        rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


@query("str02_pane_windows", W("""
, b AS (SELECT epoch_us(ts) AS us, product AS token FROM purchases)
, w AS (SELECT token, (us // 2000000 - k) * 2000000 AS start_us FROM b, range(0, 5) t(k))
SELECT strftime(make_timestamp(start_us), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(start_us + 10000000), '%Y-%m-%d %H:%M:%S') AS window_end, token, count(*) AS n
FROM w GROUP BY start_us, token""", "purchases"))
def pane_windows(spark, sf):
    """STR-2 with the inverse function: panes counted once, windows by adding the pane
    that enters and taking off the one that leaves; late rows, several triggers."""
    # (the outer form keeps the last row, whose time closes all windows)
    words = _late_stream(spark, sf).select("ts", F.explode_outer(F.split("product", " ")).alias("token"))
    with sf_.with_rocksdb(spark):
        return _ran(sf_.pane_windows(words, watermark="1 hour"), "append", spark).drop("batch_id")


@query("str03_chained_summary", PURCHASE_SUMMARY_SQL)
def chained_summary(spark, sf):
    """STR-3 over several triggers: exact distinct users by chained aggregations."""
    return rounded(_ran(sf_.exact_summary(_late_stream(spark, sf)), "append", spark).drop("batch_id"))


@query("str07_restarted_totals", _TOTALS_SQL)
def restarted_totals(spark, sf):
    """STR-4/5/7: totals in a value state. The second batch fails after it has written
    a part of its output; the stream is started again from its checkpoint and goes
    on. No row is counted twice or lost."""
    stream = _late_stream(spark, sf)
    out, checkpoint, failed = scratch_path(spark, "totals"), scratch_path(spark, "totals-checkpoint"), []

    def per_batch(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            batch.limit(3).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            raise RuntimeError("the batch is made to fail")
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    def start():
        totals = sf_.totals_with_expiry(stream)
        st.run_until_idle(st.stream_sink(totals, checkpoint, output_mode="update", foreach_batch=per_batch, trigger={"availableNow": True}))

    with sf_.with_rocksdb(spark):
        try:
            start()
        except Exception:
            if not failed:
                raise
            start()
    updates = spark.read.parquet(out).where("user is not null")
    last = updates.groupBy("user").agg(F.max(F.struct("batch_id", "purchases", "revenue")).alias("s"))
    return rounded(last.select("user", "s.purchases", "s.revenue"))
