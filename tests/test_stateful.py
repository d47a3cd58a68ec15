"""Pane windows, chained summaries, value state with timers, restarts."""
import datetime as dt
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.streaming import stateful as S
from quarry.streaming import streams as st

SCHEMA = "user long, product string, price double, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def feed(spark, folder, *files, schema=SCHEMA):
    """One file after the other, so that a stream takes them in this order."""
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return st.stream_source(spark, "parquet", folder, schema, maxFilesPerTrigger=1)


def run(df, tmp_dir, name, mode="append"):
    w = st.stream_sink(df, os.path.join(tmp_dir, "ck-" + name), fmt="memory", output_mode=mode, query_name=name, trigger={"availableNow": True})
    st.run_until_idle(w)
    return df.sparkSession.table(name).collect()


def at(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.mark.parametrize("seed", range(20))
def test_windows_by_adding_and_taking_off_equal_counting(seed):
    r = np.random.default_rng(seed)
    length, slide = [(10, 2), (6, 6), (12, 3)][seed % 3]
    times = np.sort(r.integers(0, 400, int(r.integers(1, 60))) * (1 if seed % 2 else 5))
    want = {}
    for t in times.tolist():
        p = t // slide * slide
        for e in range(p + slide, p + length + slide, slide):
            want[e] = want.get(e, 0) + 1
    # the panes arrive in several portions, each with its watermark
    panes, end, running, got = {}, -(1 << 40) // slide * slide, 0, []
    cuts = sorted(r.choice(np.arange(0, 2400, 7), 5, replace=False).tolist()) + [10_000]
    done = 0
    for upto in cuts:
        for t in times[(times // slide * slide + slide > done) & (times // slide * slide + slide <= upto)].tolist():
            p = t // slide * slide
            panes[p] = panes.get(p, 0) + 1
        closed, end, running = S.advance(panes, end, running, upto // slide * slide, length, slide)
        got += closed
        done = upto
        assert len(panes) <= length // slide + 2 + sum(1 for p in panes if p >= end)
    assert got == sorted(want.items()) and all(n > 0 for _, n in got) and not panes


def test_windows_of_many_panes_take_one_pass():
    """A trigger may close windows over days of panes; none is looked at per window."""
    class Counted(dict):
        looked = 0

        def __iter__(self):
            for p in super().__iter__():
                Counted.looked += 1
                yield p

    n = 3000
    panes = Counted({20 * i: 1 for i in range(n)})
    closed, end, running = S.advance(panes, -(1 << 40) // 2 * 2, 0, 1 << 40, 10, 2)
    assert len(closed) == 5 * n and all(x == 1 for _, x in closed) and running == 0 and not panes
    assert end == 20 * (n - 1) + 12 and Counted.looked <= 4 * n


def test_pane_windows_equal_the_batch_windows(spark, tmp_dir):
    r = np.random.default_rng(3)
    files = [[(1, str(r.choice(["a", "b", "hot"], p=[0.1, 0.1, 0.8])), 1.0, at(int(i * 60 + x))) for x in r.integers(0, 75, 40)] for i in range(5)]
    stream = feed(spark, os.path.join(tmp_dir, "in"), *files, [(0, "end", 0.0, at(90_000))])
    with S.with_rocksdb(spark):
        got = sorted(tuple(x) for x in run(S.pane_windows(stream.select("product", "ts"), token="product"), tmp_dir, "panes"))
    rows = spark.createDataFrame([x for f in files for x in f], SCHEMA)
    want = sorted(tuple(x) for x in st.sliding_counts(rows, "product", "ts", "10 seconds", "2 seconds").collect())
    assert got == want and len(got) > 100
    with pytest.raises(ValueError):
        S.pane_windows(stream, length_s=10, slide_s=3)


def test_chained_summary_is_exact_and_leaves_late_rows_out(spark, tmp_dir):
    day = 86_400
    one = [(1, "a", 2.0, at(10)), (1, "b", 3.0, at(20)), (2, "b", 1.0, at(30)), (None, "a", 1.0, at(35)), (2, "a", 1.0, at(day - 100))]
    two = [(3, "c", 9.0, at(day + 5)), (1, "b", 4.0, at(day - 50)), (3, None, 1.0, at(day + 9))]
    three = [(4, "z", 1.0, at(day * 2 + 7200))]
    four = [(4, "z", 1.0, at(day * 2 + 7210))]
    late = [(5, "late", 100.0, at(40)), (6, "q", 1.0, at(2 * day + 7300))]
    end = [(None, None, None, at(9 * day))]
    stream = feed(spark, os.path.join(tmp_dir, "in"), one, two, three, four, late, end)
    got = {r["batch_start"][:10]: tuple(r)[1:] for r in run(S.exact_summary(stream), tmp_dir, "chained")}
    assert got == {"2024-01-01": (6, 2, 12.0, "a", 3), "2024-01-02": (2, 1, 10.0, "c", 1), "2024-01-03": (3, 2, 3.0, "z", 2)}


def test_totals_expire_when_idle(spark, tmp_dir):
    files = [[(1, "a", 1.0, at(0)), (2, "a", 5.0, at(5)), (1, "b", 2.0, at(10))], [(2, "a", 1.0, at(4000))], [(1, "a", 7.0, at(9000))],
             [(3, "a", 0.0, at(20_000))]]
    with S.with_rocksdb(spark):
        stream = feed(spark, os.path.join(tmp_dir, "in"), *files)
        rows = run(S.totals_with_expiry(stream, watermark="1 second", idle_ms=3_000_000), tmp_dir, "expiring", "update")
    seen = {}
    for r in rows:
        seen.setdefault(r["user"], []).append((r["expired"], r["purchases"], r["revenue"]))
    # user 1 is idle for more than 3,000 s between 10 and 9,000 and starts anew
    assert (True, 2, 3.0) in seen["1"] and (False, 1, 7.0) in seen["1"]
    assert (True, 1, 7.0) in seen["1"] and any(x[0] for x in seen["2"])
    assert not any(n > 2 for v in seen.values() for _, n, _ in v)


def test_restart_after_a_failed_batch_counts_once(spark, tmp_dir):
    files = [[(u, "a", float(u + i), at(i * 100 + u)) for u in range(5)] for i in range(4)]
    src, ck, out = (os.path.join(tmp_dir, x) for x in ("in", "ck", "out"))
    failed = []

    def per_batch(batch, batch_id):
        if batch_id == 2 and not failed:
            failed.append(1)
            raise RuntimeError("made to fail")
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with S.with_rocksdb(spark):
        stream = feed(spark, src, *files)
        start = lambda: st.run_until_idle(st.stream_sink(S.totals_with_expiry(stream), ck, output_mode="update", foreach_batch=per_batch,
                                                         trigger={"availableNow": True}))
        with pytest.raises(Exception, match="made to fail"):
            start()
        assert sorted(os.listdir(out)) == ["batch_id=0", "batch_id=1"]
        start()
    last = spark.read.parquet(out).groupBy("user").agg(F.max(F.struct("batch_id", "purchases", "revenue")).alias("s")).collect()
    assert {r["user"]: (r["s"]["purchases"], r["s"]["revenue"]) for r in last} == {str(u): (4, 4.0 * u + 6) for u in range(5)}


def test_processing_time_trigger_and_console_sink(spark, tmp_dir, capfd):
    stream = feed(spark, os.path.join(tmp_dir, "in"), [(1, "a", 1.0, at(0))], [(2, "b", 2.0, at(1))])
    w = st.stream_sink(st.running_totals(stream), os.path.join(tmp_dir, "ck"), fmt="memory", output_mode="complete", query_name="timed",
                       trigger={"processingTime": "200 milliseconds"})
    st.run_until_idle(w, available_now=False)
    assert {r["user"]: r["purchases"] for r in spark.table("timed").collect()} == {1: 1, 2: 1}
    w = st.stream_sink(stream.select("product"), os.path.join(tmp_dir, "ck2"), trigger={"availableNow": True})
    q = st.run_until_idle(w)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 2
