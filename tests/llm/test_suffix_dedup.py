import hashlib

import numpy as np
import pytest

from quarry.llm import suffix_dedup as S


def brute(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        d = S.NO_ID if d is None else d
        for p in range(len(b) - 49):
            s = b[p:p + 50]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        k = S.NO_ID if d is None else d
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < k:
                gone[p:p + 50] = True
        rest = bytes(x for x, g in zip(b, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(30))
def test_suffix_ranks(seed):
    r = np.random.default_rng(seed)
    s = r.integers(1, 3 + seed % 4, int(r.integers(1, 400)))
    if seed % 3 == 0:
        s = np.tile(s[:5], 40)
    rank = S.suffix_ranks(s)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert np.argsort(rank).tolist() == want


def make_rows():
    r = np.random.default_rng(7)
    syl = ["ti", "on", "the ", "é", "ß ", "re", "and ", "\n", "ou"]
    text = lambda n: "".join(r.choice(syl, n))
    shared = [text(40) for _ in range(4)]
    rows = []
    for d in range(160):
        t = text(int(r.integers(0, 90)))
        for s in shared:
            if r.random() < 0.4:
                i = int(r.integers(0, len(t) + 1))
                t = t[:i] + s[int(r.integers(0, 9)):] + t[i:]
        rows.append((d, t))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (5, rows[5][1]), (5, rows[9][1]), (202, None), (203, ""),
             (204, "a" * 9000), (205, "a" * 7000), (206, "ab" * 3000 + rows[7][1]), (207, "ba" * 2000),
             (None, rows[4][1]), (None, "x" * 60)]
    return rows


def test_matches_brute_force(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in S.repeat_report(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.repeat_report(df).count() == 0
    df = spark.createDataFrame([(2, "z" * 80, 1, "k"), (1, "z" * 80, 1, "k")],
                               "doc_id long, text string, n_removed int, __block string")
    out = S.without_repeats(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "z" * 80, 2: ""}


@pytest.mark.parametrize("split_bytes,fan", [(0, 512), (300, 512), (5000, 7), (1 << 20, 5), (0, 3)])
def test_split_minimisers_and_two_hops_match_brute_force(spark, split_bytes, fan):
    rows = make_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, names = S.remove_repeats(df, split_bytes=split_bytes, fan=fan)
    got = got.select("doc_id", *[names[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_frequent_phrase_with_new_neighbours_fills_no_group(spark):
    from pyspark.sql import functions as F
    r = np.random.default_rng(11)
    new = lambda n: "".join(map(chr, r.integers(97, 123, n)))
    long = " and this longer passage of text is in every other of the documents "
    rows = [(d, new(60) + " this line stands in all documents " + new(60) + (long if d % 2 else "")) for d in range(3000)]
    base = spark.createDataFrame(rows, "c0 long, c1 string").withColumn("__block", (F.col("c0") % 64).cast("int"))

    def sizes(split_bytes):
        runs = S._sent_runs(base, "c0", "c1", 32, 64, split_bytes)
        return [x[1] for x in runs.groupBy("part").agg(F.sum(F.length("meta") + F.length("body"))).collect()]
    by_minimiser, split = sizes(1 << 40), sizes(10_000)
    assert max(by_minimiser) > 0.2 * sum(by_minimiser)   # by minimiser alone: a few groups hold all
    # strings that no other document has do not travel at all, the others evenly
    assert max(split) < 0.2 * max(by_minimiser) and sum(split) < sum(by_minimiser)


def test_hashes_that_collide_do_not_make_strings_equal(spark, monkeypatch):
    # one hash for all runs: bytes alone must tell them apart
    import pyarrow as pa
    rows = make_rows()[:60]

    def tables():
        t = pa.table({"k": pa.array([d for d, _ in rows], pa.int64()), "t": [x for _, x in rows],
                      "__block": pa.array([0] * len(rows), pa.int32())})
        found = S._send_minimisers("k", "t", 4)(t)
        hits = pa.concat_tables([S._repeated(found.filter(pa.array([p == q for q in found["part"].to_pylist()])), 0, 1) for p in range(4)])
        by = S._to_blocks(hits)
        strings = S._send_heavy("k", "t", 4, 1)(t, by)
        again = S._to_blocks(pa.concat_tables([S._repeated(strings.filter(pa.array([p == q for q in strings["part"].to_pylist()])), 1e18, 1)
                                               for p in set(strings["part"].to_pylist())]))
        both = pa.concat_tables([by.append_column("strings", pa.array([False] * len(by))), again.append_column("strings", pa.array([True] * len(again)))])
        runs = S._send_runs("k", "t", 4, 1)(t, both)
        cov = S._resolve(runs)
        return S._cut_texts("k", "t", ["k", "t", "n", "r", "s", "h", "x"])(t, cov)
    want = brute(rows)
    for name in ("_run_hashes", "_start_hashes"):
        monkeypatch.setattr(S, name, lambda b, start, *rest: np.full(len(start), 7, dtype=S.U))
        got = tables()
        assert sorted(zip(*(got.column(c).to_pylist() for c in ("k", "n", "r", "s", "h"))), key=str) == want


def test_a_block_sends_as_much_at_any_number_of_partitions():
    import time

    import pyarrow as pa
    r = np.random.default_rng(5)
    text = bytes(r.integers(97, 123, 2_500_000, dtype=np.uint8)).decode()
    rows = [text[i:i + 2500] for i in range(0, len(text), 2500)]
    t = pa.table({"k": pa.array(range(len(rows)), pa.int64()), "t": rows, "__block": pa.array([0] * len(rows), pa.int32())})
    took, sent = [], []
    for parts in (64, 64, 131_072):
        began = time.perf_counter()
        out = S._send_minimisers("k", "t", parts, -(-parts // S.FAN))(t)
        took.append(time.perf_counter() - began)
        sent.append(out.num_rows)
    assert sent[-1] <= S.FAN and took[-1] < 3 * took[1] + 0.2


def test_texts_longer_than_a_piece(spark):
    r = np.random.default_rng(6)
    long = "".join(map(chr, r.integers(97, 123, (1 << 20) + 5000)))
    rows = [(1, long), (2, "start " + long[-3000:] + " end"), (3, long[:200])]
    got = {x["doc_id"]: x for x in S.repeat_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"], got[3]["n_removed"]) == (0, 3000, 200)
