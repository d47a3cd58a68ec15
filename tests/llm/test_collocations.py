import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import collocations as C
from quarry.llm.quotient_filter import QuotientFilter, U, permute, restore, sort_order

SCHEMA = "doc_id long, lang string, text string"


def random_halves(half, n, seed):
    rng = np.random.default_rng(seed)
    top = (1 << half) - 1
    return (rng.integers(0, top, n, dtype=np.uint64, endpoint=True), rng.integers(0, top, n, dtype=np.uint64, endpoint=True))


@pytest.mark.parametrize("half", [1, 7, 31, 32, 33, 40, 63, 64])
def test_permutation_is_invertible(half):
    hi, lo = random_halves(half, 500, half)
    a, b = permute(hi, lo, half)
    assert a.max() <= (1 << half) - 1 and b.max() <= (1 << half) - 1
    x, y = restore(a, b, half)
    assert (x == hi).all() and (y == lo).all()
    if half == 1:
        every = {permute(np.array([i], U), np.array([j], U), 1)[0][0] * 2 + permute(np.array([i], U), np.array([j], U), 1)[1][0]
                 for i in (0, 1) for j in (0, 1)}
        assert len(every) == 4


@pytest.mark.parametrize("half", [32, 34, 50, 64])
def test_filters_lose_nothing(half):
    hi, lo = random_halves(half, 300, half)
    rng = np.random.default_rng(half)
    pick = [rng.integers(0, 300, 2000) for _ in range(5)]
    want = Counter()
    parts = []
    for p in pick:
        p[:600] = 7                                    # a count that needs more than a byte
        want.update(zip(hi[p].tolist(), lo[p].tolist()))
        parts.append(QuotientFilter.from_bytes(QuotientFilter.of(hi[p], lo[p], half).to_bytes()))
    whole = QuotientFilter.merge(parts)
    x, y, n = whole.entries()
    assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == dict(want)
    # cut, stored, merged level by level
    got = {}
    for block in {b for p in parts for b, _ in p.split(3)}:
        cut = [QuotientFilter.from_bytes(f.to_bytes()) for p in parts for b, f in p.split(3) if b == block]
        for sub, f in QuotientFilter.merge(cut).split(2):
            x, y, n = QuotientFilter.from_bytes(f.at_least(2).to_bytes()).entries(block << 2 | sub)
            got.update(zip(zip(x.tolist(), y.tolist()), n.tolist()))
    assert got == {k: n for k, n in want.items() if n >= 2}


@pytest.mark.parametrize("bits", [16, 17, 21, 31, 32])
def test_packing_of_ids_is_lossless(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 400, dtype=np.uint64)
    ids[rng.random(400) < 0.2] = 0
    want = {k: Counter(tuple(map(int, ids[i:i + k])) + (0,) * (4 - k) for i in range(401 - k) if ids[i:i + k].all()) for k in (2, 3, 4)}
    for k, hi, lo in C.packed_grams(ids.astype(np.uint32), bits):
        half = C.half_bits(k, bits)
        assert not len(hi) or max(int(hi.max()), int(lo.max())) < 1 << half
        x, y, n = QuotientFilter.of(hi, lo, half).entries()
        got = {tuple(map(int, t)): int(c) for *t, c in zip(*C.unpacked_grams(k, x, y, bits), n)}
        assert got == dict(want[k])


def test_planes():
    x = np.array([0, 1, 255, 256, 70_000, 2 ** 31 - 1], dtype=np.int32)
    assert C.from_planes(C.to_planes(x)).tolist() == x.tolist() and C.from_planes(C.to_planes(x[:0])).tolist() == []


def test_empty_filter():
    f = QuotientFilter.of(np.zeros(0, U), np.zeros(0, U), 32)
    assert f.split(4) == [] and len(QuotientFilter.from_bytes(f.to_bytes()).hi) == 0


def test_order_compares_both_halves():
    hi = np.array([5, 5, 5, 4], U)
    lo = np.array([3, 1, 2, 9], U)
    for half in (40, 64):
        assert sort_order(hi, lo, half).tolist() == [3, 1, 2, 0]


def brute(rows, least, top, inside):
    counts, total = {}, Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    c = counts.setdefault(lang, Counter())
                    c[tuple(w[i:i + k])] += 1
    out = []
    for lang, c in counts.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            cuts = [(2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            held = any(len(q) > len(p) and 100 * b >= inside * a
                       and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items())
            if not held:
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def sample():
    rng = np.random.default_rng(11)
    words = ["New", "york", "city", "the", "of", "é", "日本", "a\x01", "b", "x-1", "\x00", "THE"]
    weight = np.array([9, 9, 5, 20, 15, 4, 3, 3, 6, 2, 2, 8], float)
    texts = []
    for i in range(400):
        w = rng.choice(words, int(rng.integers(0, 60)), p=weight / weight.sum())
        text = " ".join(w).replace("New york", "New York City Hall")
        for at in rng.integers(0, max(len(text), 1), 4):
            text = text[:at] + str(rng.choice(list(".,;:!?\n\x0b\x0c\r\t "))) + text[at:]
        texts.append((["en", "fr", None, "und"][i % 4], text))
    return texts + [("en", None), ("en", ""), ("xx", "only a few words"), ("en", "in the end " * 3000), ("de", "ß ß ß " * 100)]


@pytest.mark.parametrize("least,top,fan,shard", [(5, 2000, 64, 16_000_000), (5, 20, 2, 2000), (30, 7, 4, 5000)])
def test_equals_brute_force(spark, monkeypatch, least, top, fan, shard):
    monkeypatch.setattr(C, "FAN", fan)
    rows = sample()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).withColumn("phrase", F.lit(0)) \
              .withColumn("W1", F.lit("x")).repartition(7)
    shards = C.word_shards

    def small(frame, lang, text):
        import pyarrow as pa  # noqa: F401
        from quarry.llm import collocations as inner
        size = shard

        def run(batches):
            inner.SHARD = size
            yield from inner._shards(batches)
        frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
        src = frame.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
        return inner.written(src.mapInArrow(run, "shard long, codes binary, langs array<string>, words array<string>, "
                                                 "counts array<long>"), "test-shards")
    monkeypatch.setattr(C, "word_shards", small if shard < 16_000_000 else shards)
    got = sorted(tuple(r) for r in C.mine_collocations(df, least=least, top=top, fan=fan).collect())
    assert got == brute(rows, least, top, 80)
    assert len(got) > 10


def test_empty_tables_and_no_candidates(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.mine_collocations(empty).count() == 0
    assert C.mine_collocations(spark.createDataFrame([(1, "en", "a b c"), (2, None, None)], SCHEMA)).count() == 0
