import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import differencing as D
from quarry.llm.common import table
from quarry.llm.queries import op11_karmarkar_karp_packing
from quarry.llm.word_ids import encoder
from tests.conftest import SF_SMALL

ODD = ["it's  WE'LL 'S 'Ll\n\n don't", "a b  c　​ d", "x\x1cy\x1d z\x85q", "日本語 テキスト 123½ Ⅷ", "ÀÉÎ ß İstanbul ΑΣ ﬁ é",
       "<|endoftext|> inside <|startoftext|>", "<|ENDOFTEXT|> y", "word" * 500, "''''s s' 's", "A\x0bB\x0cC", "ª º µ x²½", "ſ K Å", ""]


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(D.TOKENIZER))


def test_ids_equal_the_tokenizer(spark):
    texts = ODD + [r["text"] for r in table(spark, SF_SMALL, "documents").collect()]
    tok, enc = tokenizer(), encoder(D.TOKENIZER)
    assert enc.by_word
    ids, n = enc.encode(texts)
    cut = np.cumsum(n)
    for i, t in enumerate(texts):
        assert ids[cut[i] - n[i]:cut[i]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_other_tokenizers_encode_whole_texts():
    enc = encoder("byte_bpe_50k.json")
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, n = enc.encode(ODD)
    assert not enc.by_word and ids.tolist() == [i for t in ODD for i in tok.encode(t, add_special_tokens=False).ids]


def by_definition(sizes, k):
    """Differencing as its definition says, on full k-tuples."""
    parts = [[0] * (k - 1) + [int(s)] for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: min(p) - max(p))
        a, b = sorted(parts[0], reverse=True), sorted(parts[1])
        parts = [[x + y for x, y in zip(a, b)], *parts[2:]]
    return sorted(parts[0])


@pytest.mark.parametrize("seed", range(40))
def test_differencing_equals_its_definition(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    k = int(rng.integers(1, min(n, 9) + 1))
    sizes = rng.choice(10 ** 6, n, replace=False) + 1
    where = D.karmarkar_karp(sizes, k)
    assert sorted(np.bincount(where, weights=sizes, minlength=k).astype(int).tolist()) == by_definition(sizes, k)


def test_windows_are_near_equal_and_rise_with_the_load():
    rng = np.random.default_rng(1)
    sizes = np.minimum(rng.lognormal(5.5, 1.2, 4000).astype(int) + 1, 4095)
    where, k = D.near_equal_windows(sizes, 4096)
    sums = np.bincount(where, weights=sizes, minlength=k)
    least = -(-int(sizes.sum()) // 4096)
    assert sums.max() <= 4096 and least <= k <= least * 1.01 and sums.max() - sums.min() < 100
    # items just over half a window: one each, however often the count has to rise
    where, k = D.near_equal_windows(np.full(300, 2049), 4096)
    assert k == 300 and sorted(where.tolist()) == list(range(300))


def check(rows, docs, capacity=4096, padded=False):
    tok = tokenizer()
    seqs, by_doc = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= capacity and (padded or at == capacity or at & (at - 1) == 0)
    assert set(by_doc) == {d for d, _ in docs}
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            crc = r["ids_crc32"] if "ids_crc32" in r.asDict() else zlib.crc32(r["ids"])
            assert crc == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_query_round_trip_without_padding(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    check(op11_karmarkar_karp_packing(spark, SF_SMALL).collect(), docs)


def test_odd_rows_and_many_groups(spark):
    docs = list(enumerate([*ODD, None, "long text " * 9000, "same", "same"]))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("IDS", F.lit("x"))
    check(D.pack_windows(df).collect(), docs)
    check(D.pack_windows(df, items=3).collect(), docs)
    check(D.pack_windows(df, close=False).collect(), docs, padded=True)
    # without closing, nothing up to the capacity is cut
    rows = D.pack_windows(df, close=False).collect()
    assert all(r["length"] == r["doc_tokens"] for r in rows if r["doc_tokens"] <= 4096)


def test_repeated_rows_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c")] * 50 + [(1, "a b c")] * 50, "doc_id long, text string")
    rows = D.pack_windows(df, capacity=16).collect()
    assert sum(r["length"] for r in rows) == 100 * 4
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 50 * 4
    assert D.pack_windows(df.limit(0)).count() == 0
