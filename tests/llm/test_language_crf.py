import zlib

import numpy as np
import pytest

from quarry.llm import language_crf as L
from tests.conftest import SF_MID


def exact(e, move, start):
    """Forward-backward of one chain, position by position, in logarithms."""
    a = [start + e[0]]
    for x in e[1:]:
        a.append(np.logaddexp.reduce(a[-1][:, None] + move, axis=0) + x)
    b = [np.zeros(e.shape[1])]
    for x in e[:0:-1]:
        b.insert(0, np.logaddexp.reduce(move + x + b[0], axis=1))
    z = np.array(a) + np.array(b)
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("n", [1, 2, 7, 50, 400])
def test_forward_backward_is_exact(n):
    r = np.random.default_rng(n)
    e, move, start = r.normal(size=(n, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    first = r.random(n) < 0.1
    first[0] = True
    cuts = [*np.flatnonzero(first), n]
    want = np.concatenate([exact(e[x:y], move, start) for x, y in zip(cuts[:-1], cuts[1:])])
    assert np.allclose(L.forward_backward(e, first, move, start), want, atol=1e-10)


def test_held_out_accuracy_and_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = L.identify(docs).toPandas()
    truth = docs.select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth)
    assert both["held_out"].tolist() == [zlib.crc32(str(d).encode()) % 5 == 0 for d in both["doc_id"]]
    out = both[both["held_out"]]
    assert (out["lang_pred"] == out["lang"]).mean() > 0.97
    assert both["score"].between(0, 1).all()


def test_labels_words_of_mixed_text_and_edge_rows(spark):
    texts = [("the house of the king and the", "en"), ("le roi de la maison et les", "fr")] * 60
    model = L.train(texts)
    words, _, post = L.label_words(model, ["the king and the house le roi et la maison"])
    assert [model.langs[i] for i in post.argmax(axis=1)] == ["en"] * 5 + ["fr"] * 5
    rows = [(1, None, "en", "x"), (2, "", None, "x"), (3, "123 !!", "fr", "x"), (4, "the king " * 9000, None, "x"),
            (None, "le roi et la maison", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = {r["doc_id"]: r for r in L.identify(df, model=model).collect()}
    assert [out[k]["lang_pred"] for k in (1, 2, 3, 4, None)] == ["und", "und", "und", "en", "fr"]
    assert out[1]["score"] == 0 and out[None]["held_out"]
    nothing = L.identify(df.where("lang is null"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert L.identify(df.limit(0), model=model).count() == 0
    kept = L.keep_identified(df.where("lang is null"))
    assert kept.columns == df.columns and kept.count() == 2


def without_french():
    from pyspark.sql import SparkSession
    docs = SparkSession.getActiveSession().read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").toPandas()
    held = docs["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)
    taught = docs[~held & (docs["lang"] != "fr")].groupby("lang").head(100)
    return L.train([(t[:3000], g) for t, g in zip(taught["text"], taught["lang"])]), docs[held]


def test_every_text_with_a_letter_gets_a_learned_language(spark):
    model, out = without_french()
    short = ["OK", "a", "Ceci", "Dr. Smith", "x1", "1a2", "Tämä on suomea ja vain suomea", "これは日本語です", "\U0001f600 ñ", "Ⅷ no"]
    p = L.predict(model, short + out["text"].tolist())
    assert set(p["lang_pred"]) <= set(model.langs) and (p["score"] > 0).all() and (p["score"] <= 1).all()
    none = L.predict(model, [None, "", "  ", "123 ... !?", "½ ²", "_ _", "\U0001f600"])
    assert set(none["lang_pred"]) == {"und"} and not none["score"].any()


def test_texts_in_no_learned_language_are_judged_so(spark):
    model, out = without_french()
    assert len(model.langs) == 3  # the largest share of three is never under a third
    r = np.random.default_rng(1)
    words = lambda t: L.split_words([t])[0]
    known = out.loc[out["lang"] != "fr", "text"].tolist()
    unseen = out.loc[out["lang"] == "fr", "text"].tolist()
    scrambled = [" ".join("".join(r.permutation(list(w))) for w in words(t)[:200]) for t in known]
    random = [" ".join("".join(map(chr, r.integers(97, 123, 7))) for _ in range(100)) for _ in range(20)]
    mixed = [f"{a[:500]} {b[:500]}" for a, b in zip(out.loc[out["lang"] == "de", "text"], out.loc[out["lang"] == "es", "text"])]
    for texts, good in ((known, True), (mixed, True), (unseen, False), (scrambled, False), (random, False)):
        assert (L.predict(model, texts, judge=True)["in_learned"] == good).mean() > 0.97


def test_the_stage_keeps_texts_of_its_languages_and_drops_others(spark):
    # which rows must go is known from how they were made, not from the rule
    _, out = without_french()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("lang <> 'fr'").select("doc_id", "text", "lang")
    r = np.random.default_rng(2)
    junk = [(10_000_000 + i, " ".join("".join(map(chr, r.integers(97, 123, 8))) for _ in range(60)), None) for i in range(30)]
    foreign = [(20_000_000 + i, t, None) for i, t in enumerate(out.loc[out["lang"] == "fr", "text"].tolist())]
    plain = [(30_000_000, "12 34", None), (30_000_001, None, None)]
    df = docs.unionByName(spark.createDataFrame(junk + foreign + plain, docs.schema))
    kept = {row["doc_id"] for row in L.keep_identified(df).collect()}
    good = {row["doc_id"] for row in docs.collect()}
    assert len(kept & good) >= 0.97 * len(good)
    assert len(kept - good) <= 0.03 * len(junk + foreign) and not kept & {30_000_000, 30_000_001}


def test_more_labels_than_can_be_learned(spark):
    rows = [(i, "the king and the house " * 3, f"l{i % 50:02d}" if i < 100 else "en") for i in range(400)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_langs=3)
    assert len(model.langs) == 3 and "en" in model.langs
