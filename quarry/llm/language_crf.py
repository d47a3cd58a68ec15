"""Language identification by a linear-chain conditional random field.

Words are the positions of the chain. Their scores come from prefixes, suffixes,
character n-grams, the word itself and word lists learned from the training
sample; transitions between languages are learned too. Forward-backward gives
the probability of each language at each word, so texts that switch language are
labelled word by word; a text's language is the one with most letters.

The field knows only the languages it learned and answers one of them for every
text with a letter. Whether a text is in any of them at all is judged apart from
that, by its n-grams: the share seen in training of the language each word got,
against the share that unseen text of that language has.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import with_results

WORD = re.compile(r"[^\W\d_]+")   # runs of letters
BUCKETS = 1 << 16
SAMPLE_DOCS = 300       # training documents per language (the bound of what the driver reads)
SAMPLE_CHARS = 3000     # characters of each of them
MAX_LANGS = 200         # languages learned: the commonest ones
SEQUENCES, SPAN, LENGTH = 900, (2, 25), 60   # code-switched training sequences
EPOCHS, RATE, DECAY = 60, 0.25, 1e-4
LEXICON_COUNT, LEXICON_SHARE = 3, 0.9
MIN_SCORE = 1 / 3         # a text with its letters spread evenly over many languages has none
SEEN_GRAM, SEEN_BITS = 5, 20   # n-grams, word boundaries included, remembered as bits of a table
MIN_SEEN = 0.6            # of the share seen in unseen text of the learned languages
FOLDS = 5
UNKNOWN = "und"
FIELDS = "lang_pred string, score double, n_words long, n_switches long"
JUDGED = FIELDS + ", in_learned boolean"

U = np.uint64


def split_words(texts: list) -> tuple[list[str], np.ndarray]:
    words: list[str] = []
    count = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        if t:
            w = WORD.findall(t.lower())
            words += w
            count[i] = len(w)
    return words, count


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ U(salt * 0x9E3779B9 + 0x7F4A7C15)) * U(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> U(31))) % U(BUCKETS)).astype(np.int64)


def feature_columns(words: list[str]):
    """Yields (bucket, weight) columns: for each word of equal-width chunks, one
    feature each. Called with words of similar length."""
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    width = int(size.max())
    code = np.zeros((n, width + 2), dtype=U)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(n), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    code[:, 0] = 1                                    # the word's beginning
    code[row, col + 1] = flat
    code[np.arange(n), size + 1] = 2                  # and its end
    one = np.ones(n)
    gram = 1.0 / np.maximum(size, 1)
    h = np.zeros((n, width + 2), dtype=U)
    for k in range(1, 5):                             # n-grams, boundaries included
        h = h[:, :width + 3 - k] * U(0x100000001B3) + code[:, k - 1:]
        for i in range(width + 3 - k):
            inside = i + k <= size + 2
            if k == 1:
                inside &= (i > 0) & (i <= size)
            if inside.any():
                yield _bucket(h[:, i], k), np.where(inside, gram * 2, 0.0)
        if k >= 2 and h.shape[1]:                         # (no word here may be that long)
            yield _bucket(h[:, 0], 10 + k), np.where(size + 1 >= k, one, 0.0)                     # prefix
            at = np.clip(size + 2 - k, 0, width + 2 - k)
            yield _bucket(h[np.arange(n), at], 20 + k), np.where(size + 1 >= k, one, 0.0)         # suffix
    whole = np.zeros(n, dtype=U)
    for i in range(width):
        whole = np.where(i < size, whole * U(0x100000001B3) + code[:, i + 1], whole)
    yield _bucket(whole, 30), one                                                                # the word


def _chunks(words: list[str], cells: int = 400_000):
    """Indices of the words, in chunks of similar length."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(size, kind="stable")
    i = 0
    while i < len(order):
        j = i + max(1, cells // int(size[order[i]] + 4))
        while j > i + 1 and (size[order[min(j, len(order)) - 1]] + 4) * (min(j, len(order)) - i) > 2 * cells:
            j = i + (j - i + 1) // 2
        yield order[i:j]
        i = j


def gram_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The word and the table place of every SEEN_GRAM-gram (a shorter word has one)."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    width = np.maximum(size + 2, SEEN_GRAM)
    at = np.cumsum(width) - width
    code = np.zeros(int(width.sum()), dtype=U)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    code[at], code[at + size + 1] = 1, 2
    code[np.arange(len(flat)) + np.repeat(at + 1 - (np.cumsum(size) - size), size)] = flat
    grams = width - SEEN_GRAM + 1
    row = np.repeat(np.arange(len(words)), grams)
    pos = np.arange(len(row)) + np.repeat(at - (np.cumsum(grams) - grams), grams)
    h = np.zeros(len(row), dtype=U)
    for i in range(SEEN_GRAM):
        h = (h ^ code[pos + i]) * U(0xBF58476D1CE4E5B9)
        h ^= h >> U(29)
    return row, (h >> U(64 - SEEN_BITS)).astype(np.int64)


def gram_table(words: list[str]) -> np.ndarray:
    bits = np.zeros(1 << SEEN_BITS, dtype=np.uint8)
    bits[gram_places(words)[1]] = 1
    return np.packbits(bits, bitorder="little")


def seen_shares(words: list[str], tables: np.ndarray) -> np.ndarray:
    """For each word and table, the share of the word's n-grams that the table holds."""
    row, place = gram_places(words)
    n = np.bincount(row, minlength=len(words))
    out = np.empty((len(words), len(tables)))
    for j, table in enumerate(tables):
        out[:, j] = np.bincount(row, weights=(table[place >> 3] >> (place & 7)) & 1, minlength=len(words)) / n
    return out


def usual_share(docs: list[list[str]]) -> float:
    """Share of letters whose n-grams are seen in half of the texts, over the other half."""
    known, other = docs[::2], [w for d in docs[1::2] for w in d]
    if not other:
        return 0.0
    letters = np.fromiter(map(len, other), dtype=np.float64, count=len(other))
    shares = seen_shares(other, gram_table([w for d in known for w in set(d)])[None])[:, 0]
    return float(letters @ shares / letters.sum())


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray          # bucket x language
    lexicon: dict[str, int]      # word -> language
    lexicon_weight: np.ndarray   # language of the list x language
    move: np.ndarray             # from x to
    start: np.ndarray
    seen: np.ndarray             # language x packed bits of the n-grams in its sample
    usual: np.ndarray            # share of n-grams seen that unseen text of the language has

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)))
        for idx in _chunks(words):
            part = [words[i] for i in idx.tolist()]
            s = np.zeros((len(part), len(self.langs)))
            for b, w in feature_columns(part):
                s += self.weights[b] * w[:, None]
            out[idx] = s
        listed = np.fromiter((self.lexicon.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        out[listed >= 0] += self.lexicon_weight[listed[listed >= 0]]
        return out

    def marginals(self, emission: np.ndarray, first: np.ndarray) -> np.ndarray:
        return forward_backward(emission, first, self.move, self.start)


def forward_backward(emission: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posterior of each label at each position of many chains laid end to end.

    ``first`` marks where a chain begins. The row of positions is cut into blocks
    of about the square root of its length; the blocks' transfer matrices are
    multiplied up side by side, one pass over the blocks hands on their ends, and
    a last pass runs inside all blocks at once. The result is exact whatever the
    length of a chain.
    """
    n, k = emission.shape
    if not n:
        return emission
    rows = max(1, int(np.sqrt(n)))
    cols = -(-n // rows)
    pad = rows * cols - n
    p = np.exp(emission - emission.max(axis=1, keepdims=True))
    p = np.concatenate([p, np.ones((pad, k))]).reshape(cols, rows, k).transpose(1, 0, 2)
    f = np.concatenate([first, np.ones(pad, dtype=bool)]).reshape(cols, rows).T
    step = np.exp(move - move.max())
    begin = np.broadcast_to(np.exp(start - start.max()), (k, k))

    def transfer(t: int) -> np.ndarray:
        return np.where(f[t][:, None, None], begin, step) * p[t][:, None, :]

    whole = np.broadcast_to(np.eye(k), (cols, k, k))
    for t in range(rows):
        whole = whole @ transfer(t)
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    left, right = np.empty((cols, k)), np.empty((cols, k))
    v = np.ones(k) / k
    for c in range(cols):
        left[c] = v
        v = v @ whole[c]
        v = v / v.sum()
    v = np.ones(k) / k
    for c in range(cols - 1, -1, -1):
        right[c] = v
        v = whole[c] @ v
        v = v / v.sum()
    ahead = np.empty((rows, cols, k))
    v = left
    for t in range(rows):
        v = (v[:, None, :] @ transfer(t))[:, 0, :]
        v = v / v.sum(axis=1, keepdims=True)
        ahead[t] = v
    v = right
    for t in range(rows - 1, -1, -1):
        ahead[t] *= v
        v = (transfer(t) @ v[:, :, None])[:, :, 0]
        v = v / v.sum(axis=1, keepdims=True)
    out = ahead.transpose(1, 0, 2).reshape(rows * cols, k)[:n]
    return out / out.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 5) -> Crf | None:
    """Fit on (text, language) pairs; None if there is nothing to learn from.

    The sample has one language per text, so code-switched sequences are made by
    joining spans of texts of random languages; their labels teach emissions and
    transitions by gradient steps (Adagrad) on the conditional likelihood."""
    by_lang: dict[str, list[list[str]]] = {}
    for text, lang in rows:
        w = split_words([text])[0]
        if w and lang is not None:
            by_lang.setdefault(lang, []).append(w)
    langs = sorted(by_lang)
    if not langs:
        return None
    k = len(langs)
    counts = [Counter(w for words in by_lang[g] for w in words) for g in langs]
    total: Counter = sum(counts, Counter())
    lexicon = {}
    for i in range(k):
        for w, c in counts[i].items():
            if c >= LEXICON_COUNT and c >= LEXICON_SHARE * total[w]:
                lexicon[w] = i
    r = np.random.default_rng(seed)
    words, labels, first = [], [], []
    for _ in range(SEQUENCES):
        have = 0
        while have < LENGTH:
            g = int(r.integers(k))
            doc = by_lang[langs[g]][int(r.integers(len(by_lang[langs[g]])))]
            m = min(int(r.integers(SPAN[0], SPAN[1] + 1)), LENGTH - have)
            at = int(r.integers(max(1, len(doc) - m + 1)))
            part = doc[at:at + m]
            words += part
            labels += [g] * len(part)
            first += [have == 0] + [False] * (len(part) - 1)
            have += len(part)
    ids, uniq = pd.factorize(np.array([*words, None], dtype=object)[:-1])
    uniq = list(uniq)
    cols = [(idx[w > 0], b[w > 0], w[w > 0]) for idx in _chunks(uniq)
            for b, w in feature_columns([uniq[i] for i in idx.tolist()])]
    who, bucket, value = (np.concatenate(x) for x in zip(*cols))
    listed = np.fromiter((lexicon.get(w, -1) for w in uniq), dtype=np.int64, count=len(uniq))
    y = np.array(labels)
    truth = np.eye(k)[y]
    is_first = np.array(first)
    inner = np.flatnonzero(~is_first)
    model = Crf(langs, np.zeros((BUCKETS, k)), lexicon, np.zeros((k, k)), np.zeros((k, k)), np.zeros(k),
                np.stack([gram_table(list(c)) for c in counts]), np.array([usual_share(by_lang[g]) for g in langs]))
    grad_sum = [np.full(x.shape, 1e-8) for x in (model.weights, model.lexicon_weight, model.move, model.start)]
    for _ in range(EPOCHS):
        e = np.zeros((len(uniq), k))
        for j in range(k):
            e[:, j] = np.bincount(who, weights=model.weights[bucket, j] * value, minlength=len(uniq))
        e[listed >= 0] += model.lexicon_weight[listed[listed >= 0]]
        post = forward_backward(e[ids], is_first, model.move, model.start)
        err = post - truth
        word_err = np.stack([np.bincount(ids, weights=err[:, j], minlength=len(uniq)) for j in range(k)], axis=1)
        g_w = np.stack([np.bincount(bucket, weights=word_err[who, j] * value, minlength=BUCKETS) for j in range(k)], axis=1)
        g_l = np.zeros((k, k))
        np.add.at(g_l, listed[listed >= 0], word_err[listed >= 0])
        # Expected minus seen transitions; the expectation from neighbouring posteriors.
        expect = _pairs(e[ids], post, inner, model.move)
        seen = np.zeros((k, k))
        np.add.at(seen, (y[inner - 1], y[inner]), 1.0)
        grads = [g_w, g_l, expect - seen, err[is_first].sum(axis=0)]
        for x, g, s in zip((model.weights, model.lexicon_weight, model.move, model.start), grads, grad_sum):
            g = g / SEQUENCES + DECAY * x
            s += g * g
            x -= RATE * g / np.sqrt(s)
    model.weights = model.weights.astype(np.float32)
    return model


def _pairs(e: np.ndarray, post: np.ndarray, inner: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Expected transitions, summed. The joint of two neighbours is rescaled to
    their posteriors (a few rounds of proportional fitting of the transition
    kernel, which is its exact form up to row and column factors)."""
    step = np.exp(move - move.max())
    a, b = post[inner - 1], post[inner]
    u, v = np.ones_like(a), np.ones_like(b)
    for _ in range(12):
        u = a / np.maximum(v @ step.T, 1e-300)
        v = b / np.maximum(u @ step, 1e-300)
    return step * (u.T @ v)


def label_words(model: Crf, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of the texts, their number per text and the posteriors of each word."""
    words, count = split_words(texts)
    if not words:
        return words, count, np.zeros((0, len(model.langs)))
    ids, uniq = pd.factorize(np.array([*words, None], dtype=object)[:-1])
    first = np.zeros(len(words), dtype=bool)
    first[(np.cumsum(count) - count)[count > 0]] = True
    return words, count, model.marginals(model.emissions(list(uniq))[ids], first)


def count_letters(words: list[str]) -> np.ndarray:
    """Letters of each word (a run may also hold signs such as fractions)."""
    return np.fromiter((len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words), dtype=np.float64, count=len(words))


def predict(model: Crf | None, texts: list, judge: bool = False) -> dict[str, np.ndarray]:
    """Language, score, words and language switches of each text; with ``judge`` also
    whether the text is in a learned language at all."""
    m = len(texts)
    pred = np.full(m, UNKNOWN, dtype=object)
    score = np.zeros(m)
    switches = np.zeros(m, dtype=np.int64)
    inside = np.zeros(m, dtype=bool)
    if model is None:
        out = {"lang_pred": pred, "score": score, "n_words": split_words(texts)[1], "n_switches": switches}
        return {**out, "in_learned": inside} if judge else out
    words, count = split_words(texts)
    if words:
        ids, uniq = pd.factorize(np.array([*words, None], dtype=object)[:-1])
        uniq = list(uniq)
        first = np.zeros(len(words), dtype=bool)
        first[(np.cumsum(count) - count)[count > 0]] = True
        post = model.marginals(model.emissions(uniq)[ids], first)
        doc = np.repeat(np.arange(m), count)
        letters = count_letters(uniq)[ids]
        total = np.bincount(doc, weights=letters, minlength=m)
        some = total > 0
        share = np.stack([np.bincount(doc, weights=post[:, j] * letters, minlength=m)
                          for j in range(len(model.langs))], axis=1)
        share[some] /= share[some].sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        pred[some] = np.array(model.langs, dtype=object)[best[some]]
        score[some] = np.clip(share[some, best[some]], 0.0, 1.0)
        lab = post.argmax(axis=1)
        change = (lab[1:] != lab[:-1]) & (doc[1:] == doc[:-1])
        switches = np.bincount(doc[1:][change], minlength=m).astype(np.int64)
        if judge:
            seen = (post * seen_shares(uniq, model.seen)[ids]).sum(axis=1) * letters
            seen = np.bincount(doc, weights=seen, minlength=m) / np.maximum(total, 1)
            inside = some & (seen >= MIN_SEEN * (share @ model.usual))
    out = {"lang_pred": pred, "score": score, "n_words": count, "n_switches": switches}
    return {**out, "in_learned": inside} if judge else out


def held_out(key: str):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_docs: int = SAMPLE_DOCS, max_langs: int = MAX_LANGS) -> Crf | None:
    """Train on a bounded sample of labelled rows that are not held out.

    Of each language about ``sample_docs`` rows, picked by a hash of the key, and
    ``SAMPLE_CHARS`` characters of each, are read by the driver; of more than
    ``max_langs`` languages the commonest (ties by name) are learned."""
    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("g")) \
             .where(F.col("g").isNotNull() & F.col("t").isNotNull()).where(~held_out("k"))
    counts = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "g").limit(max_langs).collect()}
    if not counts:
        return None
    million = 1_000_000
    limits = F.create_map(*[F.lit(v) for g, n in sorted(counts.items())
                            for v in (g, min(million, -(-million * 3 * sample_docs // (2 * n))))])
    place = F.pmod(F.xxhash64("k", F.lit(41)), F.lit(million))
    # Whole rows are filtered by hash before anything moves; the cut to the exact
    # number happens on the few that are left.
    picked = rows.withColumn("h", place).where(F.col("h") < F.try_element_at(limits, F.col("g"))) \
                 .select("h", "k", "g", F.substring("t", 1, SAMPLE_CHARS).alias("t")) \
                 .orderBy("h", "k").limit(2 * sample_docs * len(counts)).collect()
    taken: Counter = Counter()
    sample = []
    for r in picked:
        if taken[r["g"]] < sample_docs:
            taken[r["g"]] += 1
            sample.append((r["t"], r["g"]))
    return train(sample)


def annotate(df: DataFrame, model: Crf | None, text: str = "text", judge: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``df`` and the prediction for each text."""
    return with_results(df, text, lambda texts: predict(model, texts, judge), JUDGED if judge else FIELDS)


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             model: Crf | None = None) -> DataFrame:
    """One row per input row: ``key, held_out, lang_pred, score, n_words, n_switches``.

    ``held_out``: crc32 of the key as text is divisible by 5; such rows teach
    nothing. Without ``model`` one is fitted on the other labelled rows. The
    prediction sees the text alone. ``score`` is the expected share of the text's
    letters in ``lang_pred``; ``n_switches`` counts neighbouring words of
    different languages.

    A null text or one without a letter is ``und`` with score 0, as is every text if
    no row is labelled; every other text, however short or foreign, gets the best
    of the learned languages. Each row is judged alone: repeated rows each get a
    row, ties between languages go to the first by name, an empty table gives no
    rows, other columns are ignored. A null key counts as held out.
    """
    model = model or fit(df, key, text, lang)
    got, names = annotate(df.select(F.col(key).alias("__key"), F.col(text).alias("__text")), model, "__text")
    return got.select(F.col("__key").alias(key), held_out("__key").alias("held_out"),
                      *[F.col(names[c]).alias(c) for c in ("lang_pred", "score", "n_words", "n_switches")])


def keep_identified(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                    min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``df`` in learned languages, with at least ``min_score`` of their
    letters in one of them.

    A text is in none of them if its words' n-grams that were seen in training are
    under ``MIN_SEEN`` of the share that unseen text of these languages has. If no
    row is labelled there is nothing to learn and only texts without a letter go."""
    model = fit(df, key, text, lang)
    got, names = annotate(df, model, text, judge=True)
    good = F.col(names["n_words"]) > 0
    if model is not None:
        good = F.col(names["in_learned"]) & (F.col(names["score"]) >= min_score)
    return got.where(good).select(*got.columns[:len(df.columns)])
