"""Quality rules on repetition, by suffix arrays over the words of each text.

Adjacent suffixes of a text share their longest common prefix; the intervals of
these values are the maximal repeated substrings. The union of their spans and
the longest of them are limited.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import with_results

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MIN_REPEAT = 10          # words of a repeat that counts as covered
MAX_COVERED = 0.20       # of the words; the base rule ends every text over 0.50, so the limit lies well below
FREE_COVERED = 30        # words that may be covered in any text: one line and its copy
MAX_LONGEST = 50         # words of the longest repeat
WINDOW = 3

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, base_failed boolean, kept boolean")


def suffix_order(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of many texts at once, by prefix doubling.

    ``ids`` are the words of all texts one after the other, ``doc`` the text of
    each. Suffixes of different texts never share a group, so nothing is compared
    across texts. Only groups that are still equal are sorted again. Returns the
    order and, for each prefix length h = 1, 2, 4, ..., ranks that are equal
    exactly where the first h words are.
    """
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max()) + 1 if n else 1) + ids
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.empty(n, dtype=bool)
    new[:1] = True
    new[1:] = ordered[1:] != ordered[:-1]
    start = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    levels = [(1, rank.astype(np.int32) if n < 2**31 else rank.copy())]
    open_slot = np.flatnonzero(np.repeat(np.diff(np.append(start, n)) > 1, np.diff(np.append(start, n))))
    h = 1
    while len(open_slot):
        pos = order[open_slot]
        ahead = np.minimum(pos + h, n - 1)
        inside = (pos + h < n) & (doc[ahead] == doc[pos])
        second = np.where(inside, rank[ahead], -1)
        first = rank[pos]
        o = np.lexsort((second, first))
        pos, first, second = pos[o], first[o], second[o]
        order[open_slot] = pos
        new = np.empty(len(pos), dtype=bool)
        new[0] = True
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(pos)))
        rank[pos] = np.repeat(open_slot[start], length)
        open_slot = open_slot[np.repeat(length > 1, length)]
        h *= 2
        levels.append((h, rank.astype(np.int32) if n < 2**31 else rank.copy()))
    return order, levels


def longest_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest word sequence that starts
    there and also starts elsewhere in the same text."""
    n = len(ids)
    best = np.zeros(n, dtype=np.int64)
    if n < 2:
        return best
    order, levels = suffix_order(ids, doc)
    a, b = order[:-1], order[1:]
    first = levels[0][1]
    near = np.flatnonzero(first[a] == first[b])
    a, b = a[near], b[near]
    lcp = np.zeros(len(near), dtype=np.int64)
    for h, rank in reversed(levels):
        i, j = a + lcp, b + lcp
        ok = (i < n) & (j < n)
        ok[ok] = rank[i[ok]] == rank[j[ok]]
        lcp[ok] += h
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step)[:n] > 0


def measure(texts: list, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
            max_longest: int = MAX_LONGEST) -> dict[str, np.ndarray]:
    """All figures of a batch of texts (see ``quality_rules``)."""
    m = len(texts)
    words: list = []
    count = np.zeros(m, dtype=np.int64)
    chars, symbols, dup = (np.zeros(m, dtype=np.int64) for _ in range(3))
    for k, t in enumerate(texts):
        if not t:
            continue
        # bytes.split() splits at exactly the blanks 0x20 and 0x09-0x0D
        w = t.encode("utf-8").split()
        words += w
        count[k] = len(w)
        chars[k] = len(t) - sum(map(t.count, " \t\n\x0b\x0c\r"))
        symbols[k] = sum(map(t.count, SYMBOLS))
        if "\n" in t:
            lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
            dup[k] = len(lines) - len(set(lines))
    n = len(words)
    doc = np.repeat(np.arange(m), count)
    ids = pd.factorize(np.array([*words, None], dtype=object)[:-1])[0].astype(np.int64)
    best = longest_repeats(ids, doc)
    per = lambda mask: np.bincount(doc[mask], minlength=m).astype(np.int64)
    short = np.flatnonzero(best >= WINDOW)
    repeat = per(_covered(short, np.full(len(short), WINDOW), n))
    far = np.flatnonzero(best >= min_repeat)
    covered = per(_covered(far, best[far], n))
    longest = np.zeros(m, dtype=np.int64)
    np.maximum.at(longest, doc, best)
    failed = (count < MIN_WORDS) | (100 * repeat > 50 * count)
    kept = ~failed & (covered <= np.maximum(max_covered * count, FREE_COVERED)) & (longest <= max_longest)
    return {"n_words": count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
            "n_repeat_words": repeat, "covered_words": covered, "longest_repeat": longest,
            "base_failed": failed, "kept": kept}


def annotate(df: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
             max_longest: int = MAX_LONGEST) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``df`` and the figures of each text."""
    return with_results(df, text, lambda texts: measure(texts, min_repeat, max_covered, max_longest), FIELDS)


def quality_rules(df: DataFrame, key: str = "doc_id", text: str = "text", min_repeat: int = MIN_REPEAT,
                  max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per input row with its figures and verdict.

    Words are maximal runs of other characters than blank, tab, line feed,
    vertical tab, form feed and carriage return. ``n_words``; ``word_chars``
    (code points in words); ``n_symbols`` (``# * $ % & | < >``); ``n_dup_lines``
    (lines with a word, equal to an earlier line); ``n_repeat_words`` (words in
    3-word windows that occur twice or more, the first included);
    ``covered_words`` (words inside a repeated sequence of ``min_repeat`` words or
    more); ``longest_repeat`` (words). ``base_failed``: under 50 words, or over
    half of them in repeated windows. ``kept``: not failed, at most
    ``max_covered`` of the words covered (or ``FREE_COVERED`` words, so that one
    line and its copy end no short text) and no repeat over ``max_longest`` words.

    Each row is judged on its own text, so copies, ties and hot sources move
    nothing between tasks. A null or empty text has no words and fails; repeated
    rows each get a row; an empty table gives none; other columns are ignored.
    """
    got, names = annotate(df.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text",
                          min_repeat, max_covered, max_longest)
    return got.select(F.col("__key").alias(key), *[F.col(names[c]).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat")])


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text passes the rules, all columns as they were."""
    got, names = annotate(df, text)
    return got.where(F.col(names["kept"])).select(*got.columns[:len(df.columns)])
