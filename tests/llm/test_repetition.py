import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import repetition as R


def brute(t, min_repeat=R.MIN_REPEAT):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    n = len(w)
    best = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while i + k < n and j + k < n and w[i + k] == w[j + k]:
                    k += 1
                best[i] = max(best[i], k)
    grams = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    rep = {i + k for i in range(n - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    cov = {i + k for i in range(n) if best[i] >= min_repeat for k in range(best[i])}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = n < 50 or 100 * len(rep) > 50 * n
    longest = max(best, default=0)
    kept = not failed and len(cov) <= max(R.MAX_COVERED * n, R.FREE_COVERED) and longest <= R.MAX_LONGEST
    return (n, sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(rep), len(cov), longest, failed, kept)


def texts():
    r = np.random.default_rng(3)
    words = ["a", "bé", "the", "x#", "ou", " q", "z\x1cz", "<i>"]
    out = [None, "", "   \n\t", "one", "a " * 120, "the same line here\n" * 3]
    for _ in range(25):
        n = int(r.integers(1, 160))
        vocab = words if r.random() < 0.5 else [f"w{k}" for k in range(400)]
        out.append("".join(str(r.choice(vocab)) + str(r.choice([" ", "\n", "\t", "\x0b", "  "])) for _ in range(n)))
    long_ = " ".join(f"u{k}" for k in range(130))
    filler = " ".join(f"v{k}" for k in range(400))
    # a short text with a repeat of 12 words: over a fifth is covered, but under 30 words
    few = " ".join([f"s{k}" for k in range(12)] + [f"t{k}" for k in range(40)] + [f"s{k}" for k in range(12)])
    many = " ".join([f"s{k}" for k in range(16)] + [f"t{k}" for k in range(60)] + [f"s{k}" for k in range(16)])
    return [*out, few, many, long_ + " " + filler + " " + long_, filler]


def test_measure_matches_brute_force():
    ts = texts()
    got = R.measure(ts)
    rows = list(zip(*[got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                "covered_words", "longest_repeat", "base_failed", "kept")]))
    for t, g in zip(ts, rows):
        assert g == brute(t), t


def test_verdicts(spark):
    ts = texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ts)], "doc_id long, text string, kept string")
    out = {r["doc_id"]: r for r in R.quality_rules(df).collect()}
    assert not out[len(ts) - 2]["kept"] and out[len(ts) - 2]["longest_repeat"] == 130  # a long passage twice
    assert out[len(ts) - 1]["kept"]
    assert R.keep_good(df).columns == df.columns
    assert {r["doc_id"] for r in R.keep_good(df).collect()} == {k for k, r in out.items() if r["kept"]}
    assert R.quality_rules(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5])
def test_short_inputs(n):
    assert R.measure(["w"] * n)["n_words"].tolist() == [1] * n


def spaced(part, times, total):
    """A text of ``total`` words in which ``part`` stands ``times`` times, new words between."""
    new = iter(f"v{k}" for k in range(total))
    gap = (total - times * len(part)) // times
    return " ".join(w for _ in range(times) for w in [*part, *(next(new) for _ in range(gap))])


@pytest.mark.parametrize("size,times,total,covered,longest", [
    (90, 5, 1000, True, True),      # the paragraph of the finding
    (20, 15, 1000, True, False),    # only over the covered limit
    (60, 2, 1000, False, True),     # only over the longest limit
    (13, 2, 64, False, False),      # one line and its copy in a clean short text
])
def test_each_limit_rejects_alone(size, times, total, covered, longest):
    got = {c: v[0] for c, v in R.measure([spaced([f"u{k}" for k in range(size)], times, total)]).items()}
    assert not got["base_failed"] and got["covered_words"] == size * times and got["longest_repeat"] == size
    assert (got["covered_words"] > max(R.MAX_COVERED * got["n_words"], R.FREE_COVERED)) == covered
    assert (got["longest_repeat"] > R.MAX_LONGEST) == longest
    assert got["kept"] == (not covered and not longest)
