import re

import numpy as np

from quarry.llm import jaccard_join as J


def shingles(t):
    w = re.findall(r"\w+", (t or "").lower())
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    link = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                link[i].append(j)
                link[j].append(i)
    out, seen = {}, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for k in link[todo.pop()]:
                if k not in group:
                    group.add(k)
                    todo.append(k)
        seen |= group
        for k in group:
            out[k] = min(rows[x][0] for x in group)
    return [(rows[i][0], out[i], len(link[i]), len(sets[i])) for i in range(n)]


def make_rows():
    r = np.random.default_rng(11)
    vocab = [f"w{k}" for k in range(3000)]
    doc = lambda n: [str(x) for x in r.choice(vocab, n)]
    rows, key = [], 0
    line = doc(14)
    for _ in range(60):
        base = doc(int(r.integers(3, 120)))
        for _ in range(int(r.integers(1, 5))):
            w = list(base)
            for _ in range(int(r.integers(0, 4))):
                w[int(r.integers(0, len(w)))] = str(r.choice(vocab))
            rows.append((key, " ".join(w + (line if r.random() < 0.3 else []))))
            key += 1
    big = doc(150)
    for _ in range(330):  # a large group of near copies: more than a bucket and a block
        w = list(big)
        w[int(r.integers(0, len(w)))] = str(r.choice(vocab))
        rows.append((key, " ".join(w)))
        key += 1
    rows += [(key, None), (key + 1, ""), (key + 2, "?!"), (key + 3, "a"), (key + 4, "A."), (key + 5, rows[3][1].upper())]
    return rows


def test_matches_brute_force(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_shingles"])
                 for r in J.near_duplicate_report(df, bucket=32).collect())
    assert got == sorted(brute(rows))


def test_filter_keeps_one_of_each_class(spark):
    rows = [(1, "a b c d e f g", 5), (2, "a b c d e f g!", 5), (2, "a b c d e f g!", 5), (3, None, 1), (4, "", 1),
            (7, "x y z u v w q", 2), (7, "x y z u v w q", 2), (7, "other words in a text of its own", 9), (None, "n m", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, body int")
    out = J.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        [(1, "a b c d e f g", 5), (3, None, 1), (4, "", 1), (7, "x y z u v w q", 2),
         (7, "other words in a text of its own", 9), (None, "n m", 1)], key=str)
    assert J.near_duplicate_report(df.limit(0)).count() == 0


def test_runs_reach_recall():
    assert J.runs_for(0.8, 0.999, 1) < J.runs_for(0.8, 0.999, 4) < 12
