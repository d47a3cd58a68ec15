"""N-gram Jaccard self-join by chosen paths.

Sets of word 5-shingles are embedded as signatures (one minimum hash per
coordinate), so two sets agree in a coordinate with probability equal to their
Jaccard similarity. A run splits all records recursively: a bucket picks one or
two coordinates (1 / similarity of them on average), and each record goes to the
child bucket of its value there. Buckets small enough are compared by brute force;
larger ones are split again. A similar pair survives a split with a probability
that makes the number of runs for the wanted recall computable; runs are repeated
that often.

Equal sets are one record. In a small bucket, records with similar signatures
join a candidate cluster; a bucket that is still large after the last split (a
large group of near copies) joins one as a whole, by a star of links. Inside a
cluster all pairs are compared exactly, cut into blocks, so neither a bucket nor
a cluster is ever one task, and only counts and a spanning forest leave a block,
never its pairs.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import (complete_groups, components, counted_broadcast, free_name, map_pandas, regroup,
                               spanning_edges, text_batches, written)

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
COORDS = 128            # signature length
MAX_DEPTH = 4           # splits
BUCKET = 64             # records of a bucket that is compared at once
BLOCK = 256             # records of a block of a large cluster
SLACK = 4.0             # standard deviations a signature may lie below the similarity

U = np.uint64
WORD = re.compile(r"\w+")


def runs_for(similarity: float, recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold was in a common bucket at full
    depth in at least one of them with the wanted probability."""
    two = max(0.0, 1.0 / similarity - 1.0)  # share of buckets that pick two coordinates
    q = 1.0
    for _ in range(depth):
        one = similarity * q
        q = (1 - two) * one + two * (1 - (1 - one) ** 2)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - q)))


def shingle_sets(texts: list, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, one text
    after the other, and how many each has. Words are lower-cased runs of letters,
    digits and underscores; a text with fewer words than a shingle is one shingle;
    without a word it has none."""
    words: list[str] = []
    count = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        if t:
            w = WORD.findall(t.lower())
            words += w
            count[i] = len(w)
    if not words:
        return np.zeros(0, dtype=U), count * 0
    ids, uniq = pd.factorize(np.array([*words, None], dtype=object)[:-1])
    code = np.fromiter((xxhash.xxh64_intdigest(w) for w in uniq), dtype=U, count=len(uniq))[ids]
    n = np.maximum(count - shingle + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(texts)), n)
    first = np.cumsum(count) - count
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    span = np.minimum(count, shingle)[doc]
    h = np.zeros(len(doc), dtype=U)
    for k in range(shingle):
        use = span > k
        x = code[np.minimum(at + k, len(code) - 1)]
        h = np.where(use, (h ^ x) * U(0x9E3779B97F4A7C15) ^ (h >> U(29)), h)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    o = np.lexsort((h, doc))
    h, doc = h[o], doc[o]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.bincount(doc[keep], minlength=len(texts)).astype(np.int64)


def _coefficients(coords: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(97)
    return (r.integers(1, 2**63, coords, dtype=np.int64).astype(U) * U(2) + U(1),
            r.integers(1, 2**63, coords, dtype=np.int64).astype(U))


def signatures(hashes: np.ndarray, sizes: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Minimum hashes (32 bits) of each non-empty set, a row per set."""
    mul, add = _coefficients(coords)
    sizes = sizes[sizes > 0]
    out = np.empty((len(sizes), coords), dtype=np.uint32)
    if not len(sizes):
        return out
    start = np.cumsum(sizes) - sizes
    for j in range(coords):
        x = hashes * mul[j] + add[j]
        x ^= x >> U(31)
        x *= U(0xBF58476D1CE4E5B9)
        out[:, j] = np.minimum.reduceat((x >> U(32)).astype(np.uint32), start)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _children(path: np.ndarray, sig: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Child buckets of records in buckets ``path``: (row, child path).

    The bucket alone decides how many coordinates are picked and which, so all
    its records are split alike."""
    n, coords = sig.shape
    two = max(0.0, 1.0 / similarity - 1.0)
    a = _mix(path ^ U(0xA5A5A5A5))
    pick = [(a % U(coords)).astype(np.int64)]
    b = _mix(a + U(0x9E3779B97F4A7C15))
    pick.append(((pick[0] + 1 + (b % U(coords - 1)).astype(np.int64)) % coords))
    more = (_mix(b + U(0x632BE59BD9B4E019)) >> U(11)).astype(np.float64) / 2.0**53 < two
    rows, kids = [], []
    for k, which in ((0, np.arange(n)), (1, np.flatnonzero(more))):
        c = pick[k][which]
        value = sig[which, c].astype(U) | (c.astype(U) << U(32))
        rows.append(which)
        kids.append(_mix(_mix(path[which] + U(k + 1)) ^ value))
    return np.concatenate(rows), np.concatenate(kids)


def _digest_map(text: str, key: str, shingle: int):
    """Set digest, size and signature of each text."""
    def run(batches):
        for pdf in regroup(batches, text):
            h, n = shingle_sets(pdf[text].tolist(), shingle)
            sig = signatures(h, n)
            row = np.cumsum(n > 0) - 1
            cut = np.cumsum(n)
            some = (n > 0).tolist()
            yield pd.DataFrame({
                "doc": pdf[key],
                "body": [hashlib.md5((t or "").encode()).hexdigest() for t in pdf[text]],
                "digest": [hashlib.md5(h[cut[i] - n[i]:cut[i]].tobytes()).digest() if some[i] else None
                           for i in range(len(n))],
                "size": n,
                "sig": [sig[row[i]].tobytes() if some[i] else None for i in range(len(n))]})
    return run


def _sig_matrix(col, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype=kind).reshape(len(col), -1)


def _short(batches):
    """One byte of each coordinate is enough to compare signatures."""
    for pdf in batches:
        if len(pdf):
            sig = np.ascontiguousarray(_sig_matrix(pdf["sig"]).view(np.uint8).reshape(len(pdf), -1, 4)[:, :, 0])
            yield pd.DataFrame({"node": pdf["node"], "sig": [x.tobytes() for x in sig]})


def _first_level(runs: int, similarity: float):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            sig = _sig_matrix(pdf["sig"])
            node = pdf["node"].to_numpy()
            for r in range(runs):
                root = np.full(len(pdf), _mix(np.array([r + 1], dtype=U))[0], dtype=U)
                rows, kids = _children(root, sig, similarity)
                yield pd.DataFrame({"path": kids.view(np.int64), "node": node[rows]})
    return run


def _next_level(similarity: float):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            rows, kids = _children(pdf["path"].to_numpy().view(U), _sig_matrix(pdf["sig"]), similarity)
            yield pd.DataFrame({"path": kids.view(np.int64), "node": pdf["node"].to_numpy()[rows]})
    return run


def _compare_buckets(least: float):
    """Spanning edges between the records of each bucket whose signatures agree
    in at least ``least`` of the coordinates."""
    def run(batches):
        for pdf in complete_groups(batches, ["path"]):
            sig = _sig_matrix(pdf["sig"], np.uint8)
            need = math.ceil(least * sig.shape[1])
            node, path = pdf["node"].to_numpy(), pdf["path"].to_numpy()
            left, right = [], []
            start = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
            size = np.diff(np.append(start, len(path)))
            # Buckets of one size are compared together, shifted against themselves.
            for m in np.unique(size[size > 1]).tolist():
                for lo in range(0, int((size == m).sum()), max(1, 20000 // m)):
                    at = start[size == m][lo:lo + max(1, 20000 // m)]
                    rows = at[:, None] + np.arange(m)[None, :]
                    for k in range(1, m):
                        x, y = rows[:, :-k].ravel(), rows[:, k:].ravel()
                        near = (sig[x] == sig[y]).sum(axis=1) >= need
                        left.append(x[near])
                        right.append(y[near])
            if left:
                edges = spanning_edges(len(node), np.concatenate(left), np.concatenate(right))
                e = np.array(edges, dtype=np.int64).reshape(-1, 2)
                yield pd.DataFrame({"a": node[e[:, 0]], "b": node[e[:, 1]]})
    return run


def _blocked(df: DataFrame, key: str, count: str, node: str, block: int) -> DataFrame:
    """Give each record of a group of ``count`` records the pairs of blocks it
    takes part in, as columns ``i <= j``: one block if the group is no larger."""
    n = F.ceil(F.col(count) / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64(F.col(node), F.col(key)), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1),
                        lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j")))
    return df.withColumn("__p", F.explode(pairs)).select("*", "__p.i", "__p.j").drop("__p")


def intersections(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Matrix of the intersection sizes of the given sets."""
    m = len(sizes)
    uniq, code = np.unique(hashes, return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    often = np.bincount(code, minlength=len(uniq)) > 1  # others are in no intersection
    keep = often[code]
    slot = np.cumsum(often) - 1
    code, owner = slot[code[keep]], owner[keep]
    width, out = int(often.sum()), np.zeros((m, m), dtype=np.float32)
    o = np.argsort(code, kind="stable")
    code, owner = code[o], owner[o]
    for lo in range(0, width, 8192):
        x, y = np.searchsorted(code, [lo, lo + 8192])
        part = np.zeros((m, min(8192, width - lo)), dtype=np.float32)
        part[owner[x:y], code[x:y] - lo] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _verify(text: str, shingle: int, similarity: float, block: int):
    """Exact similarities inside clusters: rows (a, b, weight) with b null for the
    weight of the documents linked to a, and spanning edges with weight 0."""
    def run(batches):
        for pdf in complete_groups(batches, ["cluster", "i", "j"]):
            g = pdf.groupby(["cluster", "i", "j"], sort=False).ngroup().to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])
            a_out, b_out, w_out = [], [], []
            for x, y in zip(cuts[:-1], cuts[1:]):
                part = pdf.iloc[x:y]
                part = part[~part["node"].duplicated().to_numpy()]  # a repeated row brings its text twice
                if len(part) < 2:
                    continue
                h, sizes = shingle_sets(part[text].tolist(), shingle)
                same = intersections(h, sizes)
                union = sizes[:, None] + sizes[None, :] - same
                link = same >= similarity * union - 1e-9
                np.fill_diagonal(link, False)
                i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
                if i != j:  # pairs within one block are compared where it meets itself
                    side = part["mine"].to_numpy()
                    link &= side[:, None] != side[None, :]
                node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
                weight = link @ copies
                some = np.flatnonzero(weight)
                a_out += node[some].tolist()
                b_out += [-1] * len(some)
                w_out += weight[some].tolist()
                u, v = np.nonzero(np.triu(link))
                for p, q in spanning_edges(len(node), u, v):
                    a_out.append(int(node[p]))
                    b_out.append(int(node[q]))
                    w_out.append(0)
            yield pd.DataFrame({"a": np.array(a_out, dtype=np.int64), "b": np.array(b_out, dtype=np.int64),
                                "weight": np.array(w_out, dtype=np.int64)})
    return run


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    recall: float = RECALL, shingle: int = SHINGLE, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``key, class_id, n_links, n_shingles, kept``.

    Two rows are linked if the Jaccard similarity of their sets of word
    ``shingle``-grams is at least ``similarity`` (checked exactly; a pair at the
    threshold is found with probability ``recall`` or more). ``n_links`` counts
    the linked other rows, ``class_id`` is the smallest key reachable by links,
    ``kept`` marks one row of each class: that of the smallest key and, among
    rows of one key, of the smallest text digest (column ``body``).

    A row without a word (null or empty text too) is linked with nothing and is
    its own class; repeated rows are copies of each other; a null key sorts
    first; an empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    text_batches(spark)
    src = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    sets = written(map_pandas(src, _digest_map("text", "doc", shingle),
                              "doc long, body string, digest binary, size long, sig binary"), "jj-sets")
    some = sets.where("digest is not null")
    nodes = written(some.groupBy("digest").agg(F.min(F.struct("doc", "body")).alias("first"),
                                               F.count(F.lit(1)).alias("copies"),
                                               F.first("sig").alias("sig"), F.first("size").alias("size"))
                    .withColumn("node", F.monotonically_increasing_id()), "jj-nodes")
    sigs = nodes.select("node", "sig")
    runs = runs_for(similarity, recall, MAX_DEPTH)
    spread = math.sqrt(similarity * (1 - similarity) / COORDS)
    least = max(0.0, similarity - SLACK * spread)

    # Chosen paths: split until buckets are small.
    level = written(sigs.mapInPandas(_first_level(runs, similarity), "path long, node long"), "jj-level")
    leaves, stars = [], None
    for depth in range(1, MAX_DEPTH + 1):
        # (written before the join, so that a hot path's rows can be dealt to several tasks)
        counts = written(level.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).where("n > 1"), "jj-counts")
        sized = written(level.join(counted_broadcast(counts, 24), "path"), "jj-sized")
        leaves.append(sized.where(F.col("n") <= bucket).select("path", "node"))
        large = sized.where(F.col("n") > bucket)
        if depth == MAX_DEPTH:
            stars = large.select(F.col("least").alias("a"), F.col("node").alias("b"))
        elif large.isEmpty():
            break
        else:
            level = written(large.select("path", "node").join(sigs, "node")
                            .mapInPandas(_next_level(similarity), "path long, node long"), "jj-level")
    leaf = leaves[0]
    for more in leaves[1:]:
        leaf = leaf.unionByName(more)
    pairs = leaf.join(sigs.mapInPandas(_short, "node long, sig binary"), "node") \
        .repartition("path").sortWithinPartitions("path", "node").select("path", "node", "sig")
    near = pairs.mapInPandas(_compare_buckets(least), "a long, b long")
    clusters = components(near if stars is None else near.unionByName(stars), "jj-near") \
        .withColumnRenamed("label", "cluster")

    # Exact comparison inside the clusters, in blocks.
    size = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    inside = written(clusters.join(size, "cluster").join(nodes.select("node", "first", "copies"), "node")
                     .select("cluster", "n", "node", "copies", "first.doc", "first.body"), "jj-inside")
    wanted = counted_broadcast(inside, 120).select(F.col("doc").alias("wdoc"), F.col("body").alias("wbody"),
                                                   "cluster", "n", "node", "copies")
    members = src.withColumn("body", F.md5(F.coalesce("text", F.lit("")).cast("binary"))) \
        .join(wanted, F.col("doc").eqNullSafe(F.col("wdoc")) & (F.col("body") == F.col("wbody"))) \
        .select("cluster", "n", "node", "copies", "text") \
        .withColumn("mine", F.pmod(F.xxhash64("node", "cluster"), F.ceil(F.col("n") / F.lit(block)).cast("int")).cast("int"))
    cells = _blocked(members, "cluster", "n", "node", block) \
        .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node") \
        .select("cluster", "i", "j", "node", "mine", "copies", "text")
    checked = written(cells.mapInPandas(_verify("text", shingle, similarity, block), "a long, b long, weight long"), "jj-links")
    links = checked.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("near"))
    groups = components(checked.where("b >= 0").select("a", "b"), "jj-links")

    named = nodes.select("digest", "node", "first", "copies") \
        .join(groups, "node", "left").join(links, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("first").alias("least"))
    verdict = named.join(smallest, "label").select(
        "digest", "least", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = F.struct("doc", "body")
    full = sets.drop("sig").join(verdict, "digest", "left") \
        .withColumn("least", F.coalesce("least", own)).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    again = Window.partitionBy("doc", "body").orderBy("size")
    return full.select(
        F.col("doc").alias(key), F.col("least.doc").alias("class_id"), F.col("n_links").cast("long").alias("n_links"),
        F.col("size").cast("long").alias("n_shingles"),
        (F.col("least.doc").eqNullSafe(F.col("doc")) & (F.col("least.body") == F.col("body"))
         & ((F.row_number().over(again) == 1) | F.col("digest").isNull())).alias("kept"),
        "body")


def near_duplicate_report(df: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """``near_duplicates`` without the text digest."""
    return near_duplicates(df, key, text, **more).drop("body")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each class of near duplicates (the ``kept`` one).

    Rows that are no such row are anti-joined by key and text digest; of rows
    repeated with key and text, one stays. Rows without a word all stay."""
    found = written(near_duplicates(df, key, text), "jj-found")
    names = [free_name(df.columns, c) for c in ("__k", "__b")]
    gone = written(found.where(~F.col("kept")).select(F.col(key).alias("gk"), F.col("body").alias("gb")).distinct(), "jj-gone")
    stay = found.where("kept").select(F.col(key).alias("sk"), F.col("body").alias("sb"))
    both = gone.join(stay, F.col("gk").eqNullSafe(F.col("sk")) & (F.col("gb") == F.col("sb")), "left_semi").distinct()
    both = written(both, "jj-both")
    tagged = df.withColumn(names[0], F.col(key).cast("long")) \
        .withColumn(names[1], F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    match = lambda side: F.col(names[0]).eqNullSafe(F.col("gk")) & (F.col(names[1]) == F.col("gb"))
    rest = tagged.join(counted_broadcast(gone, 80), match(gone), "left_anti")
    repeated = tagged.join(counted_broadcast(both, 80), match(both), "left_semi").dropDuplicates(names)
    return rest.unionByName(repeated).drop(*names)
