"""Exact top-k by inner product for every query vector.

The longest items (a fixed number) meet every query first. The others lie in the
leaves of a tree of halving cuts, and consecutive leaves form stripes. No inner
product of a query with an item of a stripe exceeds what the stripe's ball, its box
and its longest item allow, so a query that has k results at least as good need not
see the stripe. Every query first meets the stripe that promises most, then only
those that can still improve its k-th score; inside a stripe the same bounds hold for
blocks of items. What is left to compare is multiplied as matrices in single
precision; a pair that could matter by that result, its error added, is summed in
double precision, so scores and order are exact.

The cuts come from a bounded sample (``SAMPLE`` vectors of each leaf, ``LEAVES`` leaves
at most), the bounds from every item: a bad cut costs time, never a result. Where no
bound excludes anything (directions spread evenly over many dimensions) every query
still meets every item: a matrix product in bounded pieces over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import session
from quarry.functions.scalar import dot, to_double_array
from quarry.operators.ordered import global_index
from quarry.session import cut_lineage

BLOCK = 1024          # items whose bound is tested together
FIRST = 1024          # longest items that every query meets first (broadcast: a fixed number)
STRIPE = 32           # blocks a task holds
QUERIES = 32768       # queries of a tile
CHUNK = 512           # queries multiplied at a time
LEAVES = 8192         # leaves of the tree at most
SAMPLE = 8            # vectors of the sample for each leaf
ROOM = 1e-9           # a hair of room: the bounds are rounded
LAST = 2 ** 63 - 1    # stands for a null item id: last of equal scores
FIELDS = "copy long, query long, item long, score double"


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products summed in the order of the dimensions, so that a pair's score
    does not depend on the block it is computed in."""
    out = np.zeros((len(q), len(v)))
    for d in range(q.shape[1]):
        out += np.outer(q[:, d], v[:, d])
    return out


def _pair_scores(q: np.ndarray, v: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``_scores`` of the pairs (r, c) alone, summed in the same order."""
    out = np.zeros(len(r))
    for a in range(0, len(r), 65536):
        part = slice(a, a + 65536)
        x, y = q[r[part]], v[c[part]]
        for d in range(q.shape[1]):
            out[part] += x[:, d] * y[:, d]
    return out


def _length(v: np.ndarray) -> np.ndarray:
    """Euclidean lengths; squares of very large or small numbers do not overflow."""
    top = np.abs(v).max(axis=1, initial=0.0)
    unit = v / np.where(top > 0, top, 1.0)[:, None]
    return top * np.sqrt((unit * unit).sum(axis=1))


class Heaps:
    """The best k (score falling, id rising) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.item = np.full((n, k), np.iinfo(np.int64).max)

    def worst(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, items: np.ndarray) -> None:
        """One entry per (row, score, item), any number per row."""
        own = np.unique(rows)
        r = np.concatenate([np.repeat(own, self.k), rows])
        s = np.concatenate([self.score[own].ravel(), score])
        i = np.concatenate([self.item[own].ravel(), items])
        order = np.lexsort((i, -s, r))
        r = r[order]
        at = np.arange(len(r)) - np.searchsorted(r, r)
        top = at < self.k
        self.score[r[top], at[top]], self.item[r[top], at[top]] = s[order][top], i[order][top]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Results per row, then items and scores row after row."""
        keep = np.isfinite(self.score)
        return keep.sum(axis=1), self.item[keep], self.score[keep]


class Bounds:
    """What the ball, the box and the longest vector of each group of vectors allow."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, centre: np.ndarray, radius: np.ndarray, norm: np.ndarray):
        self.lo, self.hi, self.centre, self.radius, self.norm = lo, hi, centre, radius, norm

    @classmethod
    def of_blocks(cls, v: np.ndarray, block: int) -> Bounds:
        at = np.arange(0, len(v), block)
        size = np.diff(np.append(at, len(v)))
        centre = np.add.reduceat(v, at, axis=0) / size[:, None]
        return cls(np.minimum.reduceat(v, at, axis=0), np.maximum.reduceat(v, at, axis=0), centre,
                   np.maximum.reduceat(_length(v - np.repeat(centre, size, axis=0)), at), np.maximum.reduceat(_length(v), at))

    def upper(self, q: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(queries, groups): no inner product is larger."""
        with np.errstate(all="ignore"):
            far = np.outer(length, self.norm)
            out = np.minimum(far, q @ self.centre.T + np.outer(length, self.radius))
            out = np.minimum(out, np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T) + ROOM * far
            return np.where(np.isnan(out), np.inf, out)


def search(queries: np.ndarray, q: np.ndarray, items: np.ndarray, v: np.ndarray, k: int, known: np.ndarray | None = None,
           block: int = BLOCK, skip_self: bool = False, heaps: Heaps | None = None) -> tuple[Heaps, int]:
    """Best ``k`` of the items, and the (query, block) pairs skipped. Blocks are
    consecutive items. ``known``: k-th scores the queries already have elsewhere;
    ``heaps``: results they have already, joined by those found here."""
    heaps, skipped = heaps or Heaps(len(q), k), 0
    if not len(q) or not len(v):
        return heaps, skipped
    known = np.full(len(q), -np.inf) if known is None else known
    bounds, length = Bounds.of_blocks(v, block), _length(q)
    with np.errstate(all="ignore"):
        longest = bounds.norm.max()
        # unit vectors: single precision neither overflows nor loses small numbers that matter
        q1 = (q / np.where(length > 0, length, 1.0)[:, None]).astype(np.float32)
        v1 = (v / (longest if longest > 0 else 1.0)).astype(np.float32)
        scale = length * longest
    q1[~np.isfinite(scale)] = np.nan      # compared in double precision
    room = (q.shape[1] + 8) * 2.0 ** -22
    for a in range(0, len(q), CHUNK):
        rows = np.arange(a, min(a + CHUNK, len(q)))
        upper = bounds.upper(q[rows], length[rows])
        for b in np.argsort(-upper.max(axis=0), kind="stable"):
            floor = np.maximum(heaps.worst()[rows], known[rows])
            can = upper[:, b] >= floor
            skipped += int((~can).sum())
            own, floor = rows[can], floor[can]
            if not len(own):
                continue
            part = slice(b * block, (b + 1) * block)
            s = q1[own] @ v1[part].T
            with np.errstate(all="ignore"):
                least = np.where(scale[own] > 0, floor / scale[own], -np.inf) - room
            new = np.flatnonzero(np.isneginf(least))
            if len(new) and s.shape[1] > k:      # no k results yet: the block's own k-th is a floor
                t = s[new]
                if skip_self:
                    t[queries[own[new]][:, None] == items[part][None, :]] = -np.inf
                kth = np.partition(t, t.shape[1] - k, axis=1)[:, t.shape[1] - k]
                least[new] = np.where(np.isnan(kth), -np.inf, kth - 2 * room)
            r, c = np.nonzero(~(s < least.astype(np.float32)[:, None]))
            r, c = own[r], c + part.start
            if skip_self:
                other = queries[r] != items[c]
                r, c = r[other], c[other]
            exact = _pair_scores(q, v, r, c)
            good = np.isfinite(exact) & (exact >= np.maximum(heaps.worst(), known)[r])
            if good.any():
                heaps.add(r[good], exact[good], items[c[good]])
    return heaps, skipped


class Tree:
    """Halving cuts across the widest direction of a sample, level by level."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.depth = max(0, ceil(log2(max(leaves, 1))))
        d, inner = sample.shape[1], 2 ** self.depth - 1
        self.direction, self.cut = np.zeros((inner, d)), np.zeros(inner)
        groups = [np.arange(len(sample))]
        for node in range(inner):
            own = sample[groups[node]]
            if len(own) > 1:
                with np.errstate(all="ignore"):
                    spread = np.cov(own, rowvar=False).reshape(d, d)
                if np.isfinite(spread).all():
                    self.direction[node] = np.linalg.eigh(spread)[1][:, -1]
            along = own @ self.direction[node]
            self.cut[node] = np.median(along) if len(own) else 0.0
            right = along > self.cut[node]
            groups += [groups[node][~right], groups[node][right]]
        self.groups = groups[inner:]

    def leaf(self, v: np.ndarray) -> np.ndarray:
        node = np.zeros(len(v), dtype=np.int64)
        with np.errstate(all="ignore"):
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", v, self.direction[node]) > self.cut[node])
        return node - (2 ** self.depth - 1)


def _vectors(col: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) and not pc.all(pc.equal(pc.list_value_length(col), d)).as_py():
        raise ValueError(f"vectors of other lengths than {d}")
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), d)


def _ids(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(col, -LAST).to_numpy()


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def _first_of_equal(items: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Of equal vectors only the ``k + 1`` smallest ids (one may be the query's own),
    each ``k`` times at most, can be among the best ``k``."""
    same = np.unique(v, axis=0, return_inverse=True)[1].ravel()
    order = np.lexsort((items, same))
    s, i = same[order], items[order]
    new_vector = np.append(True, s[1:] != s[:-1])
    new_id = new_vector | np.append(True, i[1:] != i[:-1])
    ids = np.cumsum(new_id)
    nth = ids - ids[new_vector][np.cumsum(new_vector) - 1]
    again = np.arange(len(s)) - np.flatnonzero(new_id)[ids - 1]
    return np.sort(order[(nth <= k) & (again < k)])


def _pieces(sizes: dict[int, int], most: int) -> tuple[dict[int, tuple[int, int]], int]:
    """Consecutive keys share a part of at most ``most`` rows; a larger key has parts
    of its own: key to (first part, number of parts), and how many parts there are."""
    out, at, room = {}, -1, 0
    for key in sorted(sizes):
        n = sizes[key]
        if n > most:
            parts = -(-n // most)
            out[key], at, room = (at + 1, parts), at + parts, 0
            continue
        if n > room:
            at, room = at + 1, most
        out[key], room = (at, 1), room - n
    return out, at + 1


def _place(df: DataFrame, key: str, by: str, sizes: dict[int, int], most: int, name: str, shared: bool) -> DataFrame:
    """``df`` with its part: keys are few (leaves or stripes), so the table is broadcast."""
    if shared:
        parts = _pieces(sizes, most)[0]
    else:
        starts = np.append(0, np.cumsum([-(-sizes[x] // most) for x in sorted(sizes)]))
        parts = {x: (int(starts[i]), -(-sizes[x] // most)) for i, x in enumerate(sorted(sizes))}
    rows = [(int(x), int(a), int(n)) for x, (a, n) in parts.items()]
    table = df.sparkSession.createDataFrame(rows, f"{key} long, _first long, _parts long")
    return df.join(F.broadcast(table), key).withColumn(name, F.col("_first") + F.pmod(F.xxhash64(by), F.col("_parts"))).drop("_first", "_parts")


def _counts(df: DataFrame, key: str) -> dict[int, int]:
    return {r[key]: r["n"] for r in df.groupBy(key).agg(F.count("*").alias("n")).collect()}


def _stripe_bounds(striped: DataFrame, centre: np.ndarray) -> Bounds:
    """Bounds of every stripe over all its items: partial ones per partition, then per stripe."""
    d = centre.shape[1]
    fields = "stripe long, lo array<double>, hi array<double>, radius double, norm double"

    def table(keys, lo, hi, radius, norm) -> list:
        full = np.full(len(keys), d)
        return [pa.array(keys), _lists(full, lo.ravel()), _lists(full, hi.ravel()), pa.array(radius), pa.array(norm)]

    names = ["stripe", "lo", "hi", "radius", "norm"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key, v = b.column("stripe").to_numpy(), _vectors(b.column("v"), d)
            order = np.argsort(key, kind="stable")
            key, v = key[order], v[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            with np.errstate(all="ignore"):
                radius = np.maximum.reduceat(_length(v - centre[key]), at)
            yield pa.RecordBatch.from_arrays(table(key[at], np.minimum.reduceat(v, at, axis=0), np.maximum.reduceat(v, at, axis=0),
                                                   radius, np.maximum.reduceat(_length(v), at)), names=names)

    def merge(t: pa.Table) -> pa.Table:
        return pa.Table.from_arrays(table(t.column("stripe").to_numpy()[:1], _vectors(t.column("lo"), d).min(axis=0),
                                          _vectors(t.column("hi"), d).max(axis=0), t.column("radius").to_numpy().max(keepdims=True),
                                          t.column("norm").to_numpy().max(keepdims=True)), names=names)

    rows = striped.select("stripe", "v").mapInArrow(partial, fields).groupBy("stripe").applyInArrow(merge, fields) \
                  .orderBy("stripe").collect()      # one row per stripe
    at = [r["stripe"] for r in rows]
    lo, hi, radius, norm = np.zeros_like(centre), np.zeros_like(centre), np.zeros(len(centre)), np.full(len(centre), -np.inf)
    lo[at], hi[at] = np.array([r["lo"] for r in rows]), np.array([r["hi"] for r in rows])
    radius[at], norm[at] = [r["radius"] for r in rows], [r["norm"] for r in rows]
    return Bounds(lo, hi, centre, radius, norm)      # a stripe without items allows nothing


def top_inner(queries: DataFrame, items: DataFrame, k: int = 10, id_col: str = "id", vec: str = "features",
              skip_self: bool = False, block: int = BLOCK, first: int = FIRST, stripe: int = STRIPE,
              tile: int = QUERIES) -> DataFrame:
    """``(query, pos, item, score)``: the ``k`` items with the largest inner products
    with each query, ties by id, exact.

    Null vectors and those with a null or non-finite entry are left out on both
    sides; a zero query scores 0 everywhere and takes the smallest ids; ``skip_self``
    leaves an item out that has the query's own id, and null ids on both sides.
    Fewer than ``k`` items give fewer rows. All vectors must have one length.
    Repeated ids are rows of their own.
    """
    spark = queries.sparkSession
    slots = ceil(sqrt(8 * spark.sparkContext.defaultParallelism))

    def side(df: DataFrame, name: str, col: str) -> DataFrame:
        single = dict(df.dtypes)[vec] == "array<float>"      # half the bytes to send, the same numbers
        df = df.select(F.col(id_col).cast("long").alias(name), (F.col(vec) if single else to_double_array(vec)).alias(col))
        whole = F.forall(col, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))      # NaN is above all
        return df.where(F.col(col).isNotNull() & whole & (F.col(name).isNotNull() if skip_self else F.lit(True)))

    q = side(queries, "query", "q")
    v = side(items, "item", "v").withColumn("item", F.coalesce("item", F.lit(LAST))).withColumn("norm", F.sqrt(dot("v", "v")))
    # places by falling norm: a distributed sort, not one task
    v = cut_lineage(global_index(v, [F.desc("norm"), F.asc("item")], "place"))
    vectors = q.schema["q"].dataType.simpleString()
    q = cut_lineage(q.withColumn("copy", F.monotonically_increasing_id()))
    head = v.where(F.col("place") < first).orderBy("place").select("item", "v").collect()     # `first` rows
    if not head:
        return spark.createDataFrame([], "query long, pos long, item long, score double")
    long_ids, long_v = np.array([r["item"] for r in head], dtype=np.int64), np.array([r["v"] for r in head], dtype=np.float64)
    d = long_v.shape[1]
    # what a zero query takes: k + 1 ids (one may be its own), each k times at most
    small = []
    if not q.where(F.forall("q", lambda x: x == 0)).isEmpty():
        small = v.groupBy("item").agg(F.least(F.count("*"), F.lit(k)).alias("n")).orderBy("item").limit(k + 1).collect()
    small_ids = np.array([r["item"] for r in small for _ in range(r["n"])], dtype=np.int64)

    rest = v.where(F.col("place") >= first).select("place", "item", "v")
    n_items = rest.count()
    bounds, striped = None, None
    if n_items:
        leaves = min(LEAVES, max(1, n_items // max(1, block // 2)))
        step = max(1, n_items // (leaves * SAMPLE))
        sample = np.array([r["v"] for r in rest.where((F.col("place") - first) % step == 0).select("place", "v").orderBy("place").collect()],
                          dtype=np.float64)      # LEAVES * SAMPLE vectors at most, twice that by rounding
        tree = Tree(sample, leaves)
        means = [sample[g].mean(axis=0) if len(g) else None for g in tree.groups]
        tree.groups = []
        shipped_tree = spark.sparkContext.broadcast(tree)

        def with_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.append_column("leaf", pa.array(shipped_tree.value.leaf(_vectors(b.column("v"), d))))

        leafed = cut_lineage(rest.mapInArrow(with_leaf, f"place long, item long, v {rest.schema["v"].dataType.simpleString()}, leaf long"))
        sizes, most_items = _counts(leafed, "leaf"), min(block * stripe, max(block, ceil(n_items / slots)))
        striped = cut_lineage(_place(leafed, "leaf", "place", sizes, most_items, "stripe", True))
        parts, n_stripes = _pieces(sizes, most_items)
        members = [[] for _ in range(n_stripes)]
        for leaf, (a, n) in parts.items():
            for x in range(a, a + n):
                members[x].append(leaf)
        centre = np.array([np.mean([means[x] for x in own if means[x] is not None] or [np.zeros(d)], axis=0) for own in members])
        bounds = _stripe_bounds(striped, centre)
    shipped = spark.sparkContext.broadcast((long_ids, long_v, small_ids, bounds))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, long, small, bounds = shipped.value
        for b in batches:
            if not b.num_rows:
                continue
            own, x = _ids(b.column("query")), _vectors(b.column("q"), d)
            zero = ~x.any(axis=1)
            heaps = Heaps(len(x), k)
            at = np.flatnonzero(~zero)
            found, _ = search(own[at], x[at], ids, long, k, None, block, skip_self)
            heaps.score[at], heaps.item[at] = found.score, found.item
            for r in np.flatnonzero(zero):
                mine = (small[small != own[r]] if skip_self else small)[:k]
                heaps.score[r, :len(mine)], heaps.item[r, :len(mine)] = 0.0, mine
            best = np.full(len(x), -1)
            if bounds is not None:
                upper = bounds.upper(x, _length(x))
                best = upper.argmax(axis=1)
                best[zero | (upper.max(axis=1) < heaps.worst())] = -1
            n, i, s = heaps.found()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(heaps.worst()), _lists(n, i), _lists(n, s), pa.array(best)],
                                             names=[*b.schema.names, "floor", "items", "scores", "best"])

    have = f"query long, q {vectors}, copy long, floor double, items array<long>, scores array<double>, best long"
    met = cut_lineage(q.mapInArrow(meet, have))
    flat = lambda df: df.select("copy", "query", F.explode(F.arrays_zip("items", "scores")).alias("e")) \
                        .select("copy", "query", F.col("e.items").alias("item"), F.col("e.scores").alias("score"))
    found = flat(met)
    if n_items:
        left = met.where("best >= 0")
        sizes = _counts(left, "best")
        most = min(tile, max(block, ceil(sum(sizes.values()) / slots)))
        left = _place(left, "best", "copy", sizes, most, "tile", False)

        def sent(wanted: DataFrame) -> DataFrame:
            """Items go to the tiles that need their stripe: a few numbers per pair of both."""
            wanted = wanted.select(F.col("tile").alias("to"), F.col("stripe").alias("at")).distinct()
            return striped.join(F.broadcast(wanted), F.col("stripe") == F.col("at")).select("to", "at", "leaf", "place", "item", "v")

        def compare(a: pa.Table, b: pa.Table, heaps: Heaps | None) -> Heaps:
            b = b.sort_by([("leaf", "ascending"), ("place", "ascending")])
            ids, x = _ids(b.column("item")), _vectors(b.column("v"), d)
            keep = _first_of_equal(ids, x, k) if len(x) else np.zeros(0, dtype=np.int64)
            return search(_ids(a.column("query")), _vectors(a.column("q"), d), ids[keep], x[keep], k, a.column("floor").to_numpy(),
                          block, skip_self, heaps)[0]

        def near(a: pa.Table, b: pa.Table) -> pa.Table:
            heaps = Heaps(a.num_rows, k)
            n = pc.list_value_length(a.column("items")).to_numpy()
            r, at = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            heaps.item[r, at] = a.column("items").combine_chunks().flatten().to_numpy()
            heaps.score[r, at] = a.column("scores").combine_chunks().flatten().to_numpy()
            heaps = compare(a, b, heaps)
            n, i, s = heaps.found()
            for name, col in (("floor", pa.array(heaps.worst())), ("items", _lists(n, i)), ("scores", _lists(n, s))):
                a = a.set_column(a.schema.get_field_index(name), name, col)
            return a

        def far(a: pa.Table, b: pa.Table) -> pa.Table:
            n, i, s = compare(a, b, None).found()
            again = np.repeat(np.arange(len(n)), n)
            return pa.Table.from_arrays([a.column("copy").take(again), a.column("query").take(again), pa.array(i), pa.array(s)],
                                        names=["copy", "query", "item", "score"])

        order = ["query", "q", "copy", "floor", "items", "scores", "best", "tile"]
        better = cut_lineage(left.select(*order).groupBy("tile", "best").cogroup(
            sent(left.select("tile", F.col("best").alias("stripe"))).groupBy("to", "at")).applyInArrow(near, have + ", tile long"))
        found = flat(met.where("best < 0")).unionByName(flat(better))

        def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bounds = shipped.value[3]
            for b in batches:
                x = _vectors(b.column("q"), d)
                can = bounds.upper(x, _length(x)) >= b.column("floor").to_numpy()[:, None]
                can[np.arange(len(x)), b.column("best").to_numpy()] = False
                r, c = np.nonzero(can)
                yield pa.RecordBatch.from_arrays([*b.columns, _lists(can.sum(axis=1), c)], names=[*b.schema.names, "stripes"])

        fields = f"copy long, query long, q {vectors}, floor double, best long, tile long"
        needed = cut_lineage(better.select("copy", "query", "q", "floor", "best", "tile")
                             .mapInArrow(needs, fields + ", stripes array<long>").where(F.size("stripes") > 0))

        def rest_of(own: DataFrame) -> DataFrame:
            spread = own.select("copy", "query", "q", "floor", "tile", F.explode("stripes").alias("stripe"))
            pairs = own.select("tile", F.explode("stripes").alias("stripe"))
            return spread.groupBy("tile", "stripe").cogroup(sent(pairs).groupBy("to", "at")).applyInArrow(far, FIELDS)

        # both sides are sent once per pair of tile and stripe: some tiles after the other where that is much
        met_by = needed.select("tile", F.explode("stripes").alias("stripe")).groupBy("tile", "stripe").agg(F.count("*").alias("n"))
        rows = met_by.agg(F.sum(F.col("n") + F.lit(most_items))).first()[0] or 0
        passes = min(session.STRIPES, max(1, -(-rows * (64 + 8 * d) // session.STRIPE_BYTES)))
        for i in range(passes):
            more = rest_of(needed.where(F.pmod("tile", F.lit(passes)) == i) if passes > 1 else needed)
            found = found.unionByName(session.stored(more, "compared") if passes > 1 else more)
    # a query has at most k results per stripe it went to
    ranked = found.groupBy("copy", "query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "item"))), 1, k).alias("best"))
    return ranked.select("query", F.posexplode("best").alias("at", "b")).select(
        "query", (F.col("at") + 1).cast("long").alias("pos"), F.nullif(F.col("b.item"), F.lit(LAST)).alias("item"),
        (-F.col("b.minus")).alias("score"))
