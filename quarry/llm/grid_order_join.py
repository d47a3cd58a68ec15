"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t are at most epsilon = sqrt(2 - 2t) apart. Vectors
are rotated to their principal axes (distances stay), put into cells of side
epsilon on the leading axes and sorted by cell. The sequence is joined with itself
recursively: two intervals whose bounding boxes are further apart than epsilon
are skipped, others are split, down to small blocks that are compared in full.

Intervals of blocks are Spark rows and each level of the recursion is one join;
the last levels run inside a task, which gets a tile: the near pairs between two
rows of neighbouring blocks, each block once. Equal vectors are one record, and
only link counts and a spanning forest leave a pair of blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import components, spanning_edges, written
from quarry.session import sized_broadcast

THRESHOLD = 0.9
CELL_AXES = 3      # axes of the grid order
BOX_AXES = 8       # axes of a bounding box
BLOCK = 2048       # vectors of a block
LEAF = 256         # vectors compared at once inside a task
TILE = 8           # neighbouring blocks on each side of a tile
CLOSE = 1e-12      # cosines so near the threshold are summed exactly
FAN_OUT = 8        # children of an interval
TOLERANCE = 1e-9   # boxes are widened by this against rounding


def _unit(raw, dim: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(-1, dim)
    return x, x / np.sqrt((x * x).sum(axis=1))[:, None]


def _moments(dim: int):
    """Sums of the unit vectors and of their products, one row per partition."""
    def run(batches):
        s, p, n = np.zeros(dim), np.zeros((dim, dim)), 0
        for pdf in batches:
            raw = pdf.loc[pdf["dim"] == dim, "raw"]
            if len(raw):
                u = _unit(raw, dim)[1]
                s, p, n = s + u.sum(axis=0), p + u.T @ u, n + len(u)
        yield pd.DataFrame({"at": np.arange(dim * dim + dim + 1), "v": np.concatenate([p.ravel(), s, [n]])})
    return run


def principal_axes(nodes: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal axes (columns), most variance first. The driver reads
    dim * (dim + 1) + 1 sums over all vectors of that dimension."""
    rows = nodes.select("dim", "raw").mapInPandas(_moments(dim), "at int, v double") \
        .groupBy("at").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(dim * dim + dim + 1)
    for r in rows:
        v[r["at"]] = r["v"]
    n = max(v[-1], 1.0)
    mean = v[dim * dim:-1] / n
    return np.linalg.eigh(v[:dim * dim].reshape(dim, dim) / n - np.outer(mean, mean))[1][:, ::-1]


def _rotate(u: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the axes; vectors of another dimension keep their own."""
    return u @ axes if axes.shape[0] == u.shape[1] else u


def _cells(axes: np.ndarray, epsilon: float):
    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                y = _rotate(_unit(part["raw"], int(dim))[1], axes)
                c = np.zeros((len(part), CELL_AXES), dtype=np.int64)
                m = min(CELL_AXES, y.shape[1])
                c[:, :m] = np.floor(y[:, :m] / epsilon)
                out = {"node": part["node"], "dim": part["dim"], "copies": part["copies"], "raw": part["raw"]}
                yield pd.DataFrame(out | {f"cell{k}": c[:, k] for k in range(CELL_AXES)})
    return run


def _boxes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.zeros(BOX_AXES), np.zeros(BOX_AXES)
    m = min(BOX_AXES, y.shape[1])
    lo[:m], hi[:m] = y[:, :m].min(axis=0) - TOLERANCE, y[:, :m].max(axis=0) + TOLERANCE
    return lo, hi


def _packed(raw: bytes) -> bytes:
    """The numbers of a block as 32-bit floats where that loses nothing."""
    x = np.frombuffer(raw, dtype=np.float64)
    y = x.astype(np.float32)
    return y.tobytes() if (y == x).all() else raw


def _unpacked(raw: bytes, n: int, dim: int) -> bytes:
    return raw if len(raw) == 8 * n * dim else np.frombuffer(raw, dtype=np.float32).astype(np.float64).tobytes()


BLOCKS = "block long, dim int, nodes binary, copies binary, raw binary, lo array<double>, hi array<double>"


def _make_block(axes: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        dim = int(pdf["dim"].iloc[0])
        lo, hi = _boxes(_rotate(_unit(pdf["raw"], dim)[1], axes))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "dim": [dim],
                             "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
                             "copies": [pdf["copies"].to_numpy(np.int64).tobytes()],
                             "raw": [_packed(b"".join(pdf["raw"]))], "lo": [lo.tolist()], "hi": [hi.tolist()]})
    return run


def _far(lo_a, hi_a, lo_b, hi_b, epsilon: float) -> bool:
    gap = np.maximum(0.0, np.maximum(lo_b - hi_a, lo_a - hi_b))
    return float((gap * gap).sum()) > epsilon * epsilon


def join_intervals(a: tuple[int, int], b: tuple[int, int], ya: np.ndarray, yb: np.ndarray, epsilon: float, leaf: int):
    """Leaf interval pairs of two sequences that can hold a link: both intervals
    are halved until they are small, distant pairs are dropped on the way. For a
    sequence with itself (``ya is yb``) each unordered pair comes once."""
    todo, out = [(*a, *b)], []
    while todo:
        i, j, k, m = todo.pop()
        if ya is yb and k < i:
            continue
        if _far(*_boxes(ya[i:j]), *_boxes(yb[k:m]), epsilon):
            continue
        if j - i <= leaf and m - k <= leaf:
            out.append((i, j, k, m))
            continue
        left = [(i, j)] if j - i <= leaf else [(i, (i + j) // 2), ((i + j) // 2, j)]
        right = [(k, m)] if m - k <= leaf else [(k, (k + m) // 2), ((k + m) // 2, m)]
        todo += [(*x, *y) for x in left for y in right]
    return out


def _exactly(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """The same sum whatever block the pair is compared in."""
    dot = math.fsum(p * q for p, q in zip(x.tolist(), y.tolist()))
    return dot / math.sqrt(math.fsum(p * p for p in x.tolist()) * math.fsum(q * q for q in y.tolist())) >= threshold


def _links(xa: np.ndarray, xb: np.ndarray, la: np.ndarray, lb: np.ndarray, threshold: float) -> np.ndarray:
    cosine = (xa @ xb.T) / (la[:, None] * lb[None, :])
    link = cosine >= threshold
    for p, q in zip(*np.nonzero(np.abs(cosine - threshold) < CLOSE)):
        link[p, q] = _exactly(xa[p], xb[q], threshold)
    return link


class _Block:
    def __init__(self, r, axes: np.ndarray):
        self.node, self.copies = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.copies, np.int64)
        dim = int(r.dim)
        self.x, unit = _unit([_unpacked(r.raw, len(self.node), dim)], dim)
        self.y = _rotate(unit, axes)
        self.length = np.sqrt((self.x * self.x).sum(axis=1))


def _compare_blocks(a: _Block, b: _Block, threshold: float, epsilon: float, leaf: int) -> pd.DataFrame:
    """Link weights (b = -1) and spanning edges (weight 0) of a pair of blocks."""
    same = a is b
    wa, wb = np.zeros(len(a.node), np.int64), np.zeros(len(b.node), np.int64)
    left, right = [], []
    for i, j, k, m in join_intervals((0, len(a.node)), (0, len(b.node)), a.y, b.y, epsilon, leaf):
        link = _links(a.x[i:j], b.x[k:m], a.length[i:j], b.length[k:m], threshold)
        if same and i == k:
            link &= np.triu(np.ones_like(link), 1)
        p, q = np.nonzero(link)
        if len(p):
            np.add.at(wa, p + i, b.copies[q + k])
            np.add.at(wb, q + k, a.copies[p + i])
            for u, v in spanning_edges(j - i + m - k, p, q + (j - i)):
                left.append(a.node[i + u])
                right.append(b.node[k + v - (j - i)])
    if same:
        wa, wb = wa + wb, np.zeros(0, np.int64)
    node, w = np.concatenate([a.node, b.node[:len(wb)]]), np.concatenate([wa, wb])
    some = w > 0
    return pd.DataFrame({
        "a": np.concatenate([node[some], np.array(left, np.int64)]),
        "b": np.concatenate([np.full(int(some.sum()), -1), np.array(right, np.int64)]),
        "weight": np.concatenate([w[some], np.zeros(len(left), np.int64)])})


def _compare_tile(axes: np.ndarray, threshold: float, epsilon: float, leaf: int):
    def run(pairs: pd.DataFrame, body: pd.DataFrame) -> pd.DataFrame:
        blocks = {int(r.block): _Block(r, axes) for r in body.itertuples(index=False)}
        parts = [_compare_blocks(blocks[a], blocks[b], threshold, epsilon, leaf)
                 for a, b in sorted(zip(pairs["block"].tolist(), pairs["other"].tolist()))]
        out = pd.concat(parts, ignore_index=True)
        # one row per vector of the tile
        counted = out[out["b"] < 0].groupby("a", as_index=False)["weight"].sum().assign(b=-1)
        return pd.concat([counted, out[out["b"] >= 0]], ignore_index=True)[["a", "b", "weight"]]
    return run


def _box_gap2(a: str, b: str):
    """Squared distance of two boxes, as a SQL expression."""
    gap = (f"greatest(0D, element_at({b}.lo, k) - element_at({a}.hi, k), element_at({a}.lo, k) - element_at({b}.hi, k))")
    return F.expr(f"aggregate(transform(sequence(1, {BOX_AXES}), k -> {gap}), 0D, (s, x) -> s + x * x)")


def block_pairs(boxes: DataFrame, epsilon: float, fan_out: int = FAN_OUT) -> DataFrame:
    """Pairs ``(block, other)``, block <= other, of equal dimension whose boxes are
    within epsilon. Starts with the whole sequence against itself and replaces
    pairs of intervals by pairs of their children, level by level."""
    top = boxes.agg(F.max("block")).first()[0]
    if top is None:
        return boxes.select("block", F.col("block").alias("other"))
    levels = [boxes.select(F.col("block").alias("id"), "dim", "lo", "hi")]
    while top >= 1:
        below = levels[-1]
        both = below.groupBy(F.floor(F.col("id") / fan_out).cast("long").alias("id")).agg(
            F.min("dim").alias("dim"), F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))  # fan_out lists
        levels.append(written(both.select(
            "id", "dim", F.expr(f"transform(sequence(1, {BOX_AXES}), k -> array_min(transform(los, x -> element_at(x, k))))").alias("lo"),
            F.expr(f"transform(sequence(1, {BOX_AXES}), k -> array_max(transform(his, x -> element_at(x, k))))").alias("hi")), "ego-level"))
        top //= fan_out
    pairs = levels[-1].select(F.col("id").alias("a"), F.col("id").alias("b"))
    for depth, level in enumerate(reversed(levels[:-1])):
        kid = level.withColumn("up", F.floor(F.col("id") / fan_out).cast("long"))
        x = kid.select(F.col("up").alias("a"), F.struct("id", "dim", "lo", "hi").alias("x"))
        y = kid.select(F.col("up").alias("b"), F.struct("id", "dim", "lo", "hi").alias("y"))
        near = pairs.join(x, "a").join(y, "b").where("x.id <= y.id").where(_box_gap2("x", "y") <= epsilon * epsilon)
        if depth == len(levels) - 2:
            near = near.where("x.dim = y.dim")
        pairs = written(near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "ego-pairs")
    return pairs.select(F.col("a").alias("block"), F.col("b").alias("other"))


def _bytes(batches):
    for pdf in batches:
        yield pd.DataFrame({"node": pdf["node"], "dim": [len(v) for v in pdf["vec"]], "copies": pdf["copies"],
                            "raw": [np.asarray(v, dtype=np.float64).tobytes() for v in pdf["vec"]]})


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                 block: int = BLOCK, leaf: int = LEAF, tile: int = TILE) -> DataFrame:
    """One row per input row: ``key, n_links, component_id, kept``.

    Two rows are linked if the cosine of their vectors, in double precision, is at
    least ``threshold``; ``n_links`` counts the linked other rows, ``component_id``
    is the smallest key reachable by links (its own included), ``kept`` is key =
    component_id.

    Vectors that are null, empty, zero or hold a null or non-finite component link
    with nothing; so do vectors of different dimension with each other. Vectors are
    scaled by a power of two first, so very large and very small ones count like
    any others; a cosine within 1e-12 of ``threshold`` is summed exactly. Equal
    vectors (repeated rows too) are linked; a null key sorts first and equals
    itself; an empty table gives no rows; other columns are ignored.
    """
    spark = df.sparkSession
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold)) + TOLERANCE
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    fine = F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad & (largest > 0)
    rows = rows.withColumn("ok", F.coalesce(fine, F.lit(False)))
    # Scaled so that the largest component is about 1: an exact step, in two halves
    # because the power itself may leave the range. Squares then stay in range.
    power = -F.floor(F.log2(largest))
    half = F.floor(power / 2)
    usable = rows.where("ok").withColumn("vec", F.transform(
        "vec", lambda x: x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)))
    classes = written(usable.groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("node", F.monotonically_increasing_id()), "ego-classes")
    nodes = written(classes.select("node", "vec", "copies").mapInPandas(
        _bytes, "node long, dim int, copies long, raw binary"), "ego-nodes")
    common = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").first()
    axes = principal_axes(nodes, common["dim"]) if common else np.eye(1)

    cells = [f"cell{k}" for k in range(CELL_AXES)]
    celled = nodes.mapInPandas(_cells(axes, epsilon), "node long, dim int, copies long, raw binary, "
                               + ", ".join(f"{c} long" for c in cells))
    order = ["dim", *cells, "node"]
    seq = written(celled.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("node", "dim", "copies", "raw", F.spark_partition_id().alias("pid"),
                          F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "ego-sequence")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = seq.groupBy("pid").agg(F.count(F.lit(1)).alias("n")) \
        .select("pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = seq.join(F.broadcast(starts), "pid").withColumn("pos", F.col("first") + F.col("at"))
    # A block holds one dimension: each dimension begins at a multiple of the block size.
    dims = placed.groupBy("dim").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)  # one row per dimension
    dims = written(dims.select("dim", "first_pos", F.coalesce(
        F.sum(F.ceil(F.col("n") / block) * block).over(earlier), F.lit(0)).alias("shifted")), "ego-dims")
    blocks = placed.join(sized_broadcast(dims), "dim") \
        .withColumn("block", F.floor((F.col("pos") - F.col("first_pos") + F.col("shifted")) / block).cast("long"))
    blocks = written(blocks.select("block", "dim", "node", "copies", "raw", "pos").groupBy("block")
                     .applyInPandas(_make_block(axes), BLOCKS), "ego-blocks")
    pairs = block_pairs(blocks.select("block", "dim", "lo", "hi"), epsilon)
    tiles = pairs.select(F.expr(f"block div {tile}").alias("row"), F.expr(f"other div {tile}").alias("col"), "block", "other")
    # a block travels once to each tile that has a pair of it
    need = tiles.select(F.col("row").alias("to_row"), F.col("col").alias("to_col"), F.explode(F.array("block", "other")).alias("block")).distinct()
    sent = need.join(blocks.select("block", "dim", "nodes", "copies", "raw"), "block")
    found = written(tiles.groupBy("row", "col").cogroup(sent.groupBy("to_row", "to_col")).applyInPandas(
        _compare_tile(axes, threshold, epsilon, leaf), "a long, b long, weight long"), "ego-links")
    links = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("near"))
    groups = components(found.where("b >= 0").select("a", "b"), "ego")

    named = classes.select("vec", "node", "least", "copies").join(links, "node", "left").join(groups, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min(F.struct("least")).alias("m"))
    verdict = named.join(smallest, "label").select(
        "vec", F.col("m.least").alias("component_id"), (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = usable.join(verdict, "vec").select("id", "n_links", "component_id")
    alone = rows.where(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
