"""Decision tree from histograms.

The tree grows level by level. A level is one aggregation: every open row adds to
the histogram of its node, per feature and bin, with the number of rows and of
positives; the histograms (nodes x features x bins, whatever the number of rows)
give the best split of every node at once. Rows find their children by a join
with the level's splits, a table of one row per node.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.gradient import usable
from quarry.operators.ordered import prefix_sums
from quarry.session import cut_lineage, sized_broadcast

GAIN_DIGITS = 10        # gains are compared after rounding, so equal splits tie alike everywhere
CUT_EVERY = 4           # levels between two checkpoints of the open rows


@dataclass(frozen=True)
class Node:
    """Children of node k are 2k (feature <= threshold) and 2k + 1."""
    node: int
    n: int
    positives: int
    feature: str | None = None
    bin: int | None = None
    threshold: float | None = None
    gain: float | None = None

    @property
    def depth(self) -> int:
        return self.node.bit_length() - 1


@dataclass
class Tree:
    features: list[str]
    edges: dict[str, list[float]]
    nodes: dict[int, Node]

    def frame(self, spark) -> DataFrame:
        """One row per node; leaves have no feature."""
        rows = [(k.node, k.depth, k.n, k.positives, k.feature, k.threshold, k.gain) for k in self.nodes.values()]
        return spark.createDataFrame(rows, "node long, depth int, n long, positives long, feature string, threshold double, gain double")


def bin_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Up to ``bins - 1`` thresholds per feature that cut its rows into equal shares:
    values whose cumulated share passes a multiple of 1 / bins, without the largest
    value. Exact, by one distributed running sum over the distinct values."""
    each = df.select(F.inline(F.array(*[F.struct(F.lit(j).alias("f"), F.col(c).cast("double").alias("v"))
                                        for j, c in enumerate(features)])))
    counts = each.groupBy("f", "v").agg(F.count("*").alias("c"))
    cum = prefix_sums(counts, ["f", "v"], ["c"])
    total = cum.groupBy("f").agg(F.min(F.col("cum_c") - F.col("c")).alias("before"), F.sum("c").alias("n"), F.max("v").alias("top"))
    at = cum.join(F.broadcast(total), "f")      # one row per feature
    upto = F.col("cum_c") - F.col("before")
    share = lambda c: F.floor(c * F.lit(bins).cast("decimal(10,0)") / F.col("n"))
    picked = at.where((share(upto) > share(upto - F.col("c"))) & (F.col("v") < F.col("top"))).select("f", "v").collect()
    out: dict[str, list[float]] = {c: [] for c in features}
    for r in picked:                             # at most `bins` numbers per feature
        out[features[r["f"]]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def bin_of(col: str, edges: list[float]) -> Column:
    """Number of thresholds below the value."""
    return reduce(lambda a, e: a + (F.col(col) > F.lit(float(e))).cast("int"), edges, F.lit(0))


def impurity(n: Column, p: Column, kind: str) -> Column:
    q = p / n
    if kind == "gini":
        return 2 * q * (1 - q)
    part = lambda x: F.when(x > 0, -x * F.log2(x)).otherwise(0.0)
    return part(q) + part(1 - q)


def best_splits(hist: DataFrame, kind: str, min_rows: int) -> DataFrame:
    """Of ``(node, f, b, n, p)`` histograms the best split of each node: ties go to
    the first feature, then the lowest bin."""
    upto = Window.partitionBy("node", "f").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node", "f")
    c = hist.select("node", "f", "b", F.sum("n").over(upto).alias("ln"), F.sum("p").over(upto).alias("lp"),
                    F.sum("n").over(whole).alias("n"), F.sum("p").over(whole).alias("p"))
    c = c.where((F.col("ln") >= min_rows) & (F.col("n") - F.col("ln") >= min_rows))
    n, p, ln, lp = (F.col(x).cast("double") for x in ("n", "p", "ln", "lp"))
    gain = impurity(n, p, kind) - ln / n * impurity(ln, lp, kind) - (n - ln) / n * impurity(n - ln, p - lp, kind)
    c = c.withColumn("gain", F.round(gain, GAIN_DIGITS)).where("gain > 0")
    best = F.max(F.struct("gain", (-F.col("f")).alias("nf"), (-F.col("b")).alias("nb"), "n", "p", "ln", "lp")).alias("s")
    return c.groupBy("node").agg(best).select("node", (-F.col("s.nf")).alias("f"), (-F.col("s.nb")).alias("b"), "s.gain", "s.ln", "s.lp",
                                              "s.n", "s.p")


def fit_tree(df: DataFrame, features: list[str], label: str = "label", max_depth: int = 5, bins: int = 32,
             kind: str = "entropy", min_rows: int = 1) -> Tree:
    """Binary classification tree (label above 0.5 is positive).

    Rows without a label or with a null or NaN feature are left out. A node is not
    split if it is pure, at ``max_depth``, or no split gains. The tree, at most
    2^(max_depth + 1) nodes, is what reaches the driver.
    """
    if kind not in ("entropy", "gini"):
        raise ValueError(f"impurity {kind!r}")
    rows = usable(df, features, label)
    edges = bin_edges(rows, features, bins)
    binned = cut_lineage(rows.select(
        F.lit(1).cast("long").alias("node"), (F.col(label) > 0.5).cast("long").alias("pos"),
        F.array(*[bin_of(c, edges[c]) for c in features]).alias("bins")))
    top = binned.agg(F.count("*").alias("n"), F.coalesce(F.sum("pos"), F.lit(0)).alias("p")).first()
    nodes = {1: Node(1, top["n"], top["p"])}
    open_rows, spark = binned, df.sparkSession
    for level in range(max_depth):
        hist = open_rows.select("node", "pos", F.posexplode("bins").alias("f", "b")) \
                        .groupBy("node", "f", "b").agg(F.count("*").alias("n"), F.sum("pos").alias("p"))
        splits = best_splits(hist, kind, min_rows).collect()    # one row per open node
        if not splits:
            break
        for s in splits:
            k, name = s["node"], features[s["f"]]
            nodes[k] = Node(k, s["n"], s["p"], name, s["b"], edges[name][s["b"]], s["gain"])
            nodes[2 * k] = Node(2 * k, s["ln"], s["lp"])
            nodes[2 * k + 1] = Node(2 * k + 1, s["n"] - s["ln"], s["p"] - s["lp"])
        if level + 1 == max_depth:
            break
        table = spark.createDataFrame([(s["node"], s["f"] + 1, s["b"]) for s in splits], "node long, f int, at int")
        open_rows = open_rows.join(sized_broadcast(table), "node").select(
            (F.col("node") * 2 + (F.element_at("bins", F.col("f")) > F.col("at")).cast("long")).alias("node"), "pos", "bins")
        if level % CUT_EVERY == CUT_EVERY - 1:
            open_rows = cut_lineage(open_rows)
    return Tree(features, edges, dict(sorted(nodes.items())))


def walk(df: DataFrame, tree: Tree, out: str = "node") -> DataFrame:
    """The leaf each row ends in (rows with a null or NaN feature are left out)."""
    rows = usable(df, tree.features, tree.features[0]).withColumn(out, F.lit(1).cast("long"))
    split = [k for k in tree.nodes.values() if k.feature is not None]
    values = F.array(*[F.col(c).cast("double") for c in tree.features])
    for level in sorted({k.depth for k in split}):
        table = df.sparkSession.createDataFrame(
            [(k.node, tree.features.index(k.feature) + 1, k.threshold) for k in split if k.depth == level],
            "_k long, _f int, _t double")
        rows = rows.join(sized_broadcast(table), F.col(out) == F.col("_k"), "left")
        child = F.col(out) * 2 + (F.element_at(values, F.col("_f")) > F.col("_t")).cast("long")
        rows = rows.withColumn(out, F.when(F.col("_k").isNull(), F.col(out)).otherwise(child)).drop("_k", "_f", "_t")
    return rows


def score_depths(df: DataFrame, tree: Tree, depths: list[int]) -> DataFrame:
    """Every row of ``df`` once per depth limit: ``depth, score, prediction``. A tree
    grown level by level holds all shallower trees: at a smaller limit a row stops
    at its leaf's ancestor. The score is the node's share of positives."""
    rows = walk(df, tree, "_leaf")
    each = rows.select("*", F.explode(F.array(*[F.lit(int(d)) for d in depths])).alias("depth"))
    each = each.withColumn("_at", F.expr("shiftright(_leaf, greatest(length(bin(_leaf)) - 1 - depth, 0))"))
    shares = df.sparkSession.createDataFrame([(k.node, k.positives / k.n if k.n else 0.0) for k in tree.nodes.values()],
                                             "_at long, score double")
    return each.join(sized_broadcast(shares), "_at").withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop("_leaf", "_at")
