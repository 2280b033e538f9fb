"""Trees grown by histograms: one aggregate a level, whatever the rows.

A level counts its rows by (node, feature, bin): the sum of weights ``n``, of the target ``s`` and of its square ``q``.
Running sums over the bins give every split's gain, and the best of each node is one more aggregate over that small table. Tasks
combine before they shuffle, so what travels and what reaches the driver is bounded by nodes x features x bins.

Nodes are numbered like a heap: 1 is the root, 2i and 2i + 1 are the children of i; rows with value <= threshold go to 2i. Of equal
gains the first feature and the least threshold win. Rows without a feature or without the target are left out of the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import place_among

Points = Mapping[str, Sequence[float]]

NODE_SCHEMA = "id bigint, feature string, threshold double, gain double, n double, mean double, impurity double"


@dataclass
class Tree:
    """Nodes by id: n, mean and impurity of each, with feature, threshold and gain where it is split."""

    nodes: dict[int, dict] = field(default_factory=dict)

    def is_split(self, node: int) -> bool:
        return self.nodes.get(node, {}).get("feature") is not None

    def walk(self, leaf: Callable[[int], Column], node: int = 1) -> Column:
        """What ``leaf`` gives for the leaf that a row falls into."""
        if not self.is_split(node):
            return leaf(node)
        own = self.nodes[node]
        left, right = self.walk(leaf, 2 * node), self.walk(leaf, 2 * node + 1)
        return F.when(F.col(own["feature"]) <= F.lit(own["threshold"]), left).otherwise(right)

    def value(self) -> Column:
        """Mean target of the leaf that a row falls into."""
        return self.walk(lambda i: F.lit(float(self.nodes[i]["mean"])))

    def table(self, df: DataFrame) -> DataFrame:
        """The nodes as rows of ``NODE_SCHEMA``."""
        names = [f.split()[0] for f in NODE_SCHEMA.split(", ")][1:]
        rows = [(i, *[own.get(name) for name in names]) for i, own in sorted(self.nodes.items())]
        return df.sparkSession.createDataFrame(rows, NODE_SCHEMA)


def split_points(df: DataFrame, columns: Sequence[str], max_bins: int = 32) -> dict[str, list[float]]:
    """Thresholds of each column: midpoints of neighbours if it has at most ``max_bins`` values, else quantiles.

    Two aggregates at most. Quantiles are approximate (1 in 10,000) and are values of the column.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    first = numbers.agg(*[
        f.alias(f"{name}|{c}") for c in columns
        for name, f in (("n", F.approx_count_distinct(c)), ("q", F.percentile_approx(c, shares, 10_000)))
    ]).first()
    few = [c for c in columns if first[f"n|{c}"] <= 2 * max_bins]  # the count is within a few percent
    listed = numbers.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    points = {}
    for c in columns:
        values = sorted(listed[c]) if c in few else None
        if values is not None and len(values) <= max_bins:
            points[c] = [(a + b) / 2 for a, b in zip(values, values[1:])]
        else:
            points[c] = sorted(set(first[f"q|{c}"] or []))
    return points


def _impurity(kind: str, n: Column, s: Column, q: Column) -> Column:
    """Variance of the target, or the Gini impurity of a 0/1 target."""
    if kind == "gini":
        return 2 * (s / n) * (1 - s / n)
    return q / n - (s / n) * (s / n)


def histogram(df: DataFrame, points: Points, target: Column, *, node: Column | None = None, weight: Column | None = None) -> DataFrame:
    """(node, feature, bin, n, s, q): the place of a feature among ``points``, and the sums of its bin."""
    columns = list(points)
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns])
    cells = [F.struct(F.lit(i).alias("feature"), place_among(F.col(f"`{c}`"), points[c]).alias("bin")) for i, c in enumerate(columns)]
    w = F.lit(1.0) if weight is None else weight.cast("double")
    rows = df.filter(complete).select(
        (F.lit(1) if node is None else node).cast("bigint").alias("node"), target.cast("double").alias("_y"), w.alias("_w"), F.explode(F.array(*cells)).alias("_cell")
    )
    rows = rows.filter(F.col("_y").isNotNull() & (F.col("_w") > 0))
    w, y = F.col("_w"), F.col("_y")
    return rows.groupBy("node", "_cell.feature", "_cell.bin").agg(F.sum(w).alias("n"), F.sum(w * y).alias("s"), F.sum(w * y * y).alias("q"))


def split_gains(counts: DataFrame, points: Points, impurity: str = "gini") -> DataFrame:
    """Every split of a histogram with rows on both sides.

    (node, place, feature, threshold, n, s, q, n_left, s_left, q_left, gain); ``place`` is the feature's place among ``points``.
    """
    whole = Window.partitionBy("node", "feature")  # at most a row for each bin
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(
        "node", F.col("feature").alias("place"), "bin",
        *[F.sum(c).over(whole).alias(c) for c in "nsq"], *[F.sum(c).over(upto).alias(f"{c}_left") for c in "nsq"],
    )
    lists = F.array(*[F.array(*[F.lit(float(p)) for p in points[c]]) if points[c] else F.array().cast("array<double>") for c in points])
    names = F.array(*map(F.lit, points))
    left = _impurity(impurity, F.col("n_left"), F.col("s_left"), F.col("q_left"))
    n_right = F.col("n") - F.col("n_left")
    right = _impurity(impurity, n_right, F.col("s") - F.col("s_left"), F.col("q") - F.col("q_left"))
    gain = _impurity(impurity, F.col("n"), F.col("s"), F.col("q")) - F.col("n_left") / F.col("n") * left - n_right / F.col("n") * right
    threshold = F.get(F.get(lists, F.col("place")), F.col("bin"))
    inner = sums.filter((F.col("n_left") > 0) & (F.col("n_left") < F.col("n")))
    return inner.select(
        "node", "place", F.get(names, F.col("place")).alias("feature"), threshold.alias("threshold"),
        "n", "s", "q", "n_left", "s_left", "q_left", gain.alias("gain"),
    ).filter(F.col("threshold").isNotNull())


def best_splits(gains: DataFrame) -> DataFrame:
    """The best split of each node."""
    order = F.struct(F.col("gain"), -F.col("place"), -F.col("threshold"))
    fields = [c for c in gains.columns if c != "node"]
    return gains.groupBy("node").agg(F.max_by(F.struct(*fields), order).alias("_best")).select("node", "_best.*")


def grow(
    df: DataFrame, points: Points, target: Column, *, depth: int, impurity: str = "gini", weight: Column | None = None,
) -> Tree:
    """A tree of at most ``depth`` splits on a path. One aggregate over ``df`` a level."""
    tree = Tree()

    def summed(n: float, s: float, q: float) -> dict:
        mean = s / n
        return {"n": n, "mean": mean, "impurity": 2 * mean * (1 - mean) if impurity == "gini" else max(0.0, q / n - mean * mean)}

    open_: set[int] = {1}
    for level in range(depth):
        node = tree.walk(lambda i: F.lit(i)) if level else F.lit(1)
        rows = df.withColumn("_node", node)
        if level:
            rows = rows.filter(F.col("_node").isin(sorted(open_)))
        gains = split_gains(histogram(rows, points, target, node=F.col("_node"), weight=weight), points, impurity)
        found = best_splits(gains).collect()
        open_ = set()
        for r in found:
            own = tree.nodes.setdefault(r["node"], summed(r["n"], r["s"], r["q"]))
            if r["gain"] <= 0:
                continue
            own |= {"feature": r["feature"], "threshold": r["threshold"], "gain": r["gain"]}
            left = summed(r["n_left"], r["s_left"], r["q_left"])
            right = summed(r["n"] - r["n_left"], r["s"] - r["s_left"], r["q"] - r["q_left"])
            tree.nodes |= {2 * r["node"]: left, 2 * r["node"] + 1: right}
            open_ |= {i for i in (2 * r["node"], 2 * r["node"] + 1) if tree.nodes[i]["impurity"] > 1e-12}
        if not open_:
            break
    if not tree.nodes:  # no split at all: the leaf is the mean
        rows = df.filter(reduce(and_, [F.col(f"`{c}`").isNotNull() for c in points]) & target.isNotNull())
        w = F.lit(1.0) if weight is None else weight.cast("double")
        y = target.cast("double")
        n, s, q = rows.agg(F.sum(w), F.sum(w * y), F.sum(w * y * y)).first()
        tree.nodes[1] = summed(n, s, q) if n else {"n": 0.0, "mean": None, "impurity": None}
    return tree


def predicted(df: DataFrame, trees: Sequence[Tree], columns: Sequence[str], output: str, weights: Sequence[float] | None = None) -> DataFrame:
    """Weighted sum of the trees' leaf means (their mean without weights), null where a feature is missing."""
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns])
    shares = [1.0 / len(trees)] * len(trees) if weights is None else weights
    total = reduce(lambda a, b: a + b, [tree.value() * share for tree, share in zip(trees, shares)])
    return df.withColumn(output, F.when(complete, total))


# --- ensembles ----------------------------------------------------------------------------------------

def forest(df: DataFrame, points: Points, target: Column, members: Sequence[tuple[Sequence[str], Column | None]], *, depth: int) -> list[Tree]:
    """A tree for each member: its own columns, and its own weight of each row (how often the row is drawn)."""
    return [grow(df, {c: points[c] for c in columns}, target, depth=depth, weight=weight) for columns, weight in members]


@dataclass
class Boosted:
    """Trees of a boosted model for 0/1 labels with their weights; ``margin`` is half the log odds."""

    trees: list[Tree]
    weights: list[float]

    def margin(self) -> Column:
        return reduce(lambda a, b: a + b, [t.value() * w for t, w in zip(self.trees, self.weights)])

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-2 * self.margin()))


def residual(label: Column, margin: Column) -> Column:
    """What is left to explain of a 0/1 label under the log loss, for labels turned to -1 and 1."""
    y = 2 * label - 1
    return 4 * y / (1 + F.exp(2 * y * margin))


def boost(df: DataFrame, points: Points, label: Column, *, rounds: int, step: float = 0.1, depth: int = 1) -> Boosted:
    """Trees fitted one after another to the residuals; the first to the labels themselves, with weight 1."""
    model = Boosted([], [])
    for i in range(rounds):
        target = residual(label, model.margin()) if i else 2 * label - 1
        model.trees.append(grow(df, points, target, depth=depth, impurity="variance"))
        model.weights.append(step if i else 1.0)
    return model


def importances(nodes: DataFrame, *, per_tree: bool = True) -> DataFrame:
    """(feature, importance) of split nodes (tree, feature, gain, n): gain times weight by feature, as shares.

    Each tree's shares add up to 1 before the trees are added, unless ``per_tree`` is off.
    """
    split = nodes.filter(F.col("feature").isNotNull())
    by_tree = split.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("part"))
    total = F.sum("part").over(Window.partitionBy("tree")) if per_tree else F.lit(1.0)  # a row for each feature
    by_feature = by_tree.withColumn("part", F.col("part") / total).groupBy("feature").agg(F.sum("part").alias("part"))
    whole = by_feature.agg(F.sum("part")).scalar()
    return by_feature.select("feature", (F.col("part") / whole).alias("importance"))
