"""Gradient-boosted trees (logistic loss) grown from histograms of binned rows.

The rows are cut into blocks of bins once, a byte a value, and dealt evenly. A tree level is
one pass: tasks add up counts, sums and square sums of the residuals per (node, feature,
bin) with numpy, and only these tables reach the driver, their size following the model. Of two
sibling nodes the smaller is counted; the other is the parent less its sibling. Margins
stay beside the bins, 23 bytes a row in all. Loss, residuals, variance gain and leaf values
are those of Spark ML's ``GBTClassifier``, whose model class holds the result.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.profile import _long_values
from tarmac.operators.running import running_total
from tarmac.session import scratch_path

BLOCK_ROWS = 1 << 15
REBASE_TREES = 50          # margins are computed from the bins again, so the lineage stays short
COLLECT_PARTS = 64         # more tables than that are added up by the executors first
ROUNDING = 1e-12           # of a node's mean square: gains and impurities below are rounding


# ── bins ─────────────────────────────────────────────────────────────


def split_candidates(df: DataFrame, cols: list[str], max_bins: int) -> list[np.ndarray]:
    """Thresholds of every column, ascending: between all neighbouring values of a column with
    at most ``max_bins`` of them, between equi-depth bins (from the counts of all rows) otherwise."""
    hist = (_long_values(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    cum = running_total(hist, ["feature"], "value", ["cnt"])
    few = cum.groupBy(F.col("feature").alias("_f")).agg(F.count(F.lit(1)).alias("_values"))
    depth = F.floor((F.col("cum_cnt") - 1) * F.lit(max_bins) / F.col("total_cnt")).cast("double")
    key = F.when(F.col("_values") <= max_bins, F.col("value")).otherwise(depth)
    bins = (cum.join(F.broadcast(few), F.col("feature") == F.col("_f")).groupBy("feature", key.alias("_bin"))
            .agg(F.min("value").alias("low"), F.max("value").alias("high")).collect())   # max_bins a column
    out = []
    for c in cols:
        mine = sorted((r["low"], r["high"]) for r in bins if r["feature"] == c)
        out.append(np.array([_between(a, b) for (_, a), (b, _) in zip(mine, mine[1:])], dtype=float))
    return out


def _between(a: float, b: float) -> float:
    middle = a + (b - a) / 2
    return middle if a <= middle < b else a


def binned(df: DataFrame, cols: list[str], label: str, thresholds: list[np.ndarray]) -> DataFrame:
    """(bins, signs) a block: a byte per column and row, column by column, and ±1 per row."""
    def cut(batches):
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)

    def block(held):
        t = pa.Table.from_batches(held)
        x = [t.column(i).to_numpy() for i in range(len(thresholds) + 1)]
        if not np.isin(x[-1], (0, 1)).all():
            raise ValueError("labels must be 0 or 1")
        bins = np.array([np.searchsorted(cuts, v, "left") for cuts, v in zip(thresholds, x)], dtype=np.uint8)
        signs = np.where(x[-1] > 0, 1, -1).astype(np.int8)
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()),
                                           pa.array([signs.tobytes()], pa.binary())], ["bins", "signs"])

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias("_label"))
    return rows.mapInArrow(cut, "bins binary, signs binary")


# ── trees ────────────────────────────────────────────────────────────


@dataclass
class Tree:
    """Nodes by number, children behind their parent; a leaf is its own child."""
    weight: float
    feature: list
    bin: list
    child: list                 # left, right of node 0, left, right of node 1, …
    stats: list                 # (rows, sum, square sum) of the residuals
    gain: list

    def add(self, stats) -> int:
        node = len(self.stats)
        self.feature.append(-1), self.bin.append(0), self.gain.append(-1.0)
        self.child.extend((node, node)), self.stats.append(tuple(float(v) for v in stats))
        return node

    def arrays(self) -> tuple:
        value = np.array([s / n for n, s, _ in self.stats])
        return (np.maximum(np.array(self.feature), 0), np.array(self.bin, dtype=np.uint8),
                np.array(self.child), value, self.weight)


def reached(bins: np.ndarray, tree: tuple | None, depth: int) -> np.ndarray:
    """The node of each row after ``depth`` levels (a leaf stays)."""
    flat, n = bins.reshape(-1), bins.shape[1]
    node, row = np.zeros(n, dtype=np.int64), np.arange(n)
    for _ in range(depth):
        feature, at, child = tree[:3]
        value = flat.take((feature * n).take(node) + row)
        node = child.take(2 * node + (value > at.take(node)))
    return node


def residuals(signs: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree fits: the labels, then the negative gradient of the logistic loss."""
    if margin is None:
        return signs.astype(float)
    return 4.0 * signs / (1.0 + np.exp(2.0 * signs * margin))


def with_trees(blocks: RDD, trees: list[tuple], depth: int) -> RDD:
    """Blocks with the weighted values of ``trees`` added to their margins."""
    def add(items):
        for bins, signs, margin in items:
            margin = np.zeros(len(signs)) if margin is None else margin.copy()
            for tree in trees:
                margin += tree[4] * tree[3][reached(bins, tree, depth)]
            yield bins, signs, margin
    return blocks.mapPartitions(add)


def histograms(blocks: RDD, tree: tuple | None, level: int, slot: np.ndarray, n_bins: int, n_features: int) -> np.ndarray:
    """(slot, statistic, feature, bin): rows, residual sums and square sums of the nodes with a slot."""
    n_slots = int(slot.max()) + 1
    size = n_slots * n_bins

    def count(items):
        out = np.zeros((3, n_features, size))
        for bins, signs, margin in items:
            r, at = residuals(signs, margin), slot.take(reached(bins, tree, level))
            if (at < 0).any():
                rows = np.flatnonzero(at >= 0)
                bins, r, at = bins.take(rows, axis=1), r.take(rows), at.take(rows)
            at, r2 = at * n_bins, r * r
            for f in range(n_features):
                place = at + bins[f]
                out[0, f] += np.bincount(place, minlength=size)
                out[1, f] += np.bincount(place, r, size)
                out[2, f] += np.bincount(place, r2, size)
        yield out

    parts = blocks.mapPartitions(count)
    total = sum(parts.collect()) if blocks.getNumPartitions() <= COLLECT_PARTS else parts.treeReduce(np.add)
    return total.reshape(3, n_features, n_slots, n_bins).transpose(2, 0, 1, 3)


def best_split(table: np.ndarray, least_rows: int) -> tuple | None:
    """(feature, bin, gain, left statistics, right statistics) of the greatest variance gain, the
    first of equal ones; None without a gain. ``table``: (statistic, feature, bin) of a node."""
    left = table.cumsum(axis=2)
    n, s, q = all_rows = left[:, 0, -1]
    nl, sl = left[0, :, :-1], left[1, :, :-1]
    nr, sr = n - nl, s - sl
    fits = (nl >= least_rows) & (nr >= least_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, (sl * sl / nl + sr * sr / nr - s * s / n) / n, -1.0)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[f, b] <= ROUNDING * q / n:
        return None
    return int(f), int(b), float(gain[f, b]), left[:, f, b], all_rows - left[:, f, b]


def _varies(stats) -> bool:
    n, s, q = stats
    return q / n - (s / n) ** 2 > ROUNDING * q / n


def grow(blocks: RDD, weight: float, depth: int, least_rows: int, n_bins: int, n_features: int) -> Tree:
    tree = Tree(weight, [], [], [], [], [])
    tables = {0: histograms(blocks, None, 0, np.zeros(1, int), n_bins, n_features)[0]}
    tree.add(tables[0][:, 0].sum(axis=1))
    for level in range(depth):
        pairs = []
        for node, table in tables.items():
            found = best_split(table, least_rows) if _varies(tree.stats[node]) else None
            if found is None:
                continue
            f, b, gain, left, right = found
            tree.feature[node], tree.bin[node], tree.gain[node] = f, b, gain
            a, z = tree.add(left), tree.add(right)
            tree.child[2 * node: 2 * node + 2] = a, z
            open_ = [c for c in (a, z) if tree.stats[c][0] >= 2 * least_rows and _varies(tree.stats[c])]
            if open_:
                pairs.append((node, *((a, z) if left[0] <= right[0] else (z, a)), open_))
        if not pairs or level + 1 == depth:
            break
        slot = np.full(len(tree.stats), -1)
        for k, (_, small, _, _) in enumerate(pairs):
            slot[small] = k
        counted = histograms(blocks, tree.arrays(), level + 1, slot, n_bins, n_features)
        both = {}
        for k, (node, small, large, open_) in enumerate(pairs):
            mine = {small: counted[k], large: tables[node] - counted[k]}
            both.update({c: mine[c] for c in open_})
        tables = dict(sorted(both.items()))
    return tree


def fit_trees(df: DataFrame, cols: list[str], label: str, n_trees: int, depth: int, rate: float,
              least_rows: int, max_bins: int) -> tuple[list[Tree], list[np.ndarray]]:
    """(trees, thresholds of the columns). The first tree fits the labels with weight 1."""
    if not 2 <= max_bins <= 256:
        raise ValueError("a bin takes one byte: max_bins must be between 2 and 256")
    thresholds = split_candidates(df, cols, max_bins)
    n_bins, n_features = max(len(t) for t in thresholds) + 1, len(cols)
    parts = df.sparkSession.sparkContext.defaultParallelism

    def unpacked(r):
        return (np.frombuffer(r["bins"], np.uint8).reshape(n_features, -1), np.frombuffer(r["signs"], np.int8), None)

    base = (binned(df, cols, label, thresholds).repartition(parts).rdd.map(unpacked)
            .persist(StorageLevel.MEMORY_AND_DISK))
    state, last, trees, arrays = base, None, [], []
    try:
        if base.isEmpty():
            raise ValueError("no rows to fit")
        for k in range(n_trees):
            trees.append(grow(state, 1.0 if k == 0 else rate, depth, least_rows, n_bins, n_features))
            arrays.append(trees[-1].arrays())
            if last is not None and last is not base:
                last.unpersist()
            if k + 1 < n_trees:
                last = state
                state = (with_trees(base, list(arrays), depth) if (k + 1) % REBASE_TREES == 0
                         else with_trees(state, arrays[-1:], depth)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for rdd in {id(r): r for r in (last, state, base) if r is not None}.values():
            rdd.unpersist()
    return trees, thresholds


# ── the model ────────────────────────────────────────────────────────

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
         "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def node_rows(trees: list[Tree], thresholds: list[np.ndarray]) -> list[tuple]:
    rows = []
    for k, t in enumerate(trees):
        for node, (n, s, q) in enumerate(t.stats):
            f, a, z = t.feature[node], *t.child[2 * node: 2 * node + 2]
            split = (f, [float(thresholds[f][t.bin[node]])], -1) if f >= 0 else (-1, [], -1)
            rows.append((k, (node, s / n, max(q / n - (s / n) ** 2, 0.0), [n, s, q], int(n), t.gain[node],
                             *((a, z) if f >= 0 else (-1, -1)), split)))
    return rows


def _described(stage, model: str, **more) -> str:
    named = lambda given: {p.name: v for p, v in given.items()}
    return json.dumps({"class": f"org.apache.spark.ml.{model}", "timestamp": int(time.time() * 1000), "uid": stage.uid,
                       "sparkVersion": SparkSession.getActiveSession().version, "paramMap": named(stage._paramMap),
                       "defaultParamMap": named(stage._defaultParamMap), **more})


def as_model(gbt: GBTClassifier, trees: list[Tree], thresholds: list[np.ndarray]) -> GBTClassificationModel:
    """The trees as Spark ML's model: written as its saved form, whose node table ``train.node_table``
    reads too, and loaded."""
    spark = SparkSession.getActiveSession()
    path, n = scratch_path(spark, "trees"), len(thresholds)
    tree = DecisionTreeRegressor(maxDepth=gbt.getMaxDepth(), maxBins=gbt.getMaxBins())
    about = _described(gbt, "classification.GBTClassificationModel", numFeatures=n, numTrees=len(trees))
    of_tree = _described(tree, "regression.DecisionTreeRegressionModel")
    one = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write
    one([(about,)], "value string").text(f"{path}/metadata")
    one(node_rows(trees, thresholds), NODES).parquet(f"{path}/data")
    one([(k, of_tree, t.weight) for k, t in enumerate(trees)], "_1 int, _2 string, _3 double").parquet(f"{path}/treesMetadata")
    return GBTClassificationModel.load(path)
