"""Exact contributions of features to the score of additive trees, against a background of known rows.

A leaf is reached by a hybrid of a row x and a background row z if each feature on its path comes from the one that meets the path's
conditions. So a leaf's share depends on two patterns only: which features of its path x meets, and which z meets. With a
features that x alone meets and b that z alone meets, each of the a features gets the leaf's value times (a-1)! b! / (a+b)!, each of the b loses
a! (b-1)! / (a+b)! of it, and nothing else is left of the sum over all orders of the features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions.columns import hash_uniform
from churnkit.operators.boosting import BoostedTrees, Tree
from churnkit.session import scratch_path

# Rows looked at together.
ROWS = 512
_TABLE = 1 << 22


def forest_trees(model: PipelineModel) -> list[Tree]:
    """The trees of a fitted forest, read from its stored form: a leaf's value is its share of class 1 over the number of trees, so
    values add up to the probability. As large as the model."""
    forest = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    forest.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    by_tree: dict[int, dict] = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r
    trees = []
    for _, own in sorted(by_tree.items()):
        at = {i: k for k, i in enumerate(sorted(own))}
        rows = [own[i] for i in sorted(own)]
        inner = [r["leftChild"] >= 0 for r in rows]
        stats = np.array([r["impurityStats"] for r in rows], float)
        trees.append(Tree(
            np.array([r["split"]["featureIndex"] if i else -1 for r, i in zip(rows, inner, strict=True)], np.int64),
            np.array([r["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for r, i in zip(rows, inner, strict=True)]),
            np.array([at[r["leftChild"]] if i else 0 for r, i in zip(rows, inner, strict=True)], np.int64),
            np.array([at[r["rightChild"]] if i else 0 for r, i in zip(rows, inner, strict=True)], np.int64),
            np.zeros(len(rows), bool), stats[:, 1] / stats.sum(1) / len(by_tree), stats.sum(1)))
    return trees


@dataclass
class _Paths:
    """Leaves of a tree with the conditions of their paths, one interval for each of up to D features."""

    value: np.ndarray    # [L]
    feature: np.ndarray  # [L, D]
    low: np.ndarray      # [L, D]; NaN is no bound
    high: np.ndarray
    missing: np.ndarray  # [L, D]: whether a missing value goes along

    def patterns(self, x: np.ndarray) -> np.ndarray:
        """Bit j of a row and leaf is set if the row meets the conditions on the j-th feature of the path."""
        v = x[:, self.feature]
        met = ~(v <= self.low) & ~(v > self.high) & (self.missing | ~np.isnan(v))
        return (met << np.arange(self.feature.shape[1])).sum(2)


def _paths(tree: Tree) -> _Paths:
    leaves, stack = [], [(0, {})]
    while stack:
        at, path = stack.pop()
        f = int(tree.feature[at])
        if f < 0:
            leaves.append((tree.value[at], path))
            continue
        t, goes = tree.threshold[at], bool(tree.missing_left[at])
        low, high, missing = path.get(f, (np.nan, np.nan, True))
        stack.append((tree.left[at], {**path, f: (low, np.fmin(high, t), missing and goes)}))
        stack.append((tree.right[at], {**path, f: (np.fmax(low, t), high, missing and not goes)}))
    d = max(1, max(len(p) for _, p in leaves))
    cells = [[(f, *c) for f, c in sorted(p.items())] + [(0, np.nan, np.nan, True)] * (d - len(p)) for _, p in leaves]
    take = lambda i, kind: np.array([[c[i] for c in row] for row in cells], kind)
    return _Paths(np.array([v for v, _ in leaves], float), take(0, np.int64), take(1, float), take(2, float), take(3, bool))


def _weights(d: int) -> tuple[np.ndarray, np.ndarray]:
    gain, loss = np.zeros((d + 1, d + 1)), np.zeros((d + 1, d + 1))
    for a in range(d + 1):
        for b in range(d + 1 - a):
            if a:
                gain[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                loss[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return gain, loss


@dataclass
class Explainer:
    """Trees prepared against a background; ``expected`` is the mean score of the background."""

    paths: list[_Paths]
    codes: list[np.ndarray]    # per tree [L, Z]: different patterns of the background at each leaf
    shares: list[np.ndarray]   # per tree [L, Z]: their shares of the background
    width: int
    expected: float

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """[rows, features]; a row adds up to its score less ``expected``."""
        out = np.zeros((len(x), self.width))
        for at in range(0, len(x), ROWS):
            part = x[at:at + ROWS]
            for paths, codes, shares in zip(self.paths, self.codes, self.shares, strict=True):
                out[at:at + ROWS] += self._tree(paths, codes, shares, part)
        return out

    def _tree(self, paths: _Paths, codes: np.ndarray, shares: np.ndarray, x: np.ndarray) -> np.ndarray:
        leaves, d = paths.feature.shape
        key = paths.patterns(x) | np.arange(leaves) << d
        # each pattern that occurs at a leaf is worked out once for all rows that have it
        if leaves << d <= _TABLE:
            place = np.zeros(leaves << d, np.int64)
            place[key] = 1
            found = np.flatnonzero(place)
            place[found] = np.arange(len(found))
            at = place[key]
        else:
            found, at = np.unique(key, return_inverse=True)
            at = at.reshape(key.shape)
        leaf, own = found >> d, found & ((1 << d) - 1)
        full, z = (1 << d) - 1, codes[leaf]
        lack = full & ~own
        alive = shares[leaf] * ((own[:, None] | z) == full)
        gain, loss = _weights(d)
        a, b = np.bitwise_count(own[:, None] & ~z).astype(np.int64), np.bitwise_count(lack).astype(np.int64)
        up = alive * gain[a, b[:, None]]
        down = (alive * loss[a, b[:, None]]).sum(1)
        table = np.zeros((len(found), self.width))
        rows = np.arange(len(found))
        for j in range(d):
            cell = np.where(own >> j & 1 == 1, (up * (z >> j & 1 == 0)).sum(1), -down)
            table[rows, paths.feature[leaf, j]] += cell * paths.value[leaf]
        return table[at].sum(1)


def explain(trees: Sequence[Tree], background: np.ndarray) -> Explainer:
    """Prepare trees against the rows of ``background`` ([rows, features]), all of which count alike."""
    paths = [_paths(t) for t in trees]
    codes, shares, expected = [], [], 0.0
    for p in paths:
        z = p.patterns(background)
        full = (1 << p.feature.shape[1]) - 1
        expected += float(((z == full) * p.value).sum(1).mean())
        own = [np.unique(z[:, k], return_counts=True) for k in range(z.shape[1])]
        most = max(len(c) for c, _ in own)
        codes.append(np.array([np.pad(c, (0, most - len(c))) for c, _ in own]))
        shares.append(np.array([np.pad(n / len(z), (0, most - len(n))) for _, n in own]))
    return Explainer(paths, codes, shares, background.shape[1], expected)


def background_rows(df: DataFrame, features: Sequence[str], key: str, rows: int = 50, seed: int = 42) -> np.ndarray:
    """A stated number of background rows, chosen by key: the same ones on every run."""
    got = (df.orderBy(hash_uniform(seed, F.lit("background"), key), key).limit(rows)
           .select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]).collect())
    if not got:
        raise ValueError("the background has no rows")
    return np.array([[np.nan if v is None else v for v in r] for r in got], float)


def tree_contributions(model: PipelineModel | BoostedTrees, df: DataFrame, background: np.ndarray, features: Sequence[str],
                       key: str) -> DataFrame:
    """Rows key, feature, contribution, expected: what each feature adds to each row's score, exactly.

    The score is the probability of class 1 of a forest, the margin of boosted trees. A row's contributions add up to its score less
    ``expected``, the mean score of the background. The prepared trees are broadcast, so they are as large as the model times the
    different patterns of the background; rows are mapped where they are.
    """
    names = list(features)
    boosted = isinstance(model, BoostedTrees)
    ready = explain(model.trees if boosted else forest_trees(model), background)
    expected = ready.expected + (model.base if boosted else 0.0)
    sent = df.sparkSession.sparkContext.broadcast(ready)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(names))]).astype(float)
            got = sent.value.contributions(x)
            at = np.repeat(np.arange(b.num_rows), len(names))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(names * b.num_rows, pa.string()), pa.array(got.ravel()), pa.array(np.full(len(at), expected))],
                ["key", "feature", "contribution", "expected"])

    rows = df.select(F.col(key).alias("key"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(names)])
    return rows.mapInArrow(run, f"key {kind}, feature string, contribution double, expected double").withColumnRenamed("key", key)
