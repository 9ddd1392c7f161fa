"""Gradient-boosted trees: logistic loss, histogram splits, leaves by Newton steps.

Cuts are quantiles of counted values; from then on a row is its bins, and equal
rows are one row with counts. Each level of each tree takes one pass that adds up
the gradients by node, feature and bin; the splits and leaves follow from these
sums. They are whole multiples of ``1 / UNIT``, so the trees don't depend on how
rows are dealt or in which order they come. ``fit`` passes over arrays,
``fit_counted`` over a Spark table of any size, from which only the sums (at most
2 x 4 x features x 33 numbers) reach the driver. The fitted trees are a few
kilobytes and score numpy rows inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32  # of the quantiles; cuts between them, so at most BINS - 1 per feature
UNIT = 1 << 20
TASK_ROWS = 50_000  # different rows worth a task of their own


@dataclass(frozen=True)
class BoostedTrees:
    """Complete binary trees: node ``i`` sends rows with
    ``x[feature] > cut`` to ``2 i + 2``, others to ``2 i + 1``."""

    base: float
    features: np.ndarray  # (trees, inner nodes)
    cuts: np.ndarray
    leaves: np.ndarray  # (trees, 2 ** depth)

    def probability(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        inner = self.features.shape[1]
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            out += leaf[_descend(x, feature, cut, inner) - inner]
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))

    def on_values(self, cuts: list[np.ndarray]) -> BoostedTrees:
        """Trees that cut at bins, as trees that cut at the values between them."""
        at = np.full(self.cuts.shape, np.inf)
        for t, i in np.argwhere(np.isfinite(self.cuts)):
            at[t, i] = cuts[self.features[t, i]][int(self.cuts[t, i])]
        return replace(self, cuts=at)


def _descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, inner: int) -> np.ndarray:
    """Each row's first node that is not below ``inner``."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(node) and node[0] < inner:
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node


def quantile_cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Different quantiles, linear between neighbours, of values that occur
    ``counts`` times; ``values`` rise."""
    ends = np.cumsum(counts)
    at = np.linspace(0, 1, BINS + 1)[1:-1] * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, side(at), "right")] for side in (np.floor, np.ceil))
    return np.unique(low + (high - low) * (at - np.floor(at)))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Each value's number of cuts below it."""
    return np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)]).astype(np.uint8)


def _level_sums(trees: BoostedTrees, feature: np.ndarray, split: np.ndarray, level: int,
                bins: np.ndarray, n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """(gradients and weights, node of the level, feature, bin) of rows that
    occur ``n`` times, ``ones`` of them with label 1, after ``trees``; the new
    tree is split above the level."""
    first, wide = 2 ** level - 1, bins.shape[1]
    p = trees.probability(bins)
    node = _descend(bins, feature, split, first) - first
    at = ((node[:, None] * wide + np.arange(wide)) * BINS + bins).ravel()
    size = 2 ** level * wide * BINS
    sums = [np.bincount(at, np.repeat(part, wide), size)
            for part in (ones * UNIT - n * np.rint(p * UNIT), n * np.rint(p * (1 - p) * UNIT))]
    return np.array(sums).astype(np.int64).reshape(2, 2 ** level, wide, BINS)


def _grow(level_sums: Callable, n: int, ones: int, cuts: list[np.ndarray], rounds: int = 40, depth: int = 3,
          rate: float = 0.3, ridge: float = 1.0) -> BoostedTrees:
    """Trees that cut at bins, from ``level_sums(trees, feature, split, level)``."""
    inner = 2 ** depth - 1
    mean = ones / n
    trees = BoostedTrees(float(np.log(mean / (1 - mean))), np.zeros((0, inner), np.int64),
                         np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cut_exists = np.arange(BINS - 1) < np.array([len(c) for c in cuts])[:, None]
    for _ in range(rounds):
        feature, split, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(depth):
            sums = level_sums(trees, feature, split, level)
            for j in range(2 ** level):
                i = 2 ** level - 1 + j
                left = np.cumsum(sums[:, j], axis=-1)  # up to each bin
                whole = left[:, :1, -1:]
                sides = np.array([left, whole - left])[..., :-1] / UNIT
                gain = sum(g ** 2 / (h + ridge) for g, h in sides)
                whole = whole[:, 0, 0] / UNIT
                gain = np.where(cut_exists, gain - whole[0] ** 2 / (whole[1] + ridge), 0)
                f, k = np.unravel_index(gain.argmax(), gain.shape)
                parts = [whole, np.zeros(2)]
                if gain[f, k] > 1e-6:
                    feature[i], split[i] = f, k
                    parts = sides[:, :, f, k]
                if level == depth - 1:
                    leaf[2 * j:2 * j + 2] = [rate * g / (h + ridge) for g, h in parts]
        trees = BoostedTrees(trees.base, *(np.concatenate([a, b[None]]) for a, b in (
            (trees.features, feature), (trees.cuts, split), (trees.leaves, leaf))))
    return trees


def fit(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Boosted trees for 0/1 labels ``y`` in memory; both must occur."""
    cuts = [quantile_cuts(*np.unique(column, return_counts=True)) for column in x.T]
    bins, n = binned(x, cuts), np.ones(len(y))
    trees = _grow(lambda *tree: _level_sums(*tree, bins, n, y), len(y), int(y.sum()), cuts)
    return trees.on_values(cuts)


def _packed(bins: np.ndarray) -> pa.Array:
    """Rows of bins as an Arrow column of byte strings."""
    offsets = np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(bins).reshape(-1))])


def unpacked(column: pa.Array, wide: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, wide)


def bin_column(x: np.ndarray, cuts: list[np.ndarray]) -> pa.Array:
    return _packed(binned(x, cuts))


def fit_counted(rows: DataFrame, n: int, ones: int, cuts: list[np.ndarray]) -> BoostedTrees:
    """Boosted trees, cutting at bins, for a table of (bins, n, ones): different
    rows, how often they occur, and how often with label 1. ``n`` and ``ones``
    are its sums; both labels must occur."""
    wide = len(cuts)
    rows = rows.select("bins", "n", "ones")
    rows = rows.coalesce(1 + rows.count() // TASK_ROWS)  # small tables need no shuffle then

    def level_sums(trees, feature, split, level):
        size = 2 * 2 ** level * wide * BINS

        def run(batches) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64)
            for batch in batches:
                if batch.num_rows:
                    total += _level_sums(trees, feature, split, level, unpacked(batch.column(0), wide),
                                         batch.column(1).to_numpy(), batch.column(2).to_numpy()).reshape(-1)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                             names=["at", "total"])

        found = (rows.mapInArrow(run, "at int, total long")
                 .groupBy("at").agg(F.sum("total").alias("total")).toArrow())
        out = np.zeros(size, np.int64)
        out[found["at"].to_numpy()] = found["total"].to_numpy()
        return out.reshape(2, 2 ** level, wide, BINS)

    return _grow(level_sums, n, ones, cuts)
