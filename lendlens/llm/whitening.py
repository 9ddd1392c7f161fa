"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Components become whole numbers ``floor(64 * c) + 1000000``; the fit list holds
each distinct vector once, packed into blocks under the shared folder. A step of
the bidiagonalisation is one pass over the blocks: a task centres its rows and
returns ``|Xg|``, ``X'Xg`` and the products of ``Xg`` with all earlier left
vectors, a vector of a few hundred numbers. Left vectors are as long as the
table and are never stored: each is ``Xw`` for a ``w`` as short as a row. New
left and right vectors are orthogonalised against all earlier ones; the small
bidiagonal matrix's SVD gives components and deviations. Where the Krylov space
ends early (repeated eigenvalues) it goes on from a fresh orthogonal vector.

The steps end when the space is used up (as many steps as dimensions), or sooner
when the components have converged and the variance that no step has met yet
cannot hold another one as large. The driver holds the dimensions squared, never
a row; what tasks return is summed in a tree.

Defined cases: vectors that are null or hold null or non-finite entries are left
out; rows that repeat an id or a vector all get results, while the fit list has
the vector once; a null id stays null; shorter vectors go on with entries of 0;
entries beyond 2**40 count as that; directions without variance are no
components, so a table of one distinct vector, like an empty one, gives no rows;
equal eigenvalues give some orthonormal basis; a deviation beyond a long is
null; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared as S

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 46            # of scaled entries, so that sums over a block fit a long
BLOCK_BYTES = 1 << 20      # of packed rows
FAN_IN = 64                # partial sums that one task, or the driver, adds at most
CONVERGED = 1e-14          # bound on a component's error before an early end
NOTHING = 1e-13            # of the root of the total variance: numerically zero


@dataclass(frozen=True)
class Whitening:
    """Fitted means, components (rows) and variances; all as long as a vector."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def whole(vector: Column) -> Column:
    """A vector's entries as whole numbers."""
    limit = F.lit(float(LIMIT))
    return F.transform(vector, lambda c: F.floor(
        F.least(F.greatest(c.cast("double") * SCALE, -limit), limit)).cast("long") + OFFSET)


def _usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))),
                      F.lit(False))


def prepare(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, and the number of dimensions."""
    vector = F.col(vector_col)
    rows = df.where(_usable(vector)).select(F.col(id_col).alias("vec_id"), whole(vector).alias("x"))
    wide = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    missing = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(wide) - F.size("x"))
    return rows.withColumn("x", F.concat("x", missing)), wide


def _matrix(lists: pa.Array, wide: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)


def _packed(batches, wide: int) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK_BYTES // (8 * wide))
    for batch in batches:
        for k in range(0, batch.num_rows, step):
            x = _matrix(batch.column(0).slice(k, step), wide)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["rows"])


def _unpacked(batches, wide: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows in batch.column(0):
            yield np.frombuffer(rows.as_buffer(), "<i8").reshape(-1, wide)


def _added(batches) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for row in batch.column(0):
            part = row.values.to_numpy(zero_copy_only=False)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _pass(blocks: DataFrame, wide: int, tasks: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(rows)`` over all blocks, added per task and then in a tree."""
    def partial(batches):
        total = None
        for x in _unpacked(batches, wide):
            now = part(x)
            total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    sums = blocks.mapInArrow(partial, "sums array<double>")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(_added, "sums array<double>")
    return np.sum([r["sums"] for r in sums.collect()], axis=0)  # at most FAN_IN rows


def _exact_sums(blocks: DataFrame, wide: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every dimension."""
    def partial(batches):
        n, total = 0, np.zeros(wide, object)
        for x in _unpacked(batches, wide):
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, wide), pa.int32()), pa.array([str(v) for v in (n, *total.tolist())])],
            names=["dimension", "s"])

    sums = (blocks.mapInArrow(partial, "dimension int, s string")
            .groupBy("dimension").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    found = {r["dimension"]: int(r["s"]) for r in sums}
    return found.get(-1, 0), [found.get(i, 0) for i in range(wide)]


def _centred(x: np.ndarray, n: int, low: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S / n: the whole part of the mean goes in whole numbers."""
    return (x - low).astype(float) - rest / n


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis.T @ (basis @ v)
    return v


def _bidiagonal(step: Callable[[np.ndarray, np.ndarray], np.ndarray], wide: int, want: int,
                total: float) -> np.ndarray:
    """Right singular vectors (rows, by falling singular value) of the matrix
    that ``step(g, W)`` multiplies: it returns |Xg|^2, X'Xg and (Xg)'XW."""
    draw = np.random.default_rng(0)
    tiny = NOTHING * math.sqrt(total)

    def fresh(basis):
        v = _orthogonal(draw.standard_normal(wide), basis)
        return v / np.linalg.norm(v)

    right, left, across = np.empty((0, wide)), np.empty((0, wide)), np.empty((0, wide))
    matrix = np.zeros((wide, wide + 1))
    v, beta = fresh(right), 0.0
    for k in range(wide):
        right = np.vstack([right, v])
        g = v - beta * left[-1] if k else v
        got = step(g, left)
        square, back, products = got[0], got[1:1 + wide], got[1 + wide:]
        if len(left):  # the left vector, against all earlier ones
            g = g - left.T @ products
            back = back - across.T @ products
            square = square - products @ products
        alpha = math.sqrt(max(square, 0.0))
        if alpha <= tiny:  # nothing along v
            left, across = np.vstack([left, np.zeros(wide)]), np.vstack([across, np.zeros(wide)])
            alpha, z = 0.0, np.zeros(wide)
        else:
            left, across = np.vstack([left, g / alpha]), np.vstack([across, back / alpha])
            z = _orthogonal(back / alpha - alpha * v, right)
        matrix[k, k] = alpha
        beta = float(np.linalg.norm(z))
        if k + 1 == wide:
            break
        if beta <= tiny:
            beta, v = 0.0, fresh(right)
        else:
            v = _orthogonal(z / beta, right)
            v /= np.linalg.norm(v)
        matrix[k, k + 1] = beta
        if k + 1 > want:
            p, s, _ = np.linalg.svd(matrix[:k + 1, :k + 1])
            gaps = np.abs(np.diff(s[:want + 1]))
            gap = np.minimum(gaps, np.append(np.inf, gaps[:-1]))
            unmet = math.sqrt(max(total - float((matrix[:k + 1, :k + 1] ** 2).sum()), 0.0) + 1e-12 * total)
            if (beta * np.abs(p[-1, :want]) <= CONVERGED * gap).all() and s[want] + unmet < s[want - 1]:
                break
    k = len(right)
    _, _, q = np.linalg.svd(matrix[:k, :k])
    vectors = q @ right
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit(rows: DataFrame, wide: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``rows`` (from ``prepare``);
    None where there is nothing to fit."""
    if wide == 0:
        return None
    blocks = S.materialised(rows.select("x").distinct().mapInArrow(lambda it: _packed(it, wide), "rows binary"),
                            "whitening-rows")
    n, sums = _exact_sums(blocks, wide)
    if n == 0:
        return None
    low = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], float)
    tasks = blocks.rdd.getNumPartitions()

    def centred(x):
        return _centred(x, n, low, rest)

    total = float(_pass(blocks, wide, tasks, lambda x: np.array([(centred(x) ** 2).sum()]))[0])
    if total <= 0:
        return None

    def step(g, left):
        def part(x):
            y = centred(x)
            u = y @ g
            return np.concatenate([[u @ u], y.T @ u, (y @ left.T).T @ u])
        return _pass(blocks, wide, tasks, part)

    vectors = _bidiagonal(step, wide, min(components, wide), total)[:components]
    m = len(vectors)

    def moments(x):
        w = centred(x) @ vectors.T
        return np.concatenate([w.sum(axis=0), (w.T @ w).reshape(-1)])

    got = _pass(blocks, wide, tasks, moments)
    mean, second = got[:m] / n, got[m:].reshape(m, m) / n
    covariance = second - np.outer(mean, mean)
    order = np.argsort(-np.diag(covariance), kind="stable")
    order = order[np.diag(covariance)[order] > (NOTHING ** 2) * total / n * 1e4]
    vectors, covariance = vectors[order], covariance[np.ix_(order, order)]
    variances = np.diag(covariance).copy()
    if not len(variances):
        return None
    root = np.sqrt(variances)
    error = float(np.abs(covariance / np.outer(root, root) - np.eye(len(root))).max())
    S.forget(blocks)
    return Whitening(n, sums, vectors, variances, total / n, error)


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Exact sum of (n * x - S)^2 per row, null beyond a long."""
    largest = float(np.abs(y).max(initial=0)) * n + n
    if largest ** 2 * y.shape[1] < 2.0 ** 62:
        return pa.array(((y * n - np.array(rest, np.int64)) ** 2).sum(axis=1))
    exact = ((y.astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1).tolist()
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(rows: DataFrame, wide: int, model: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error
    for every row of ``rows`` (from ``prepare``) and component."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, m = model.n, len(model.variances)
    low = np.array([s // n for s in model.sums], np.int64)
    rest = [s % n for s in model.sums]
    scaled = model.components / np.sqrt(model.variances)[:, None]
    explained = model.variances / model.trace
    error = model.identity_error

    def project(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                ids, x = batch.column(0).slice(k, 4096), _matrix(batch.column(1).slice(k, 4096), wide)
                y, many = x - low, len(x)
                white = (y.astype(float) - np.array(rest, float) / n) @ scaled.T
                row = pa.array(np.repeat(np.arange(many), m))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), many)),
                     pa.array(np.full(many * m, n, np.int64)), pc.take(_deviations(y, n, rest), row),
                     pa.array(white.reshape(-1)), pa.array(np.tile(explained, many)),
                     pa.array(np.full(many * m, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(project, schema)
