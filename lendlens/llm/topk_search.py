"""Exact top-k inner-product search, term at a time.

Vectors become integers (``floor(scale * x)``), so every score is exact. The
queries are cut into blocks, the candidates too, and every pair of blocks is a
cell: a group of bounded size that Spark shuffles to a task. In a cell each
dimension is a term with its postings (the candidates whose component isn't 0,
and the components). A query is the sparse row of its components that aren't 0:
each of them scatters its weighted postings into one dense array of scores.
Partition selection takes the k best of the array; a window over the cells'
best, limited map-side, merges them. Nothing is skipped: every candidate of
every cell gets its whole score.

Bounds: a cell holds at most ``CELL`` components on either side, so a candidate
is sent once per block of queries and a query once per block of candidates; a
cell returns k rows a query. Blocks are dealt by a hash of the row's number,
never by id or vector, so repeated ids or vectors make no cell larger.

Defined cases: vectors that are null or hold null or non-finite components take
no part; empty and zero vectors do (every score is 0); vectors of different
lengths are compared as if the shorter went on with zeros; rows that repeat an
id are rows of their own, as queries and as candidates, and a query leaves out
only its own row; a row without id is a candidate (its ties come last); ties go
to the smaller id; components beyond 2**55 count as that; scores beyond a long
are given as the nearest long and ranked by the exact score; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as S

K = 5
SCALE = 256
CELL = 1 << 21        # components of a block of candidates or queries
LEAST_BLOCK = 1024    # candidates a block holds at least where the table is small
DENSE = 4             # postings of at least a quarter of a block are kept as a whole row
EXACT = float(1 << 53)
LIMIT = float(1 << 55)  # of components, so that exact scores fit 38 digits
LONG = np.iinfo(np.int64)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))),
                      F.lit(False))


def _sparse(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, dimension, component) of all components that aren't 0."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    dimension = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = values != 0
    return row[some], dimension[some], values[some]


def _size_of(values: np.ndarray) -> float:
    return float(np.abs(values.astype(float)).max()) if len(values) else 0.0


class Postings:
    """Terms of a block of candidates."""

    def __init__(self, lists: pa.ListArray):
        self.n = len(lists)
        self.row, self.dimension, self.value = _sparse(lists)
        self.largest = _size_of(self.value)
        self.of: dict[type, dict[int, tuple]] = {}

    def terms(self, kind: type) -> dict[int, tuple]:
        if kind not in self.of:
            order = np.argsort(self.dimension, kind="stable")
            names, first = np.unique(self.dimension[order], return_index=True)
            ends = np.append(first[1:], len(order))
            made = {}
            for name, a, b in zip(names.tolist(), first.tolist(), ends.tolist()):
                at, weights = self.row[order[a:b]], self.value[order[a:b]].astype(kind)
                if len(at) * DENSE >= self.n:
                    whole = np.zeros(self.n, kind)
                    whole[at] = weights
                    at, weights = slice(None), whole
                made[name] = at, weights
            self.of[kind] = made
        return self.of[kind]

    def scores(self, dimensions: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of all candidates for one sparse query."""
        # sums of whole numbers below 2**53 are exact in doubles, others are Python integers
        exact = _size_of(weights) * self.largest * max(len(weights), 1) < EXACT
        kind = float if exact else object
        out, terms = np.zeros(self.n, kind), self.terms(kind)
        for dimension, weight in zip(dimensions.tolist(), weights.tolist()):
            found = terms.get(dimension)
            if found is not None:
                out[found[0]] += found[1] * weight
        return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores; of equal ones the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.append(above, np.flatnonzero(scores == least)[:k - len(above)])


def _long(score) -> int:
    return min(max(int(score), LONG.min), LONG.max)


def _cell(rows: pa.Table, k: int) -> pa.RecordBatch:
    """The k best candidates of a cell for each of its queries."""
    of_query = rows.column("of_query").to_numpy()
    queries, candidates = (rows.filter(pa.array(of_query == x)) for x in (True, False))
    vectors = [pa.concat_arrays(t.column("vector").chunks or [pa.array([], pa.list_(pa.int64()))])
               for t in (candidates, queries)]
    postings = Postings(vectors[0])
    row, dimension, weight = _sparse(vectors[1])
    first = np.searchsorted(row, np.arange(queries.num_rows + 1))
    at = {r: i for i, r in enumerate(candidates.column("row").to_pylist())}
    picked, owner, values, order = [], [], [], []
    for q, number in enumerate(queries.column("row").to_pylist()):
        scores = postings.scores(dimension[first[q]:first[q + 1]], weight[first[q]:first[q + 1]])
        own = at.get(number)
        best = _best(scores, k if own is None else k + 1)
        best = best[best != own] if own is not None else best
        if own is not None and len(best) > k:
            # the row itself wasn't among the best: the last of them goes
            best = np.array(sorted(best.tolist(), key=lambda i: (-scores[i], i))[:k])
        picked.append(best)
        owner.append(np.full(len(best), q))
        values += [_long(s) for s in scores[best].tolist()]
        # ranked by the exact score, which may lie beyond a long
        order += [str(int(s)) for s in scores[best].tolist()]
    none = [np.empty(0, np.int64)]
    picked, owner = (pa.array(np.concatenate(x or none).astype(np.int64)) for x in (picked, owner))
    queries, candidates = queries.take(owner), candidates.take(picked)
    return pa.RecordBatch.from_arrays(
        [_flat(queries, "row"), _flat(queries, "vec_id"), _flat(candidates, "vec_id"),
         pa.array(values, pa.int64()), pa.array(order, pa.string())],
        names=["query_row", "query_id", "vec_id", "score", "exact"])


def _flat(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def _cells(batches, k: int) -> Iterator[pa.RecordBatch]:
    """Cell after cell; rows come sorted by cell."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("i", "j")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            now = tuple(keys[a].tolist())
            if now != key and parts:
                yield _cell(pa.Table.from_batches(parts), k)
                parts = []
            key = now
            parts.append(batch.slice(a, b - a))
    if parts:
        yield _cell(pa.Table.from_batches(parts), k)


def search(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = SCALE, cell: int = CELL) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of ``df`` for
    each row that ``is_query`` (a condition on ``df``) picks."""
    if k <= 0:
        raise ValueError("k must be positive")
    spark = df.sparkSession
    vector, limit = F.col(vector_col), F.lit(LIMIT)
    rows = df.where(finite(vector)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -limit), limit))
                    .cast("long")).alias("vector"))
    # row numbers are fixed by being written
    rows = S.materialised(rows.withColumn("row", F.monotonically_increasing_id()), "search-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking"),
                    F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("wide")).first()
    most = max(1, cell // max(size["wide"], 1))
    # as many blocks of candidates as the session has partitions, where they don't get too small
    blocks = max(-(-size["n"] // most), min(S.partitions(spark), -(-size["n"] // LEAST_BLOCK)), 1)
    asking = max(-(-size["asking"] // most), 1)

    def block(parts: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    columns = ["i", "j", "of_query", "row", "vec_id", "vector"]
    candidates = rows.withColumn("j", every(asking)).withColumn("i", block(blocks))
    queries = rows.where("asks").withColumn("i", every(blocks)).withColumn("j", block(asking))
    cells = (candidates.withColumn("of_query", F.lit(False)).select(*columns)
             .unionByName(queries.withColumn("of_query", F.lit(True)).select(*columns))
             .repartition("i", "j")
             .sortWithinPartitions("i", "j", "of_query", F.col("vec_id").asc_nulls_last(), "row"))
    found = cells.mapInArrow(lambda it: _cells(it, k),
                             "query_row long, query_id long, vec_id long, score long, exact string")
    best = Window.partitionBy("query_row").orderBy(
        F.col("exact").cast("decimal(38,0)").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
