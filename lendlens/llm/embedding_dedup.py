"""Near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are a pseudo-random choice among the vectors, one
for every ``VECTORS_PER_PIVOT`` vectors and at most ``MAX_PIVOTS``. Vectors and
pivots are taken relative to the sample's mean, so that vectors in a narrow cone
are told apart; pivots at a cosine of ``SPREAD`` or more to another are dropped,
so a dense group, however large, has few pivots inside itself and its members
share them. A vector is described by its ``LONGEST`` nearest pivots in order.

Inverted lists hold, for each label and pivot, the vectors with that pivot among
their first m. Within a list, the pivots that two vectors share among their
first m are counted; pairs that share at least s are candidates, and their
cosine is verified in double precision. How far down the order one must look
depends on the data, so m and s are fitted: ``PROBES`` vectors are compared with
all of their label, and of all (m, s) whose candidates hold ``RECALL`` of the
true links the one with the fewest candidates is taken.

A list is cut into blocks of about ``BLOCK`` vectors, and each pair of blocks is
a group of its own, so no list is one task. A pair is counted in the list of the
smallest pivot it shares. Pairs never leave the task: a group gives each vector's
number of links and a spanning forest of them, at most two rows a vector.

Equal vectors of a label are one class from the start and never meet in a
list, so a vector that a third of all rows repeat costs one entry.

Every vector is indexed; only the pivots are a bounded sample. With the
defaults the measured recall against brute force is in the README.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, vectors without label and rows without id link with nothing and are
kept; vectors of different lengths never link; rows that repeat an id count as
vectors of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _graph as G
from . import _shared as S

THRESHOLD = 0.93
VECTORS_PER_PIVOT = 20
MIN_PIVOTS, MAX_PIVOTS = 64, 8192
SPREAD = 0.85
BLOCK = 4096
LONGEST = 64                        # pivots in a vector's description
PREFIXES = (8, 12, 16, 24, 32, 48, 64)  # m
COUNTS = (1, 2, 3, 4)               # s
PROBES, RECALL = 256, 0.999
DENSE = 0.05                        # share of candidates from which all cosines of a block are taken


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _spread(points: np.ndarray, near: float) -> np.ndarray:
    """The points that are not near an earlier kept one."""
    kept, n = np.empty_like(points), 0
    for k in range(0, len(points), 256):
        part = points[k:k + 256]
        part = part[(part @ kept[:n].T < near).all(axis=1)]
        own = part @ part.T < near
        good = np.ones(len(part), bool)
        for i in range(len(part)):
            if good[i]:
                good[i + 1:] &= own[i, i + 1:]
        part = part[good]
        kept[n:n + len(part)] = part
        n += len(part)
    return kept[:n]


def _sample(classes: DataFrame, wanted: int, salt: int, n: int, *columns: str) -> list:
    """A fixed pseudo-random choice of ``wanted`` classes."""
    # thinned by hash to about twice the wanted number in all, so that what
    # tasks send on is bounded whatever their number
    part = min(1 << 32, 2 * (wanted + 100) * (1 << 32) // max(n, 1))
    return (classes.select(F.xxhash64("rep", F.lit(salt)).alias("h"), "rep", *columns)
            .where(F.pmod("h", F.lit(1 << 32)) < part).orderBy("h", "rep").limit(wanted).collect())


def _pivots(classes: DataFrame, most: int, per_pivot: int, spread: float, n: int) -> dict[int, tuple]:
    """(mean, unit reference vectors relative to it) of every vector length: a
    bounded sample, spread out."""
    by_size: dict[int, list] = {}
    for r in _sample(classes, min(most, max(MIN_PIVOTS, -(-n // per_pivot))), 0, n, "vector"):
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    out = {}
    for k, v in by_size.items():
        x = _unit(np.array(v, float))
        mean = x.mean(axis=0) if len(x) > 1 else np.zeros(k)
        out[k] = mean, _spread(_relative(x, mean), spread)
    return out


def _relative(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Unit vectors as seen from the mean."""
    y = x - mean
    return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return _unit(vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size))


def _describe(batches, pivots: dict[int, tuple], longest: int) -> Iterator[pa.RecordBatch]:
    """Each (rep, label, n, vector) with its size and nearest pivots in order."""
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            sizes = pc.list_value_length(part.column(3)).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = part.filter(pa.array(sizes == size))
                if size not in pivots:  # no reference of this length: one list for all of it
                    best = np.zeros((own.num_rows, 1), np.int64)
                else:
                    mean, points = pivots[size]
                    near = _relative(_matrix(own.column(3), size), mean) @ points.T
                    m = min(longest, near.shape[1])
                    best = np.argpartition(-near, m - 1, axis=1)[:, :m]
                    order = np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable")
                    best = np.take_along_axis(best, order, 1)
                offsets = np.arange(own.num_rows + 1, dtype=np.int32) * best.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(own.num_rows, size, np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(best.reshape(-1).astype(np.int32)))],
                    names=["rep", "label", "n", "vector", "size", "pivots"])


def _measure(described: DataFrame, threshold: float, n: int) -> tuple[int, int]:
    """(m, s): the cheapest that finds ``RECALL`` of the probes' true links."""
    probes = _sample(described, PROBES, 1, n, "label", "size", "vector", "pivots")
    groups: dict[tuple, list] = {}
    for r in probes:
        groups.setdefault((r["label"], r["size"]), []).append(r)
    of = {key: (np.array([r["rep"] for r in rows]), _unit(np.array([r["vector"] for r in rows], float)),
                np.array([r["pivots"] for r in rows])) for key, rows in groups.items() if key[1]}
    wide = len(PREFIXES) * len(COUNTS)

    def compare(batches):
        total = np.zeros(1 + 2 * wide, np.int64)  # links, links found, candidates
        for batch in batches:
            label, size = (batch.column(c).to_numpy() for c in ("label", "size"))
            for key, (reps, x, orders) in of.items():
                own = batch.filter(pa.array((label == key[0]) & (size == key[1])))
                for k in range(0, own.num_rows, 1024):
                    part = own.slice(k, 1024)
                    others = part.column("rep").to_numpy()[:, None] != reps
                    linked = (_matrix(part.column("vector"), key[1]) @ x.T >= threshold) & others
                    total[0] += linked.sum()
                    theirs = part.column("pivots").flatten().to_numpy().reshape(part.num_rows, -1)
                    for i, m in enumerate(PREFIXES):
                        names = np.unique(orders[:, :m])
                        shared = _marks(theirs[:, :m], names) @ _marks(orders[:, :m], names).T
                        for j, s in enumerate(COUNTS):
                            found = (shared >= min(s, theirs.shape[1])) & others
                            total[1 + i * len(COUNTS) + j] += (found & linked).sum()
                            total[1 + wide + i * len(COUNTS) + j] += found.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                         names=["what", "many"])

    rows = described.mapInArrow(compare, "what int, many long").groupBy("what").agg(F.sum("many").alias("many"))
    total = np.zeros(1 + 2 * wide, np.int64)
    for r in rows.collect():
        total[r["what"]] = r["many"]
    choices = [(m, s) for m in PREFIXES for s in COUNTS]
    good = [(int(total[1 + wide + i]), choices[i]) for i in range(wide) if total[1 + i] >= RECALL * total[0]]
    if total[0] == 0:  # no probe has a link: what finds copies
        return PREFIXES[1], 1
    return min(good)[1] if good else (PREFIXES[-1], 1)


_CELL = ["label", "size", "pivot", "i", "j"]


def _groups(batches) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of one cell after the other; batches come sorted by cell."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in _CELL])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            now = tuple(keys[a].tolist())
            if now != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = now
            parts.append(batch.slice(a, b - a))
    if parts:
        yield key, pa.Table.from_batches(parts)


def _marks(pivots: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Row by row, which of the sorted pivots ``of`` are among ``pivots``."""
    at = np.minimum(np.searchsorted(of, pivots), len(of) - 1)
    out = np.zeros((len(pivots), len(of)), np.float32)
    row, column = np.nonzero(of[at] == pivots)
    out[row, at[row, column]] = 1
    return out


def _forest(u: np.ndarray, v: np.ndarray, linked: np.ndarray, tree: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links (one of u, one of v) that join what ``tree`` (changed) holds apart."""
    for i, row in zip(u.tolist(), linked):
        others = v[row]
        trees, first = np.unique(tree[others], return_index=True)
        new = trees != tree[i]
        if new.any():
            yield from ((i, j) for j in others[first[new]].tolist())
            tree[np.isin(tree, trees[new])] = tree[i]


def _cell(key: tuple, rows: pa.Table, threshold: float, prefix: int, shared: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(rep, number of linked rows, edges as positions) of two blocks of a list."""
    _, size, pivot, i, j = key
    rep, n, block = (rows.column(c).to_numpy() for c in ("rep", "n", "block"))
    x = _matrix(pa.concat_arrays(rows.column("vector").chunks), size)
    pivots = pa.concat_arrays(rows.column("pivots").chunks).flatten().to_numpy().reshape(len(rep), -1)[:, :prefix]
    shared = min(shared, pivots.shape[1])  # a length of few vectors has few pivots
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    counts, tree, edges = np.zeros(len(rep)), np.arange(len(rep)), []
    common = np.intersect1d(pivots[left], pivots[right])
    earlier = int(np.searchsorted(common, pivot))
    marks = _marks(pivots, common)
    for k in range(0, len(left), 512):
        u = left[k:k + 512]
        # pairs that share an earlier pivot are another list's
        found = marks[u][:, earlier:] @ marks[right][:, earlier:].T >= shared
        if earlier:
            found &= marks[u][:, :earlier] @ marks[right][:, :earlier].T == 0
        if i == j:
            found &= rep[u][:, None] < rep[right]
        if found.mean() >= DENSE:
            linked = found & (x[u] @ x[right].T >= threshold)
        else:
            a, b = np.nonzero(found)
            good = np.empty(len(a), bool)
            for at in range(0, len(a), 1 << 16):
                some = slice(at, at + (1 << 16))
                good[some] = np.einsum("ij,ij->i", x[u[a[some]]], x[right[b[some]]]) >= threshold
            linked = np.zeros(found.shape, bool)
            linked[a[good], b[good]] = True
        v = right[linked.any(axis=0)]
        u, linked = u[linked.any(axis=1)], linked[linked.any(axis=1)][:, linked.any(axis=0)]
        if not len(u):
            continue
        weights = linked.astype(float)
        counts[u] += weights @ n[v]
        counts[v] += n[u] @ weights
        edges += _forest(u, v, linked, tree)
    return rep, counts.astype(np.int64), edges


def _cells(batches, threshold: float, prefix: int, shared: int) -> Iterator[pa.RecordBatch]:
    for key, rows in _groups(batches):
        if rows.num_rows < 2:
            continue
        rep, counts, edges = _cell(key, rows, threshold, prefix, shared)
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        ends = np.append(np.full(len(some), -1), rep[b])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(rep[some], rep[a])), pa.array(ends, mask=np.arange(len(ends)) < len(some)),
             pa.array(np.append(counts[some], np.zeros(len(a), np.int64)))], names=["a", "b", "others"])


def links(classes: DataFrame, threshold: float = THRESHOLD, max_pivots: int = MAX_PIVOTS,
          per_pivot: int = VECTORS_PER_PIVOT, spread: float = SPREAD, block: int = BLOCK,
          prefix: int | None = None, shared: int = 1) -> DataFrame:
    """(a, b, others) of classes (rep, label, vector, n) found similar: parts of
    the number of rows that ``a`` links with (``b`` is null), and links that
    connect what links connect. ``prefix`` and ``shared`` are fitted unless given."""
    n = classes.count()
    pivots = _pivots(classes, max_pivots, per_pivot, spread, n)
    classes = classes.select("rep", "label", "n", "vector")
    vector = classes.schema["vector"].dataType.simpleString()
    described = S.materialised(
        classes.mapInArrow(lambda it: _describe(it, pivots, LONGEST),
                           f"rep long, label long, n long, vector {vector}, size int, pivots array<int>"),
        "pivot-orders")
    if prefix is None:
        prefix, shared = _measure(described, threshold, n)
    entries = (described.withColumn("pivots", F.slice("pivots", 1, prefix))
               .withColumn("pivot", F.explode("pivots")))
    long = S.materialised(entries.groupBy("label", "size", "pivot").agg(F.count(F.lit(1)).alias("blocks"))
                          .where(F.col("blocks") > block)
                          .withColumn("blocks", F.ceil(F.col("blocks") / block).cast("int")), "long-lists")
    blocks = F.coalesce("blocks", F.lit(1))
    cells = (entries.join(long, ["label", "size", "pivot"], "left")
             .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("label", "size", "pivot", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j"), "block", "rep", "n", "vector", "pivots")
             .repartition(*_CELL).sortWithinPartitions(*_CELL))
    return cells.mapInArrow(lambda it: _cells(it, threshold, prefix, shared), "a long, b long, others long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", **options) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df``."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                     F.col(vector_col).alias("vector"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector"))
    rows = rows.select("vec_id", "label", "vector", usable.alias("usable"),
                       F.xxhash64("label", "vector").alias("h1"),
                       F.xxhash64(F.lit(1), "vector", "label").alias("h2"))
    grouped = (rows.where("usable").groupBy("h1", "h2")
               .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    grouped = S.materialised(grouped, "vector-classes")
    lead = rows.where("usable").select(F.col("vec_id").alias("rep"), "h1", "h2", "label", "vector")
    classes = S.materialised(lead.join(grouped, ["h1", "h2", "rep"])
                             .dropDuplicates(["rep", "h1", "h2"]).select("rep", "label", "vector", "n"),
                             "vector-classes")
    found = S.materialised(links(classes, **options), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("others").alias("others"))
    component = G.components(found.where("b is not null")).withColumnRenamed("node", "rep")
    described = (grouped.join(counts, "rep", "left").join(component, "rep", "left")
                 .select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component")))
    own = F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "usable", F.when(F.col("usable"), F.col("h1")).alias("h1"), "h2")
            .join(described, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept")))
