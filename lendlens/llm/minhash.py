"""Near-duplicate documents by one-permutation MinHash.

A document's set are the hashes of its different 5-word shingles. The hash
range is cut into ``BANDS * ROWS`` bins; the signature holds each bin's
smallest hash. An empty bin borrows the value of a filled one by optimal
densification: its own sequence of pseudo-random bins, the same for every
document, is followed until a filled bin is met. Bands of the signature are
bucket keys.

Equal sets are one class from the start (found by a 128-bit fingerprint), so
exact copies never meet in a bucket. Inside a bucket candidates are stars: every
class is compared with the hub (the member that meets most others in buckets),
which bounds the pairs by the members.

Two members of a star that both link with its hub are in one component. A link
of a member x that doesn't reach the hub is found from differences: let D be a
member's symmetric difference with the hub's set. As |x^y| = |D_x| + |D_y| -
2 |D_x & D_y|, and D_x is larger than a link to the hub allows, x can only link
with members whose D shares more than a known number of elements with D_x. So
those D are indexed by their rarest elements (prefix filter, with the
positional bound), which finds every such link without comparing all members
of the star. Links are confirmed on the full sets; a pair that shares a bucket
is never lost.

Defined cases: null, empty and blank texts have the empty set and link with
nothing; fewer than five words are one shingle; rows with equal texts are one
class, kept by the smallest id; rows that repeat an id get a row each, and where
their texts differ each has its text's own links; a null id is its own component (null) and kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _bytes as B
from . import _graph as G
from . import _shared as S

SHINGLE = 5
THRESHOLD_PERCENT = 85
BANDS, ROWS = 24, 6

_BITS = 54  # bits of a shingle hash; the others number the documents of a block
_DOCS = 1 << (64 - _BITS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, shingle: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different shingle hashes of all texts, first index of each text)."""
    _, _, hashes, first = B.words(data, offsets, codes)
    position, text = B.within(first, shingle)
    values = B.grams(hashes, shingle)[position]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    if len(short):
        own = np.array([B.grams(hashes[first[i]:first[i + 1]], counts[i])[0] for i in short], np.uint64)
        # a short text is one shingle of its own length
        values = np.concatenate([values, B.mix(own + counts[short].astype(np.uint64))])
        text = np.concatenate([text, short])
    key = (text.astype(np.uint64) << np.uint64(_BITS)) | (values >> np.uint64(64 - _BITS))
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    edges = np.arange(len(offsets), dtype=np.uint64) << np.uint64(_BITS)
    starts = np.searchsorted(key, edges[:-1])
    return key & np.uint64((1 << _BITS) - 1), np.append(starts, len(key))


def _small_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b, data, offsets in B.blocks(column):
        for k in range(a, b, _DOCS):
            end = min(b, k + _DOCS)
            own = offsets[k - a:end - a + 1]
            yield k, end, data[own[0]:own[-1]], own - own[0]


def signatures(values: np.ndarray, first: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation signatures of the texts with a set: (texts, matrix)."""
    counts = np.diff(first)
    texts = np.flatnonzero(counts)
    row = np.repeat(np.arange(len(texts)), counts[texts])
    cell = row * bins + ((values * np.uint64(bins)) >> np.uint64(_BITS)).astype(np.int64)
    lead = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else []
    matrix = np.zeros(len(texts) * bins, np.uint64)
    filled = np.zeros(len(texts) * bins, bool)
    matrix[cell[lead]] = values[lead]
    filled[cell[lead]] = True
    empty = np.flatnonzero(~filled)
    attempt = 0
    while len(empty):
        attempt += 1
        bin_, base = empty % bins, empty - empty % bins
        probe = B.mix(bin_.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt))
        source = base + (probe % np.uint64(bins)).astype(np.int64)
        hit = filled[source]  # only bins filled from the start lend their value
        matrix[empty[hit]] = matrix[source[hit]]
        empty = empty[~hit]
    return texts, matrix.reshape(len(texts), bins)


_SIGNED = "doc_id long, text_key long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def _sign(batches, shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    codes = B.table(B.SPACE, lower=True)
    for batch in batches:
        for a, b, data, offsets in _small_blocks(batch.column(2)):
            values, first = shingle_sets(data, offsets, codes, shingle)
            counts = np.diff(first)
            texts, matrix = signatures(values, first, bands * rows)
            prints = []
            for salt in (0x51ED270B, 0xC2B2AE3D27D4EB4F):
                sums = np.append(np.uint64(0), np.cumsum(B.mix(values + np.uint64(salt)), dtype=np.uint64))
                prints.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
            cut = matrix.reshape(len(texts), bands, rows)
            keys = np.zeros((len(texts), bands), np.uint64)
            for r in range(rows):
                keys = B.mix(keys * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, r])
            keys = B.mix(keys + np.arange(bands, dtype=np.uint64))
            ends = np.zeros(b - a + 1, np.int32)
            ends[texts + 1] = bands
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)),
                                             pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(counts.astype(np.int64)),
                 pa.array(prints[0]), pa.array(prints[1]), lists],
                names=["doc_id", "text_key", "n_shingles", "fp1", "fp2", "bands"])


def _sets(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    codes = B.table(B.SPACE, lower=True)
    for batch in batches:
        for a, b, data, offsets in _small_blocks(batch.column(1)):
            values, first = shingle_sets(data, offsets, codes, shingle)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)),
                                             pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists],
                                             names=["rep", "set"])


def _linked(both: Column, x: Column, y: Column, percent: int) -> Column:
    return both * 100 >= (x + y - both) * percent


def _with_sets(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    """Both sets of each pair. Pairs and sets grow with the input, so neither
    is broadcast: the plan is the same at every size."""
    return (pairs.join(sets.select(F.col("rep").alias(a), F.col("set").alias("set_a")).hint("merge"), a)
            .join(sets.select(F.col("rep").alias(b), F.col("set").alias("set_b")).hint("merge"), b))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with whether their full sets reach the threshold."""
    both = F.size(F.array_intersect("set_a", "set_b"))
    return _with_sets(pairs, sets, "a", "b").select(
        *pairs.columns, _linked(both, F.size("set_a"), F.size("set_b"), percent).alias("linked"))


def _past_the_hub(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of a star, of different components and not both
    linked with the hub, whose differences to the hub share an indexed element.

    stars: a (hub), b (member), linked, component (of the member).
    """
    p = percent
    size = F.col("missing") + F.col("added")
    # least shared elements of D with any partner: for a member that misses the
    # hub (role x), and for a partner y of such a member
    need_x = F.greatest(F.lit(1), F.ceil((size * (100 + p) - (100 - p) * (F.col("n") + F.col("hub_n")))
                                         / (2 * (100 + p))))
    need_y = F.floor((100 * F.col("missing") + p * F.col("added")) / (100 + p)) + 1
    differing = _with_sets(stars, sets, "a", "b").select(
        F.col("a").alias("hub"), "b", "linked", "component",
        F.size("set_a").alias("hub_n"), F.size("set_b").alias("n"),
        F.array_except("set_a", "set_b").alias("gone"), F.array_except("set_b", "set_a").alias("new"))
    elements = S.materialised(differing.select(
        "hub", "b", "linked", "component", "hub_n", "n", F.size("gone").alias("missing"),
        F.size("new").alias("added"), F.explode(F.concat("gone", "new")).alias("e")), "minhash-differences")
    common = elements.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("often"))
    # rarest first; what only one member has is placed too, but can't be shared
    order = Window.partitionBy("hub", "b").orderBy("often", "e")
    placed = (elements.join(common, ["hub", "e"]).withColumn("place", F.row_number().over(order))
              .where("often > 1").withColumns({"d": size, "last_x": size - need_x + 1, "last_y": size - need_y + 1}))
    placed = S.materialised(placed.where("place <= greatest(last_x, last_y)"), "minhash-differences")
    x = placed.where(~F.col("linked") & (F.col("place") <= F.col("last_x"))).alias("x")
    y = placed.where(F.col("place") <= F.col("last_y")).alias("y")
    reach = 1 + F.least(F.col("x.d") - F.col("x.place"), F.col("y.d") - F.col("y.place"))
    needed = ((F.col("x.d") + F.col("y.d")) * (100 + p) - (100 - p) * (F.col("x.n") + F.col("y.n")))
    return (x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.e") == F.col("y.e"))
                   & (F.col("x.component") != F.col("y.component")) & (reach * 2 * (100 + p) >= needed))
            .select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = THRESHOLD_PERCENT, shingle: int = SHINGLE,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``df``."""
    return (near_duplicate_classes(df, id_col, text_col, percent, shingle, bands, rows)
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def text_key(text: Column) -> Column:
    """Tells the texts of rows that repeat an id apart."""
    return F.xxhash64(text)


def _numbered(classes: DataFrame) -> DataFrame:
    """``classes`` with a ``node`` of each: the smallest id in it, or where that
    is another class's too (a repeated id with different texts) a number of its own."""
    shared = (classes.groupBy("rep").agg(F.count(F.lit(1)).alias("often"),
                                         F.min(F.struct("fp1", "fp2")).alias("named")).where("often > 1"))
    placed = classes.join(shared.drop("often"), "rep", "left")
    own = F.coalesce(F.struct("fp1", "fp2") == F.col("named"), F.lit(True))
    placed = S.materialised(placed.withColumn("node", F.when(own, F.col("rep"))).drop("named"), "minhash-classes")
    # numbers are fixed by being written; ids as high as these don't occur
    others = S.materialised(placed.where("node is null").withColumn(
        "node", F.lit((1 << 63) - 1) - F.monotonically_increasing_id()), "minhash-classes")
    return placed.where("node is not null").unionByName(others)


def near_duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           percent: int = THRESHOLD_PERCENT, shingle: int = SHINGLE,
                           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and lead for every row of
    ``df``: whether it is the first row (by id, then text_key) of its component."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                     F.col(text_col).alias("text"))
    signed = S.materialised(docs.mapInArrow(lambda it: _sign(it, shingle, bands, rows), _SIGNED),
                            "minhash-signatures")
    classes = _numbered(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("fp1", "fp2")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        .select("fp1", "fp2", F.col("first.doc_id").alias("rep"), F.col("first.text_key").alias("rep_key")))
    first = classes.select("fp1", "fp2", F.col("rep").alias("doc_id"), F.col("rep_key").alias("text_key"), "node")
    leads = (signed.where("n_shingles > 0").join(first, ["fp1", "fp2", "doc_id", "text_key"])
             .select(F.col("node").alias("rep"), "bands").distinct())
    banded = leads.select(F.explode("bands").alias("bucket"), "rep")
    shared = S.materialised(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
                            .where("size > 1"), "minhash-buckets")
    members = S.materialised(banded.join(shared, "bucket"), "minhash-members")
    met = members.groupBy("rep").agg(F.sum(F.col("size") - 1).alias("met"))
    hubs = (members.join(met, "rep").groupBy("bucket")
            .agg(F.max(F.struct("met", (-F.col("rep")).alias("rep"))).alias("h"))
            .select("bucket", (-F.col("h.rep")).alias("a")))
    sets = S.materialised(
        docs.join(first.join(met.select(F.col("rep").alias("node")), "node").hint("merge"), ["doc_id", "text_key"])
        .select(F.col("node").alias("rep"), "text")
        .mapInArrow(lambda it: _sets(it, shingle), "rep long, set array<long>")
        .dropDuplicates(["rep"]), "minhash-sets")
    stars = (members.join(hubs, "bucket").where(F.col("rep") != F.col("a"))
             .select("a", F.col("rep").alias("b")).distinct())
    stars = S.materialised(_confirm(stars, sets, percent), "minhash-stars")
    linked = stars.where("linked").select("a", "b")
    found = G.components(linked)

    named = found.select(F.col("node").alias("b"), "component")
    placed = stars.join(named, "b", "left").withColumn("component", F.coalesce("component", "b"))
    # stars whose members aren't all of one component yet
    apart = (placed.groupBy("a").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("a"))
    further = S.materialised(
        _confirm(_past_the_hub(placed.join(apart, "a"), sets, percent), sets, percent), "minhash-further")
    if not further.where("linked").isEmpty():
        found = G.components(linked.unionByName(further.where("linked").select("a", "b")))
    # a component is named by its smallest id, and led by that id's text
    members = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    leaders = members.groupBy("component").agg(F.min(F.struct("rep", "rep_key")).alias("leader"))
    named = (members.select("fp1", "fp2", "component").join(leaders, "component")
             .select("fp1", "fp2", F.col("leader.rep").alias("leader_id"), F.col("leader.rep_key").alias("leader_key")))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return (signed.drop("bands").join(named, ["fp1", "fp2"], "left")
            .select("doc_id", "text_key", "n_shingles",
                    F.when(linked, F.col("leader_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    (~linked | (F.col("leader_id") == F.col("doc_id")) & (F.col("leader_key") == F.col("text_key")))
                    .alias("lead")))
