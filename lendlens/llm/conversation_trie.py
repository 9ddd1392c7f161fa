"""Prefix trie of conversations by sorted longest common prefixes.

Conversations that begin alike share nodes: a node is a distinct sequence of
first turns, and its members are one interval of the conversations sorted by
their sequences. Conversations are dealt to partitions by ranges of (sequence,
id), so a sequence that a third of all conversations share is spread by id. In
a partition, lengths of common prefixes of neighbours get a sparse table of
range minima; each candidate prefix looks for the left and right end of its
interval in it by binary search, without regard to any other, and every number
of a node follows from its interval: members by its width, the smallest id by
another sparse table, leaves and saved tokens by differences of running sums.

A node whose interval touches an end of its partition may go on in the next.
Such nodes are the prefixes of a partition's first and last conversation only;
their parts are added up by a digest of the prefix, corrected by the common
prefix of the neighbours across each border. A turn is stood for by the first 16
bytes of the SHA-256 of role and text, so texts are not shuffled or sorted.

Bounds: a task holds one range of conversations as their turns' keys. The ids of
the conversations that end at a node are hashed in ascending order; SHA-256
takes its input in sequence, so the ids of one sequence that runs over many
partitions stream through one task, in constant memory, as packed text.

Defined cases: rows without conv_id belong to no conversation; null roles and
texts are empty; turns of equal number are ordered by their key; repeated rows
are turns of their own; a conversation whose rebuilt form has no turns belongs to
the root; a table without conversations has no nodes, not even a root; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _shared as S

KEY = 16             # bytes a turn's key has
CHUNK = 1 << 20      # candidate prefixes searched at once
PACK = 1 << 18       # bytes of ids in one packed row


def turn_key() -> Column:
    """Hex key of a turn: no two (role, text) give the same input."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.substring(whole, 1, 2 * KEY)


def sequences(df: DataFrame, *by: Column) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, each (key, size);
    grouped by columns that follow from conv_id, too."""
    turns = df.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), *by,
        F.struct(F.col("turn").alias("turn"), turn_key().alias("key"),
                 F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size")).alias("t"))
    # structs sort null turns first
    ordered = F.array_sort(F.collect_list("t"))
    return turns.groupBy(*[c for c in turns.columns if c != "t"]).agg(
        F.transform(ordered, lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def rebuilt(df: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """``sequences`` where each conversation c starts with the first h turns of
    conversation c - c % group, h = crc32 of c's digits modulo ``heads``."""
    base, h = (F.col("conv_id") - F.col("conv_id") % group).cast("long").alias("base"), F.col("h")
    # one shuffle, by what a group of conversations shares, serves both steps
    turns = df.where("conv_id is not null").select("conv_id", "turn", "role", "text", base)
    own = sequences(turns.repartition("base"), F.col("base"))
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, heads - 1))).over(
        Window.partitionBy("base"))
    return (own.withColumn("head", first)
            .withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("int"))
            .select("conv_id", F.concat(
                F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0)),
                F.slice("turns", h + 1, F.size("turns") + 1)).alias("turns")))


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Range minima of every power of two: level k at i covers [i, i + 2**k)."""
    levels, width = [values], 1
    while 2 * width <= len(values):
        low = levels[-1]
        levels.append(np.minimum(low[:-width], low[width:]))
        width *= 2
    return levels


def _right_end(levels: list[np.ndarray], start: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row of each candidate's interval: ``levels[0][i]`` is the common
    prefix of rows i and i + 1."""
    at, n = start.copy(), len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        can = at + (1 << k) <= n
        go = np.zeros(len(at), bool)
        go[can] = levels[k][at[can]] >= depth[can]
        at[go] += 1 << k
    return at


def _left_end(levels: list[np.ndarray], start: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row of each candidate's interval."""
    at = start.copy()
    for k in range(len(levels) - 1, -1, -1):
        back = at - (1 << k)
        can = back >= 0
        go = np.zeros(len(at), bool)
        go[can] = levels[k][back[can]] >= depth[can]
        at[go] -= 1 << k
    return at


def _least(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum of each [left, right]."""
    out = np.empty(len(left), levels[0].dtype)
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    for k in np.unique(level).tolist():
        own = level == k
        out[own] = np.minimum(levels[k][left[own]], levels[k][right[own] - (1 << k) + 1])
    return out


def _common(keys: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Number of first turns that neighbours share."""
    out = np.zeros(max(len(keys) - 1, 0), np.int64)
    for i in range(len(out)):
        out[i] = _shared_turns(keys[i], keys[i + 1], int(min(sizes[i], sizes[i + 1])))
    return out


def _shared_turns(a: bytes, b: bytes, most: int) -> int:
    low, high = 0, most
    while low < high:  # the longest equal beginning, by halving
        middle = (low + high + 1) // 2
        if a[low * KEY:middle * KEY] == b[low * KEY:middle * KEY]:
            low = middle
        else:
            high = middle - 1
    return low


def _digests(key: bytes) -> list[bytes]:
    """Digest of every prefix of a sequence, the empty one first."""
    running, out = hashlib.sha256(), []
    out.append(running.digest()[:KEY])
    for i in range(0, len(key), KEY):
        running.update(key[i:i + KEY])
        out.append(running.copy().digest()[:KEY])
    return out


def _names(ids: np.ndarray) -> Iterator[bytes]:
    """Ids as packed text, comma-joined, in pieces of bounded size."""
    step = PACK // 21
    for k in range(0, len(ids), step):
        yield b",".join(str(i).encode() for i in ids[k:k + step].tolist())


_NODES = pa.schema([
    ("part", pa.int32()), ("kind", pa.string()), ("depth", pa.int64()), ("digest", pa.binary()),
    ("parent_digest", pa.binary()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("ends_sha256", pa.string()), ("at_start", pa.bool_()), ("at_end", pa.bool_()),
    ("chars", pa.list_(pa.int64())), ("first", pa.binary()), ("last", pa.binary()),
    ("piece", pa.int64()), ("ids", pa.binary())])
_SCHEMA = ("part int, kind string, depth long, digest binary, parent_digest binary, conv_id long, "
           "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends_sha256 string, "
           "at_start boolean, at_end boolean, chars array<long>, first binary, last binary, piece long, ids binary")


def _rows(**columns) -> pa.RecordBatch:
    """A batch of ``_NODES`` with nulls in the columns not named."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [(x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type)) if f.name in columns
         else pa.nulls(n, f.type) for f in _NODES], schema=_NODES)


def _nodes(batches) -> Iterator[pa.RecordBatch]:
    """Nodes of one range of conversations, sorted by (key, conv_id), and what
    its borders need."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    del tables
    part = table.column("part")[0].as_py()
    conv = table.column("conv_id").to_numpy()
    keys = table.column("key").to_pylist()
    size_lists = pa.concat_arrays(table.column("sizes").chunks)
    sizes = np.array([len(k) // KEY for k in keys], np.int64)
    m = len(conv)

    # characters of each row's first d turns: chars[base[i] + d]
    base = np.cumsum(sizes + 1) - (sizes + 1)
    chars = np.zeros(int((sizes + 1).sum()), np.int64)
    inside = np.ones(len(chars), bool)
    inside[base] = False
    flat = size_lists.flatten().to_numpy()
    chars[inside] = flat
    running = np.cumsum(chars)
    chars = running - np.repeat(running[base], sizes + 1)

    lcp = _common(keys, sizes)
    before = np.append(-1, lcp)                       # with the row before; nodes deeper than it start here
    levels, id_levels = _sparse(lcp), _sparse(conv)
    shared = np.where(before >= 0, chars[base + np.maximum(before, 0)], 0)
    shared_upto = np.append(0, np.cumsum(shared))
    ends = np.append(lcp < sizes[:-1], False)         # the last row's is known to the next partition
    ends_upto = np.append(0, np.cumsum(ends))

    counts = sizes - before                           # nodes that start at each row
    first_node = np.cumsum(counts) - counts
    total = int(counts.sum())
    children = np.zeros(total, np.int64)
    first_digests, last_digests = _digests(keys[0]), _digests(keys[-1])
    same = np.flatnonzero(np.append(True, (lcp < sizes[:-1]) | (sizes[1:] != sizes[:-1])))
    run_end = np.append(same[1:], m)                  # equal sequences are runs

    def chunks():
        row = 0
        while row < m:
            last = max(row + 1, int(np.searchsorted(first_node, first_node[row] + CHUNK, "right")) - 1)
            last = last if last < m - 1 else m
            start = np.repeat(np.arange(row, last), counts[row:last])
            depth = np.arange(len(start)) - np.repeat(first_node[row:last] - first_node[row], counts[row:last])
            yield start, depth + before[start] + 1
            row = last

    def parents(start, depth):
        left = _left_end(levels, start, depth - 1) if len(lcp) else start.copy()
        return np.where(depth > 0, left, 0)

    for start, depth in chunks():
        some = (depth > 0) & (start > 0)              # those of row 0 depend on the border
        left = parents(start, depth)[some]
        np.add.at(children, first_node[left] + (depth[some] - 1) - before[left] - 1, 1)

    for start, depth in chunks():
        right = _right_end(levels, start, depth) if len(lcp) else start.copy()
        left = _left_end(levels, start, depth) if len(lcp) else start.copy()
        least = _least(id_levels, left, right)
        above = parents(start, depth)
        above_right = np.where(depth > 0, _right_end(levels, above, depth - 1) if len(lcp) else above, m - 1)
        above_least = _least(id_levels, above, above_right)
        width = right - left + 1
        deeper = np.maximum(depth - 1, 0)
        saved = shared_upto[right + 1] - shared_upto[left + 1] - (width - 1) * chars[base[start] + deeper]
        leaves = ends_upto[right + 1] - ends_upto[left]
        at_start, at_end = left == 0, right == m - 1
        touching = at_start | at_end
        above_touching = (above == 0) | (above_right == m - 1)
        run = np.searchsorted(same, start)
        stop = np.where((same[np.minimum(run, len(same) - 1)] == start) & (sizes[start] == depth),
                        run_end[np.minimum(run, len(same) - 1)], start)
        digest, parent_digest, ended = [], [], []
        nothing = hashlib.sha256().hexdigest()
        for i, (s, d, e) in enumerate(zip(start.tolist(), depth.tolist(), stop.tolist())):
            own = above_own = hashed = None
            if touching[i]:
                own = (first_digests if at_start[i] else last_digests)[d]
            else:
                if e > s:
                    running_hash = hashlib.sha256()
                    for k, piece in enumerate(_names(conv[s:e])):
                        running_hash.update((b"," if k else b"") + piece)
                    hashed = running_hash.hexdigest()
                else:
                    hashed = nothing
            if d > 0 and above_touching[i]:
                above_own = (first_digests if above[i] == 0 else last_digests)[d - 1]
            digest.append(own)
            parent_digest.append(above_own)
            ended.append(hashed)
        index = first_node[start] + depth - before[start] - 1
        yield _rows(part=np.full(len(start), part, np.int32),
                    kind=["touching" if t else "node" for t in touching.tolist()], depth=depth, digest=digest,
                    parent_digest=parent_digest, conv_id=least,
                    parent_conv_id=pa.array(above_least, mask=(depth == 0) | above_touching),
                    n_convs=width, n_children=children[index], n_leaves=leaves, saved=saved,
                    ends_sha256=ended, at_start=at_start, at_end=at_end)
        for i in np.flatnonzero(touching & (stop > start)).tolist():
            pieces = list(_names(conv[start[i]:stop[i]]))
            yield _rows(part=[part] * len(pieces), kind=["ends"] * len(pieces), digest=[digest[i]] * len(pieces),
                        piece=list(range(len(pieces))), ids=pieces)
    yield _rows(part=[part], kind=["border"], first=[keys[0]], last=[keys[-1]],
                chars=[chars[base[0]:base[0] + sizes[0] + 1].tolist()])


def _hashed_ends(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each digest's ids; rows come sorted by (digest, part, piece)."""
    now = running = None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])],
                                          names=["digest", "ends"])

    for batch in batches:
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids")):
            if digest != now:
                if now is not None:
                    yield done()
                now, running = digest, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.as_buffer())
    if now is not None:
        yield done()


@F.udf(T.IntegerType())
def _border_turns(a, b):
    """Turns that two neighbours across a border share: one call a partition."""
    return -1 if a is None or b is None else _shared_turns(bytes(a), bytes(b), min(len(a), len(b)) // KEY)


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conversations`` (conv_id, turns, see
    ``sequences``): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    keyed = conversations.select(
        "conv_id", F.unhex(F.array_join("turns.key", "")).alias("key"), F.col("turns.size").alias("sizes"))
    # written once: dealing by range reads the keys twice
    keyed = S.materialised(keyed, "trie-sequences")
    ranged = (keyed.repartitionByRange("key", "conv_id").withColumn("part", F.spark_partition_id())
              .sortWithinPartitions("key", "conv_id"))
    found = S.materialised(ranged.select("part", "conv_id", "key", "sizes").mapInArrow(_nodes, _SCHEMA),
                           "trie-nodes")

    # one row per partition; the window sorts as many rows as there are partitions
    order = Window.orderBy("part")
    borders = found.where("kind = 'border'").select(
        "part", "chars", _border_turns(F.lag("last").over(order), "first").alias("before"),
        _border_turns("last", F.lead("first").over(order)).alias("after"),
        (F.octet_length("last") / KEY).cast("long").alias("last_turns"))
    borders = S.materialised(borders, "trie-borders")

    touching = found.where("kind = 'touching'").drop("chars").join(borders, "part")
    goes_on = F.col("at_start") & (F.col("before") >= F.col("depth"))
    first_child = F.col("at_start") & (F.size("chars") - 1 > F.col("depth")) & (F.col("before") <= F.col("depth"))
    last_leaf = F.col("at_end") & (F.col("after") < F.col("last_turns"))
    # where a node goes on from the partition before, this part's first row saves too
    more = F.when(goes_on, F.get("chars", F.col("before"))
                  - F.get("chars", F.greatest(F.col("depth") - 1, F.lit(0)).cast("int"))).otherwise(F.lit(0))
    merged = touching.groupBy("digest").agg(
        F.first("depth").alias("depth"), F.first("parent_digest").alias("parent_digest"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") + first_child.cast("long")).alias("n_children"),
        F.sum(F.col("n_leaves") + last_leaf.cast("long")).alias("n_leaves"),
        F.sum(F.col("saved") + more).alias("saved"))
    merged = S.materialised(merged, "trie-merged")
    ended = (found.where("kind = 'ends'").select("digest", "part", "piece", "ids")
             .repartition("digest").sortWithinPartitions("digest", "part", "piece")
             .mapInArrow(_hashed_ends, "digest binary, ends string"))

    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")
    above = merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("above"))
    crossing = (merged.join(ended, "digest", "left").join(above, "parent_digest", "left")
                .select("conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
    # a parent that crosses a border is looked up per partition, so a parent of
    # very many nodes is one key for each
    local = (found.where("kind = 'touching'").select("part", F.col("digest").alias("parent_digest"))
             .join(above, "parent_digest"))
    inner = (found.where("kind = 'node'").join(local, ["part", "parent_digest"], "left")
             .withColumn("parent_conv_id", F.coalesce("above", "parent_conv_id"))
             .select(*columns, F.col("saved").alias("saved_tokens"), "ends_sha256"))
    return inner.unionByName(crossing)
