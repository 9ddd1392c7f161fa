"""Whitening, prefix tries and exact search against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.llm import conversation_trie, topk_search, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def many_partitions(spark):
    """Small tables dealt over many tasks, so that borders are met."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def clashing(df, *names):
    for name in names:
        df = df.withColumn(name, F.lit(name))
    return df


# ---- exact search

def searched(df, k=5, every=50, **options):
    got = topk_search.search(df, F.col("vec_id") % every == 0, k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def by_force(rows, k=5, every=50):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(usable):
        if q is None or q % every:
            continue
        scored = sorted(((-sum(p * r for p, r in zip(x, y)), i is None, i or 0, i)
                         for b, (i, y) in enumerate(usable) if a != b), key=lambda t: t[:3])
        out += [(q, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def awkward_vectors(n=260, wide=7, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 1), rng.randint(-2, 2) / 256]) for _ in range(wide)], 1)
            for i in range(n)]
    hot = rows[3][1]
    rows = [(i, hot if i % 3 == 0 else v, label) for i, v, label in rows]  # a third are one vector: ties
    return rows + [(50, rows[8][1], 1), (50, rows[8][1], 1), (None, hot, 1), (1000, None, 1), (1050, [], 1),
                   (1100, [0.0] * wide, 1), (1150, [1.0, None] + [0.0] * 5, 1), (1200, [float("nan")] * wide, 1),
                   (1250, [float("inf")] + [1.0] * 6, 1), (1300, [2.0, -1.0], 1), (1350, [0.5] * 11, 1)]


@pytest.mark.parametrize("cell", [1 << 21, 200])
def test_search_equals_brute_force(spark, cell):
    rows = awkward_vectors()
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(5), "row", "i", "j", "rank", "score", "vector")
    assert searched(df, cell=cell) == by_force(rows)


def test_search_few_rows_and_none(spark):
    few = [(0, [1.0, 2.0], 1), (7, [3.0, 1.0], 1)]
    assert searched(spark.createDataFrame(few, VECTORS)) == by_force(few)
    assert searched(spark.createDataFrame(few[:1], VECTORS)) == []
    assert searched(spark.createDataFrame([], VECTORS)) == []


def test_search_of_huge_components(spark):
    """Scores beyond a double's whole numbers stay exact, beyond a long they are cut to it."""
    rows = [(0, [2.0 ** 24, 1.0], 1), (1, [2.0 ** 16, 3.0], 1), (2, [2.0 ** 16, 4.0], 1), (3, [3e38, 0.0], 1),
            (4, [2.9e38, 1e38], 1), (5, [-3e38, 0.0], 1)]
    got = topk_search.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0, 5).orderBy("rank").collect()
    best = 256 * 256
    assert [r.vec_id for r in got] == [4, 3, 2, 1, 5]
    assert [r.score for r in got] == [2 ** 63 - 1, 2 ** 63 - 1, best * (2 ** 40 + 4), best * (2 ** 40 + 3), -2 ** 63]


# ---- whitening

def whitened(df, **options):
    rows, wide = whitening.prepare(df)
    return whitening.whiten(rows, wide, whitening.fit(rows, wide, **options)).collect()


def spectrum(x, components):
    """Eigenvalues and eigenvectors by a dense solver on the distinct vectors."""
    distinct = np.unique(x, axis=0)
    e, v = np.linalg.eigh(np.cov(distinct.T.astype(float), bias=True))
    return distinct, e[::-1][:components], v.T[::-1][:components]


def test_whitening_equals_a_dense_solver(spark):
    rng = np.random.default_rng(4)
    wide, n = 24, 700
    values = (rng.standard_normal((n, wide)) * np.linspace(2.0, 0.3, wide)) @ np.linalg.qr(rng.standard_normal((wide, wide)))[0]
    values = values.astype(np.float32)
    values[::3] = values[0]  # a third of all rows
    rows = [(i, v.tolist(), 1) for i, v in enumerate(values)]
    rows += [(None, values[5].tolist(), 1), (5, values[5].tolist(), 2), (900, None, 1),
             (901, [None] + [0.0] * (wide - 1), 1), (902, [float("inf")] * wide, 1)]
    got = whitened(clashing(spark.createDataFrame(rows, VECTORS).repartition(4), "x", "n", "rows", "sums", "component"))
    x = np.floor(64 * values.astype(float)).astype(np.int64) + 1_000_000
    distinct, e, v = spectrum(x, 16)
    s, m = distinct.sum(axis=0), len(distinct)
    assert len(got) == (n + 2) * 16 and {r.n for r in got} == {m}
    assert got[0].identity_error < 1e-10
    table = {(r.vec_id, r.component): r for r in got}
    for k in range(16):
        signs = set()
        for i in (0, 1, 5, 77, n - 1):
            want = ((x[i] - s / m) @ v[k]) / math.sqrt(e[k])
            r = table[i, k + 1]
            signs.add(round(r.whitened / want))
            assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-8, abs_tol=1e-10)
            assert r.deviation == int((((m * x[i]) - s) ** 2).sum())
            assert math.isclose(r.explained, e[k] / np.trace(np.cov(distinct.T.astype(float), bias=True)), rel_tol=1e-10)
        assert len(signs) == 1


@pytest.mark.parametrize("case", ["repeated", "flat", "line", "one"])
def test_whitening_of_degenerate_spectra(spark, case):
    """Repeated eigenvalues, missing directions and shorter vectors."""
    if case == "repeated":   # both ends of every axis: all eigenvalues equal
        rows = [[s * (i == j) for j in range(6)] for i in range(6) for s in (-8.0, 8.0)]
    elif case == "flat":     # rank 2 in 5 dimensions, some vectors shorter
        rows = [[float(a), float(b)] + [0.0] * (3 * (a % 2)) for a in range(5) for b in range(4)]
    elif case == "line":
        rows = [[float(a)] * 3 for a in range(9)]
    else:
        rows = [[1.0, 2.0]] * 4
    got = whitened(spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], VECTORS), components=4)
    rank = {"repeated": 4, "flat": 2, "line": 1, "one": 0}[case]
    assert len(got) == len(rows) * rank
    if rank:
        w = np.array(sorted((r.component, r.vec_id, r.whitened) for r in got))[:, 2].reshape(rank, -1)
        assert np.allclose(np.cov(w, bias=True), np.eye(rank), atol=1e-9) and got[0].identity_error < 1e-9
        assert max(r.explained for r in got) <= 1 + 1e-12


def test_whitening_ends_early_only_with_proof(spark):
    """A steep spectrum needs fewer passes than dimensions, a tail that could hold another component doesn't."""
    rng = np.random.default_rng(0)
    for scale, least, most in ((10.0 ** -np.arange(30), 5, 29), (np.ones(30), 30, 30)):
        x = rng.standard_normal((400, 30)) * scale
        y, steps = x - x.mean(axis=0), []

        def step(g, left):
            steps.append(1)
            u = y @ g
            return np.concatenate([[u @ u], y.T @ u, (y @ left.T).T @ u])

        vectors = whitening._bidiagonal(step, 30, 4, float((y ** 2).sum()))[:4]
        assert least <= len(steps) <= most
        want = np.linalg.svd(y, full_matrices=False)[2][:4]
        assert np.allclose(np.abs((vectors * want).sum(axis=1)), 1, atol=1e-10)


def test_whitening_empty_and_huge(spark):
    assert whitened(spark.createDataFrame([], VECTORS)) == []
    assert whitened(spark.createDataFrame([(1, [], 1), (2, None, 1)], VECTORS)) == []
    got = whitened(spark.createDataFrame([(1, [3e38, 0.0], 1), (2, [-3e38, 1.0], 1), (3, [0.0, 2.0], 1)], VECTORS))
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None or r.deviation >= 0 for r in got)


# ---- prefix trie

def rebuilt_by_force(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def trie_by_force(rows):
    convs = rebuilt_by_force(rows)
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in members.items())


def trie_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = clashing(df, "key", "base", "part", "depth", "head")
    got = conversation_trie.trie(conversation_trie.rebuilt(df))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted(tuple(r) for r in got.collect())


def conversations(seed, n=400):
    """Shared beginnings, exact copies in bulk, one first turn of most, odd rows."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 5 * n), n):
        kind = rng.random()
        turns = ([("user", "hello 😀")] + [("assistant", rng.choice("abc") * k) for k in range(1, rng.randint(1, 7))]
                 if kind < 0.5 else [("user", "copy"), ("assistant", "copied"), ("user", "end")] * 3 if kind < 0.85
                 else [(rng.choice(["user", None, ""]), rng.choice([None, "", "x"])) for _ in range(rng.randint(1, 9))])
        rows += [(c, k if rng.random() < 0.95 else rng.choice([None, 2]), *t) for k, t in enumerate(turns)]
    return rows + rows[:6] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed", [0, 1])
def test_trie_across_borders(spark, many_partitions, seed):
    rows = conversations(seed)
    assert trie_of(spark, rows) == trie_by_force(rows)


def test_trie_in_one_partition(spark):
    rows = conversations(2, 150)
    assert trie_of(spark, rows) == trie_by_force(rows)


def test_trie_of_copies_only(spark, many_partitions):
    """One sequence over all partitions, its ids hashed in order."""
    rows = [(c * 100, k, "user", f"t{k}") for c in range(300) for k in range(4)]
    assert trie_of(spark, rows) == trie_by_force(rows)


def test_trie_small_and_empty(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x")]) == []
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(turnless, 1, "user", "gone")]
    assert trie_of(spark, rows) == trie_by_force(rows) and trie_by_force(rows)[0][5] == 1
    long = [(7, k, "user", "y" * (k % 3)) for k in range(120)] + [(9, k, "user", "y" * (k % 3)) for k in range(110)]
    assert trie_of(spark, long) == trie_by_force(long)


def test_trie_search_in_chunks_and_packed_ids(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 5)
    monkeypatch.setattr(conversation_trie, "PACK", 42)
    import pyarrow as pa
    rows = conversations(3, 120)
    convs = rebuilt_by_force(rows)
    table = sorted((b"".join(hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16] for r, t in turns), c,
                    [len(t) for _, t in turns]) for c, turns in convs.items())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * len(table), pa.int32()), pa.array([t[1] for t in table]), pa.array([t[0] for t in table], pa.binary()),
         pa.array([t[2] for t in table], pa.list_(pa.int64()))], names=["part", "conv_id", "key", "sizes"])
    found = pa.Table.from_batches(list(conversation_trie._nodes([batch]))).to_pylist()
    inner = sorted((r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["ends_sha256"])
                   for r in found if r["kind"] == "node")
    want = {(r[0], r[1]): r for r in trie_by_force(rows)}
    assert inner and all(tuple(want[r[:2]][i] for i in (0, 1, 3, 4, 5, 6, 7)) == r for r in inner)
