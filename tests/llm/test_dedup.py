from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest

from lendlens.llm import _graph, decontaminate, minhash, substring_dedup
from pyspark.sql import functions as F

from .texts import awkward, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def passages(seed, shared, edited=False):
    """Rows around shared passages, in one hot and several cold groups."""
    rng = random.Random(seed)
    texts = [prose(rng, shared) for _ in range(4)]
    rows = awkward(seed)
    for i in range(100, 160):
        passage = texts[0] if i % 3 == 0 else rng.choice(texts)
        if edited:
            words = passage.split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "changed"
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, f"{prose(rng, rng.randint(0, 50))} {passage} {prose(rng, rng.randint(0, 50))}"))
    return rows


# -- repeated passages

def brute_removed(rows, n):
    words = [SPACE_WORD.findall(t or "") for _, t in rows]
    count = collections.Counter(tuple(w[k:k + n]) for w in words for k in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {j for k in range(len(w) - n + 1) if count[tuple(w[k:k + n])] > 1 for j in range(k, k + n)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("options", [{}, {"buckets": 3, "bucket_bytes": 2000}, {"window": 8, "minimiser": 3}])
def test_repeated_passages(make_docs, rows_of, options):
    rows = passages(11, 50)
    got = rows_of(substring_dedup.remove_repeated(make_docs(rows), **options),
                  "doc_id", "n_words", "n_removed", "text")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert got == sorted(brute_removed(rows, options.get("window", 35)), key=key)


def test_window_repeats_inside_one_document(make_docs):
    text = " ".join(["one", "two"] * 30)
    row, = substring_dedup.remove_repeated(make_docs([(1, text)])).collect()
    assert (row.n_words, row.n_removed, row.text) == (60, 60, "")


def test_repeated_passages_empty(make_docs):
    assert substring_dedup.remove_repeated(make_docs([])).count() == 0


def test_equal_hashes_are_told_apart_by_words(monkeypatch):
    """All windows under one hash: still only equal ones are joined."""
    import numpy as np
    monkeypatch.setattr(substring_dedup.B, "grams", lambda h, n: np.zeros(len(h) - n + 1, np.uint64))
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    assert substring_dedup._first_equal(ids, np.arange(7), 3).tolist() == [0, 1, 2, 3, 4, 5, 0]


def test_a_phrase_in_every_text_is_no_bucket(spark, make_docs):
    """One phrase, everywhere and first by hash, between each text's own words."""
    import numpy as np
    rng = random.Random(3)
    grams = {}
    for _ in range(4000):
        phrase = prose(rng, 5).split()
        if len(phrase) == 5:
            raw = " ".join(phrase).encode()
            hashes = substring_dedup.B.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]),
                                             substring_dedup.B.table(substring_dedup.B.SPACE, False))[2]
            grams[int(substring_dedup.B.mix(substring_dedup.B.grams(hashes, 5))[0])] = " ".join(phrase)
    phrase = grams[min(grams)]
    word = lambda: rng.randbytes(4).hex()
    rows = [(i, " ".join([word() for _ in range(30)] + [phrase] + [word() for _ in range(30)])) for i in range(300)]
    keyed = make_docs(rows, extra=False).selectExpr("doc_id", "xxhash64(text) AS key", "text")
    common = substring_dedup._common(keyed, 35, 5, 64, 1000)
    assert len(common) >= 1

    def windows(common):
        packed = keyed.mapInArrow(lambda it: substring_dedup._pack(it, 35, 5, 64, common), substring_dedup._PACKED)
        per = collections.Counter()
        for r in packed.collect():
            per[r.bucket] += int(np.frombuffer(r.runs, substring_dedup._RUNS)["windows"].sum())
        return max(per.values()) / sum(per.values())

    assert windows(np.empty(0, np.uint64)) > 0.3 and windows(common) < 0.06
    rows += [(1000, rows[0][1]), (1001, "a " + rows[1][1])]
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated(make_docs(rows), sample=1000).collect()}
    assert {i for i, n in got.items() if n} == {0, 1, 1000, 1001} and got[0] == 65


# -- near duplicates

def brute_classes(rows, percent, n=5):
    sets = {}
    for i, t in rows:
        w = SPACE_WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)


@pytest.mark.parametrize("seed", [21, 22])
def test_near_duplicates(make_docs, rows_of, seed):
    rows = [r for r in passages(seed, 120, edited=True) if r[0] is not None]
    rows += [(1000 + i, t) for i, t in rows[::2]] + [(2001, "a b"), (2002, "A B"), (2003, "a b c")]
    assert rows_of(minhash.near_duplicates(make_docs(rows))) == brute_classes(rows, 85)


def test_chain_of_edits_is_one_class(make_docs, rows_of):
    rng = random.Random(7)
    words = prose(rng, 200).split()
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[rng.randrange(200)] = f"new{i}"
    assert rows_of(minhash.near_duplicates(make_docs(rows))) == brute_classes(rows, 85)


def test_unlinked_members_of_a_bucket_all_become_hubs(make_docs, rows_of):
    """One band of one row: buckets are large and mostly false, so the hub
    rounds have to find every link."""
    rows = [r for r in passages(23, 60, edited=True) if r[0] is not None]
    got = rows_of(minhash.near_duplicates(make_docs(rows), bands=8, rows=1))
    assert got == brute_classes(rows, 85)


def test_null_ids_and_empty_tables(make_docs, rows_of):
    assert minhash.near_duplicates(make_docs([])).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f")]
    assert rows_of(minhash.near_duplicates(make_docs(rows))) == [
        (None, 2, None, True), (2, 2, 2, True), (3, 2, 2, False)]


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in _graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# -- decontamination

def brute_hits(rows, items, n=10):
    windows = collections.defaultdict(set)
    sizes = set()
    for i, t in items:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        size = min(n, len(w))
        if size:
            sizes.add(size)
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k:k + size])].add(i)
    out = []
    for i, t in rows:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), sorted(x for x in found if x is not None)))
    return out


def test_set():
    rng = random.Random(31)
    vocabulary = ["the", "of", "and", "to", "Test", "Q2", "über", "was"]
    items = [(i, prose(rng, rng.randint(10, 40), vocabulary)) for i in range(1, 30)]
    items += [(40, None), (41, ""), (42, "..."), (43, "One-word"), (44, "the of the"), (45, items[0][1]),
              (None, prose(rng, 15, vocabulary)), (9, prose(rng, 12, vocabulary))]
    return items


@pytest.mark.parametrize("short,item_words", [(False, 10**6), (True, 10**6), (True, 60), (False, 100)])
def test_benchmark_hits(make_docs, spark, short, item_words):
    rng = random.Random(32)
    items = [x for x in test_set() if short or x[0] not in (43, 44)]
    rows = awkward(33)
    texts = [t for _, t in items if t]
    for i in range(200, 260):
        w = rng.choice(texts).split()
        k = rng.randrange(len(w))
        rows.append((i, f"{prose(rng, 20, ['the', 'of', 'xx'])} {', '.join(w[k:k + 14]).upper()}. {prose(rng, 9)}"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.find_hits(make_docs(rows), benchmark, item_words=item_words)
    got = [(r[0], r[1], r[2], list(r[3])) for r in
           hits.select("doc_id", "hits.n_words", decontaminate.n_hit(), "hits.items").collect()]
    key = lambda r: (r[0] is not None, r[0], r[1:3])
    assert sorted(got, key=key) == sorted(brute_hits(rows, items), key=key)


test_set.__test__ = False


def test_cut_and_coverage(make_docs, spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, f"Before it; {item.upper()}! After é it, with some words more than the passage has, so it stays here."),
            (2, item), (3, "clean"), (4, None), (5, "")]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(make_docs(rows), benchmark).collect()}
    assert got == {1: "Before it; ! After é it, with some words more than the passage has, so it stays here.",
                   3: "clean", 4: None, 5: ""}


def test_empty_benchmark(make_docs, spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_hits(make_docs([(1, "a b"), (2, None)]), benchmark)
    assert sorted(map(tuple, got.select("doc_id", "hits.n_words", F.size("hits.spans")).collect())) == [(1, 2, 0), (2, 0, 0)]
    assert decontaminate.find_hits(make_docs([]), benchmark).count() == 0


def test_items_named_by_text(spark, make_docs):
    """Ids such as gsm-1 are kept as they are, in one block of items and in several."""
    items = spark.createDataFrame([("gsm-1", "a b c d e f g h i j k"), ("gsm-10", "x y"), (None, "q r s")],
                                  "item_id string, text string")
    docs = make_docs([(1, "z a b c d e f g h i j z"), (2, "x y q r s"), (3, None)])
    for words in (100_000, 5):
        got = {r.doc_id: r.hits for r in decontaminate.find_hits(docs, items, item_words=words).collect()}
        assert got[1]["items"] == ["gsm-1"] and got[2]["items"] == ["gsm-10"] and got[3]["items"] == []
        assert [s["end_word"] - s["first_word"] for s in got[2]["spans"]] in ([5], [2, 3])


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 0, 2), (2, 1, 0)])
def test_repeated_ids_keep_their_own_links(spark, order):
    """An id with two unrelated texts: neither borrows the other's links, and
    none is lost to the pipeline, whatever the order of rows."""
    import corpus_pipeline
    rng = random.Random(8)
    a, b = prose(rng, 200), prose(rng, 200)
    rows = [(5, a), (5, b), (1, b + " word"), ]
    rows = [rows[i] for i in order] + [(9, a), (5, a), (7, ""), (7, None), (7, ""), (None, a)]
    for parts in (1, 4):
        df = (spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
              .selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars"))
        got = {(r.doc_id, r.n_shingles > 0, r.text_key, r.component_id, r.lead)
               for r in minhash.near_duplicate_classes(df).collect()}
        by_text = {t: {(x[0], x[3], x[4]) for x in got if x[1] and x[2] == k}
                   for t, k in df.selectExpr("text", "xxhash64(text)").distinct().collect() if t}
        assert by_text == {a: {(5, 5, True), (9, 5, False), (None, None, True)}, b: {(5, 1, False)},
                           b + " word": {(1, 1, True)}}
        kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()), key=str)
        assert kept == sorted([(5, a), (1, b + " word"), (7, ""), (7, None), (None, a)], key=str)
