"""WARC archives, licences, embeddings, the registered queries and the pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import os

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
import corpus_pipeline
from lendlens.llm import _shared as S
from lendlens.llm import embedding_dedup, licences, pii, queries, warc
from oracle_compare import compare, duck

from .texts import awkward


# -- WARC

def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [(5, "http://a/x", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (9, None, None), (8, "http://c", ""),
         (1, "u\r\nWARC-Type: evil", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (2, "x", "y" * 300_000),
         (7, "http://d", "<p>é</p>"), (4, "z", "\x00\r\n\r\n")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES * 1, "page_id long, url string, html string").repartition(3)
    uri = S.shared_folder(spark, "test-warc")
    manifest = warc.write_archives(pages, uri, archive_bytes=1000)
    got = {r.page_id: r for r in warc.read_archives(manifest).collect()}
    first = {}
    for i, _, t in sorted(PAGES):
        first.setdefault(t or "", i)
    for i, _, t in PAGES:
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len((t or "").encode()), digest(t))
        original = first[t or ""]
        assert (r.record_type, r.refers_to) == (("response", None) if original == i else ("revisit", original))
        assert r.payload is None if r.record_type == "revisit" else r.payload == (t or "").encode()
    assert len(got) == len(PAGES) and manifest.count() > 2
    S.remove(uri)


def test_archives_are_plain_warc_files(spark):
    pages = spark.createDataFrame([(1, "http://a", "one")], "page_id long, url string, html string")
    uri = S.shared_folder(spark, "test-warc")
    path = warc.write_archives(pages, uri).first().path.removeprefix("file:")
    raw = gzip.open(path).read()
    assert raw.count(b"WARC-Record-ID: ") == 2 and b"WARC-Type: response\r\n" in raw and raw.endswith(b"one\r\n\r\n")
    assert not [f for f in os.listdir(os.path.dirname(path)) if "attempt" in f]
    S.remove(uri)


def test_small_payloads_repeated_rows_and_null_ids(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long one"), (4, "u", "long one"), (4, "u", "long one"),
            (None, "u", "long one"), (None, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = S.shared_folder(spark, "test-warc")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in
                  warc.read_archives(warc.write_archives(pages, uri, min_bytes=3)).collect()),
                 key=lambda r: (r[0] or 0, r[1]))
    assert got == [(None, "response", None), (None, "revisit", 3), (1, "response", None), (2, "response", None),
                   (3, "response", None), (4, "revisit", 3), (4, "revisit", 3)]
    S.remove(uri)


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    uri = S.shared_folder(spark, "test-warc")
    assert warc.read_archives(warc.write_archives(pages, uri)).count() == 0
    S.remove(uri)


# -- licences

def test_licence_scan_inherits_from_the_nearest_directory(spark):
    rows = [("a/LICENSE", "Prose first.\nReleased under the MIT License. More prose."), ("a/x.txt", "none"),
            ("a/b/COPYING.md", "This program is licensed under the GNU General Public License, version 2."),
            ("a/b/c/y.txt", None), ("a/b/c/z.txt", "text; Licensed under the Apache License, Version 2.0. text"),
            ("a/bb/q.txt", ""), ("d/LICENSE", "no statement here, only the word license in prose about cats"),
            ("d/e.txt", "x"), ("top.txt", "SPDX-License-Identifier: MIT"), (None, None), ("a/x.txt", "none")]
    files = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "'k' AS licence", "1 AS pos")
    got = {(r.path, r.licence, r.origin, r.inherited_from) for r in licences.scan(files).collect()}
    assert got == {
        ("a/LICENSE", "MIT", "own", None), ("a/x.txt", "MIT", "inherited", "a"),
        ("a/b/COPYING.md", "GPL-2.0", "own", None), ("a/b/c/y.txt", "GPL-2.0", "inherited", "a/b"),
        ("a/b/c/z.txt", "Apache-2.0", "own", None), ("a/bb/q.txt", "MIT", "inherited", "a"),
        ("d/LICENSE", None, "none", None), ("d/e.txt", None, "none", None), ("top.txt", "MIT", "own", None),
        ("", None, "none", None)}
    assert licences.scan(files).count() == len(rows)


def test_root_licence_and_empty_table(spark):
    files = spark.createDataFrame([("LICENSE", "Released under the ISC License."), ("s/t/u.c", "x")],
                                  "path string, text string")
    assert {(r.path, r.licence, r.inherited_from) for r in licences.scan(files).collect()} == {
        ("LICENSE", "ISC", None), ("s/t/u.c", "ISC", "")}
    assert licences.scan(files.limit(0)).count() == 0


@pytest.mark.parametrize("licence,text", licences.TEMPLATES)
def test_every_template_finds_its_licence(spark, licence, text):
    row, = licences.scan(spark.createDataFrame([("f", f"Words before. {text}\nand after")], "path string, text string")).collect()
    assert (row.own_licence, row.cosine >= 0.95) == (licence, True)


GNU_HEADER = """/* prog.c
 *
 * This {what} is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {name} as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * You should have received a copy of the GNU {name}
 * along with this {what}.  If not, see <https://www.gnu.org/licenses/>.
 */
int main;
"""
MPL_HEADER = """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/.

import os
"""


def test_published_licence_files_and_headers(spark):
    texts = dict(licences.WHOLES[::-1])  # the files, which come first
    rows = [("gpl.c", GNU_HEADER.format(name="General Public License", what="program"), "GPL-3.0"),
            ("lgpl.c", GNU_HEADER.format(name="Lesser General Public License", what="library"), "LGPL-3.0"),
            ("agpl.c", GNU_HEADER.format(name="Affero General Public License", what="program"), "AGPL-3.0"),
            ("mpl.py", MPL_HEADER, "MPL-2.0"), ("t/LICENSE", "Mozilla Public License\nVersion 2.0\n", "MPL-2.0")]
    for licence in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "LGPL-2.1",
                    "Apache-2.0", "MPL-2.0", "CC0-1.0", "Unlicense"):
        words = texts[licence].split()
        wrapped = "\n".join(" ".join(words[k:k + 11]) for k in range(0, len(words), 11))
        rows += [(f"{licence}/LICENSE", f"Copyright 2020 Jo Doe\n\n{wrapped}", licence)]
    files = spark.createDataFrame([r[:2] for r in rows], "path string, text string")
    got = {r.path: r.own_licence for r in licences.scan(files).collect()}
    assert got == {path: licence for path, _, licence in rows}


def test_licence_scan_stays_in_the_jvm(spark, sf_dir):
    """Both plans that run: the files' own licences, and the rest over them."""
    files = queries._as_files(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for df in (licences.own_licences(files.select("path", "text")), licences.scan(files, keep=("doc_id",))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExternalRDD")), plan


def test_rows_that_share_a_path_keep_their_own_licences(spark):
    long = "This paragraph speaks of licensing " + "and of many other things in many words " * 30
    rows = [("a/x.txt", "Released under the MIT License."), ("a/x.txt", long), ("a/x.txt", "Released under the ISC License."),
            ("a/x.txt", "nothing"), ("a/x.txt", "Released under the MIT License."), (None, "Released under the MIT License."),
            (None, long), ("a/x.txt", None), ("LICENSE", long), ("b/LICENSE", "Released under the ISC License.")]
    files = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, path string, text string")
    got = {r.id: r.own_licence for r in licences.scan(files, keep=("id",)).collect()}
    assert got == {0: "MIT", 1: None, 2: "ISC", 3: None, 4: "MIT", 5: "MIT", 6: None, 7: None, 8: None, 9: "ISC"}


# -- embeddings

def vectors(seed, n=600, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            j = rng.integers(len(rows))
            v = np.array(rows[j][1]) + rng.normal(0, rng.choice([0, 0.02, 0.08, 0.2]), size)
            rows.append((i, v.astype("f4").tolist(), rows[j][2]))
        else:
            rows.append((i, rng.normal(size=size).astype("f4").tolist(), int(rng.integers(3))))
    return rows


def brute_links(rows, threshold=0.93):
    ok = {i: np.array(v, float) for i, v, label in rows
          if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: l for i, _, l in rows}
    return {(a, b) for a in ok for b in ok if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b])
            and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= threshold}


def test_embedding_links_against_brute_force(spark):
    rows = vectors(1) + [(1000 + i, v, l) for i, v, l in vectors(1)[:50]]
    odd = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] + [1.0] * 15, 1),
           (2004, [float("inf")] + [1.0] * 15, 1), (2005, rows[0][1], None), (2006, [1.0, 2.0], 1),
           (2007, [2.0, 4.0], 1), (2008, [1e-30] * 16, 2), (2009, [1e30] * 16, 2), (2010, [], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS n_links", "'x' AS kept", "2 AS rep").repartition(3)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    links = brute_links(rows + odd)
    counts, parent = {i: 0 for i, _, _ in rows + odd}, {i: i for i, _, _ in rows + odd}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        counts[a], counts[b] = counts[a] + 1, counts[b] + 1
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert len(got) == len(counts)
    found = sum(got[i].n_links for i in counts)
    assert all(got[i].n_links <= counts[i] for i in counts)  # none below the threshold
    assert found >= 0.95 * sum(counts.values())
    if found == sum(counts.values()):
        assert all(got[i].component_id == root(i) and got[i].kept == (root(i) == i) for i in counts)
    assert got[2006].n_links == got[2007].n_links == 1 and got[2008].n_links >= 1
    for i in (2000, 2001, 2002, 2003, 2004, 2005, 2010):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_embeddings_empty_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)]
    got = sorted(map(tuple, embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, True)]


def noisy_group(n, seed=5, size=64):
    """A third of n vectors are noisy copies of one centre, the others unrelated."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size))
    centre = rng.normal(size=size)
    k = n // 3
    x[:k] = centre / np.linalg.norm(centre) + rng.normal(0, 0.175 / size ** 0.5, (k, size))
    x = x[rng.permutation(n)]
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("n,block", [(3000, 4096), (9000, 4096), (9000, 700)])
def test_large_noisy_groups_keep_their_links(spark, n, block):
    x = noisy_group(n).astype("f4").astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())],
                               "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_duplicates(df, block=block).orderBy("vec_id").collect()
    counts = np.array([r.n_links for r in got])
    assert (counts <= true).all() and counts.sum() >= 0.995 * true.sum()
    linked = np.flatnonzero(true > n // 10)
    assert {got[i].component_id for i in linked} == {got[linked[0]].component_id}


def cone(n, seed=3, size=64, mean=0.9):
    """Vectors around one direction, as text embeddings often lie, in small groups of near copies."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=size)
    x = centre / np.linalg.norm(centre) * mean ** 0.5 + rng.normal(0, ((1 - mean) / size) ** 0.5, (n, size))
    x[n // 2:] = x[rng.integers(0, n // 2, n - n // 2)] + rng.normal(0, 0.15 / size ** 0.5, (n - n // 2, size))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("n", [2000, 6000])
def test_recall_in_a_cone(spark, n):
    x = cone(n).astype("f4").astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())],
                               "vec_id long, embedding array<float>, label int")
    counts = np.array([r.n_links for r in embedding_dedup.near_duplicates(df).orderBy("vec_id").collect()])
    assert (counts <= true).all() and counts.sum() >= 0.95 * true.sum()


def test_candidates_share_enough_pivots():
    """A cell takes the pairs that share ``shared`` of their first ``prefix`` pivots, each in its first shared list."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8))
    orders = np.array([rng.permutation(12)[:6] for _ in range(60)])
    pairs = {}
    for pivot in range(12):
        own = np.flatnonzero((orders[:, :4] == pivot).any(axis=1))
        rows = pa.table({"rep": own, "n": np.ones(len(own), np.int64), "block": np.zeros(len(own), np.int32),
                         "vector": pa.array(x[own].tolist()), "pivots": pa.array(orders[own].tolist(), pa.list_(pa.int32()))})
        rep, counts, _ = embedding_dedup._cell((1, 8, pivot, 0, 0), rows, -2.0, 4, 2)
        for r, c in zip(rep.tolist(), counts.tolist()):
            pairs[r] = pairs.get(r, 0) + c
    shared = np.array([[len(set(a) & set(b)) for b in orders[:, :4]] for a in orders[:, :4]])
    assert pairs == dict(enumerate(((shared >= 2).sum(axis=1) - 1).tolist()))


# -- registered queries and pipeline

@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, sf_dir, name):
    assert compare(E.queries()[name](spark, sf_dir), duck(sf_dir), E.oracle_sql()[name]) == []


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_stages(spark, sf_dir):
    """Each stage's decisions take effect and nothing clean goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = S.materialised(stage(spark, before, sf_dir), f"test-{name}")
        assert tuple(after.columns) == corpus_pipeline.COLUMNS
        assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        sizes.append((before.count(), after.count()))
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept = {r.doc_id: r for r in after.collect()}
        assert set(kept) <= ids
        if name == "near_duplicates":
            from lendlens.llm import minhash
            assert set(kept) == {r.doc_id for r in minhash.near_duplicates(before).where("kept").collect()}
        if name == "decontaminate":
            from lendlens.llm import decontaminate
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            hit = {r.doc_id for r in decontaminate.find_hits(before, items).where("size(hits.spans) > 0").collect()}
            texts = {r.doc_id: r.text for r in before.collect()}
            assert all((kept[i].text != texts[i]) == (i in hit) for i in kept) and ids - set(kept) <= hit
        if name == "personal_data":
            assert set(kept) == ids and not any("@mail" in r.text for r in kept.values())
        before = after
    assert sizes[0][1] < sizes[0][0] and sizes[1][1] < sizes[1][0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(kept)


def test_personal_data_stage_learns_from_every_proposal(make_docs, sf_dir, monkeypatch):
    """More than 20,000 proposals, right in half the documents and wrong in the
    others: the trees start from the odds of all that aren't held out."""
    judges = []
    redact = pii.redact
    monkeypatch.setattr(pii, "redact", lambda df, judge: judges.append(judge) or redact(df, judge))
    rows = [(i, " ".join(f"{j}.{i % 250}.1.{1 if i % 2 else 700 + j}," for j in range(25 + 25 * (i % 2)))) for i in range(600)]
    docs = make_docs(rows, extra=False).selectExpr("*", "'en' AS lang", "'web' AS source", "0L AS n_chars")
    out = corpus_pipeline.redact_personal_data(docs.sparkSession, docs, sf_dir)
    found = pii.spot(docs).selectExpr("doc_id", "explode(proposals) AS p").selectExpr(
        "xxhash64(doc_id, p.start, p.kind) AS h", "p.kind", "p.rule", "p.x").collect()
    assert len(found) > 21_000 and all(r.rule in (0, 1) for r in found)
    right = wrong = 0
    for i, r in enumerate(sorted(found)):
        shown = 1 + any(r.x[-pii._CONTEXT_FEATURES:])
        right, wrong = right + (i % 3 > 0) * shown * r.rule, wrong + (i % 3 > 0) * shown * (1 - r.rule)
    assert judges[0].trees.base == pytest.approx(math.log(right / wrong), rel=1e-12)
    assert {r.doc_id for r in out.where("text like '%[IP]%'").collect()} == {i for i, _ in rows if i % 2}


def test_pipeline_takes_odd_rows(spark, tmp_path, sf_dir):
    rows = [(i, t, "en", None, None) for i, t in awkward(9) if i != 8] + [(None, None, None, None, None)]
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).selectExpr("*", "1 AS hits").write.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {4, 5} <= {p.doc_id for p in pieces} and 6 not in {p.doc_id for p in pieces}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_scratch_tables_go(spark, sf_dir):
    from lendlens.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = E.queries()["op9_minhash"](spark, sf_dir)
    left = set(os.listdir(base)) - before
    assert len(left) == 1 and out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    table = S.materialised(spark.range(3), "test-forget")
    S.forget(table)
    assert not [f for f in set(os.listdir(base)) - before - left if f.startswith("test-forget")]
