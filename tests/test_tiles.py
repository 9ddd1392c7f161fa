"""Aggregates per ntile equal grouping by a ranked table."""

from __future__ import annotations

import collections
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendlens.operators import cohorts, tiles
from lendlens.operators.ntile import exact_ntile
from lendlens.sources import fixtures as fx


def key(row):
    """Null first, NaN last, equal values by id."""
    value = row[1]
    nan = value is not None and math.isnan(value)
    return value is not None, nan, 0.0 if value is None or nan else value, row[0]


def by_rank(rows, k):
    """(n, m, s, d) per tile by sorting."""
    order = sorted(rows, key=key)
    out = collections.defaultdict(lambda: [0, 0, 0.0, 0])
    small, big = divmod(len(order), k)
    at = 0
    for tile in range(1, k + 1):
        for i, v, a in order[at:at + small + (tile <= big)]:
            t = out[tile]
            t[0], t[1], t[2], t[3] = t[0] + 1, t[1] + (v is not None), t[2] + (v or 0.0), t[3] + a
        at += small + (tile <= big)
    return {t: tuple(x) for t, x in out.items()}


def got(spark, rows, k):
    df = spark.createDataFrame(rows, "id long, v double, a int")
    result = tiles.tile_sums(df, k, F.col("v"), F.col("id"), F.col("a")).collect()
    return {r.tile: (r.n, r.m, r.s, r.d) for r in result}


def same(x, y):
    return x.keys() == y.keys() and all(
        a[:2] == y[t][:2] and a[3] == y[t][3] and (math.isclose(a[2], y[t][2], rel_tol=1e-9, abs_tol=1e-9)
                                                   or math.isnan(a[2]) and math.isnan(y[t][2]))
        for t, a in x.items())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.sampled_from([-3.5, -0.01, 0.0, 0.01, 1.0, 2.5, 1e300, 5e-324]),
                                 st.floats(-1e6, 1e6)), max_size=60), k=st.integers(1, 7))
def test_equals_ranking(spark, values, k):
    rows = [((i * 7919) % 4099 << (i % 3) * 15, v, i % 2) for i, v in enumerate(values)]
    rows = list({r[0]: r for r in rows}.values())
    assert same(got(spark, rows, k), by_rank(rows, k))


ODD = st.one_of(st.none(), st.sampled_from([math.nan, math.inf, -math.inf, 0.0, -0.0, 1.0, 1.0, 1e300, 5e-324]),
                st.floats(-50, 50))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(ODD, max_size=50), k=st.integers(1, 7))
def test_odd_values(spark, values, k):
    """Infinities and NaN are values like others: for sums and for the tile of every row."""
    rows = [((i * 7919) % 4099 << (i % 3) * 15, v, i % 3 - 1) for i, v in enumerate(values)]
    rows = list({r[0]: r for r in rows}.values())
    assert same(got(spark, rows, k), by_rank(rows, k))
    df = spark.createDataFrame(rows, "id long, v double, a int")
    tiles_ = {r.id: r.t for r in tiles.with_tile(df, k, F.col("v"), F.col("id"), "t").collect()}
    assert tiles_ == by_position(rows, k)


def by_position(rows, k):
    order, out, at = sorted(rows, key=key), {}, 0
    small, big = divmod(len(order), k)
    for tile in range(1, k + 1):
        for r in order[at:at + small + (tile <= big)]:
            out[r[0]] = tile
        at += small + (tile <= big)
    return out


def test_sums_of_the_issue(spark):
    rows = [(i, v, 1) for i, v in enumerate([math.nan, 0.5, 1.0, 2.0, 3.0, 4.0])]
    result = got(spark, rows, 2)
    assert result[1][:3] == (3, 3, 3.5) and math.isnan(result[2][2])


@pytest.mark.parametrize("k", [1, 2, 5, 100])
def test_tile_of_every_row_with_hot_ties(spark, k):
    """Long values beyond a double's whole numbers, a value of most rows, wide ids."""
    rows = [(i << 18, 7 if i % 3 else (1 << 60) + i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v long")
    result = {r.id: r.t for r in tiles.with_tile(df, k, F.col("v"), F.col("id"), "t").collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    small, big = divmod(len(order), k)
    want = [t for t in range(1, k + 1) for _ in range(small + (t <= big))]
    assert result == {r[0]: t for r, t in zip(order, want)}


def test_tile_of_every_row_starts_no_job_and_sorts_no_table(spark, sf_dir, tmp_path):
    path = str(tmp_path / "apps")
    fx.applications(spark, sf_dir).write.parquet(path)
    apps = spark.read.parquet(path)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("build-tiles", "no job may run while the plan is built")
    try:
        result = exact_ntile(apps, 5, ["AMT_CREDIT"], "SK_ID_CURR", "t")
        assert not tracker.getJobIdsForGroup("build-tiles")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert result.columns == [*apps.columns, "t"]
    nodes = []  # of the table's own plan; the edges' keys are a subquery inside an expression

    def walk(node):
        nodes.append(node.nodeName())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(result._jdf.queryExecution().optimizedPlan())
    assert set(nodes) <= {"Project", "LogicalRelation"}, nodes
    counts = {r.t: r["count"] for r in result.groupBy("t").count().collect()}
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(1, 6))


@pytest.mark.parametrize("k", [2, 5])
def test_tie_of_most_rows_and_wide_ids(spark, k):
    """One value and null hold most rows, over many id ranges."""
    rows = [(i << 18, None if i % 3 == 0 else 2.0 if i % 3 == 1 else float(i), i % 5 == 0) for i in range(3000)]
    rows = [(i, v, int(a)) for i, v, a in rows]
    assert same(got(spark, rows, k), by_rank(rows, k))


def test_quintiles_start_no_job_and_read_twice(spark, sf_dir, tmp_path):
    path = str(tmp_path / "apps")
    fx.applications(spark, sf_dir).write.parquet(path)
    apps = spark.read.parquet(path)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("build-quintiles", "no job may run while the plan is built")
    try:
        result = cohorts.analyse(apps, 2)
        assert not tracker.getJobIdsForGroup("build-quintiles")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert final.count("Scan parquet") <= 2 and "Sort [SK_ID_CURR" not in final
