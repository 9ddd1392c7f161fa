"""Distributed exact ntile equals Spark's single-partition ntile window."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendlens.operators.ntile import exact_ntile, global_row_number


def _window_ntile(df, k):
    w = Window.orderBy(F.col("r").asc_nulls_first(), F.col("id"))
    return {row["id"]: row["t"] for row in
            df.select("id", F.ntile(k).over(w).alias("t")).collect()}


def _ours(df, k, slices=None):
    out = exact_ntile(df, k, ["r"], "id", out_col="t", num_slices=slices)
    return {row["id"]: row["t"] for row in out.select("id", "t").collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=120),
       k=st.integers(1, 9), slices=st.integers(1, 7))
def test_matches_window_ntile(spark, values, k, slices):
    rows = [(i * 3 + 1, None if v is None else v / 2) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, r double")
    assert _ours(df, k, slices) == _window_ntile(df, k)


def test_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.1)], "id long, r double")
    assert _ours(df, 5) == _window_ntile(df, 5) == {2: 1, 3: 2, 1: 3}


def test_heavy_tie_is_spread_over_slices(spark):
    # A third of the rows share one (null) ratio: the range partitioning on
    # (ratio, id) still splits them across slices; results stay exact.
    rows = [(i, None if i % 3 == 0 else float(i % 17)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, r double")
    assert _ours(df, 5, slices=8) == _window_ntile(df, 5)
    ranked = global_row_number(df, ["r"], "id", out_col="rn", num_slices=8)
    got = sorted(r["rn"] for r in ranked.select("rn").collect())
    assert got == list(range(1, 3001))


def test_tiles_are_balanced(spark):
    df = spark.range(1003).select(F.col("id"), (F.col("id") % 7).cast("double").alias("r"))
    counts = (exact_ntile(df, 5, ["r"], "id", out_col="t").groupBy("t").count()
              .orderBy("t").collect())
    assert [c["count"] for c in counts] == [201, 201, 201, 200, 200]


def test_range_slices_stay_balanced_under_a_hot_tie(spark):
    # One value (null) holds a third of the rows; slicing on the full key
    # (ratio, id) splits it, so no slice is much larger than n / slices.
    n, slices = 30000, 8
    df = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 11).cast("double"))
         .alias("r"))
    ranged = df.repartitionByRange(slices, F.col("r").asc_nulls_first(), F.col("id"))
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == n
    assert max(sizes) < 2 * n / slices   # the hot tie alone would be n / 3


def test_default_slices_adapt_to_data(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = [(i, None if i % 4 == 0 else float(i % 13)) for i in range(2000)]
        df = spark.createDataFrame(rows, "id long, r double")
        assert _ours(df, 7) == _window_ntile(df, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
