"""Tiles (``ntile``) of a table and aggregates per tile, without ranking it.

``ntile(k)`` over a global order needs the rank of every row, but it takes only
the k - 1 places where one tile ends and the next begins:

1. Rows are counted per order-preserving bucket of the value (a few thousand
   buckets for real data, bounded by the double's range; infinities and NaN have
   buckets of their own). A running count over that small table gives each
   bucket's ranks.
2. At most k - 1 buckets hold an edge. Only their rows are read again, and
   counted per (value, id range). A value that a third of all rows share is many
   id ranges.
3. At most k - 1 id ranges hold an edge; only their rows are numbered.

``tile_sums`` adds up whole buckets, whole ranges and the numbered rows.
``with_tile`` takes the (value, id) of each edge's row and compares every row's
key with them. Both plans are lazy, sort or write nothing as a whole, and start
no job before the action; rows read again are shuffled once for both uses.

Order is ascending: null first, then negative infinity, numbers (-0.0 equals
0.0), infinity, NaN last; equal values by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 512       # buckets per doubling of the value
_OFFSET = 1 << 21  # above |log2| * _STEPS of any double
_ID_BITS = 20      # ids of a range share all but these bits, so it has at most 2**20


def tile_sql(rn: str, total: str, k: int) -> str:
    """Tile (1..k) of the row with 1-based rank ``rn`` among ``total`` rows as
    SQL text, in exact integer arithmetic."""
    q = f"({total} div {k})"                 # rows per small tile
    r = f"({total} % {k})"                   # tiles holding one extra row
    big = f"({r} * ({q} + 1))"               # rows covered by the larger tiles
    # q == 0 only when total < k, and then every row satisfies rn <= big; the
    # divisor is still kept non-zero so no branch can fail under ANSI mode.
    return (
        f"CAST(CASE WHEN {rn} <= {big} THEN ({rn} - 1) div ({q} + 1) + 1 "
        f"ELSE {r} + ({rn} - {big} - 1) div greatest({q}, 1) + 1 END AS INT)")


_BUCKET = f"""
         CASE WHEN isnan(VALUE) THEN {_OFFSET << 2} WHEN VALUE = double('infinity') THEN {_OFFSET << 1}
              WHEN VALUE = -double('infinity') THEN -{_OFFSET << 1}
              WHEN VALUE > 0 THEN CAST(floor(log2(abs(VALUE)) * {_STEPS}) AS BIGINT) + {_OFFSET}
              WHEN VALUE < 0 THEN -CAST(floor(log2(abs(VALUE)) * {_STEPS}) AS BIGINT) - {_OFFSET}
              WHEN VALUE = 0 THEN 0 END"""

_SUMS = """
WITH base AS (SELECT id, v, a, {bucket} AS b FROM {{rows}}),
coarse AS (
  SELECT b, count(id) AS n, count(v) AS m, coalesce(sum(v), 0D) AS s, sum(a) AS d FROM base GROUP BY b),
placed AS (
  SELECT *, upto - n + 1 AS first FROM (
    SELECT *, sum(n) OVER (ORDER BY b NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto,
           sum(n) OVER () AS total FROM coarse)),
buckets AS (SELECT *, {tile_first} AS lo, {tile_upto} AS hi FROM placed),
-- One row per bucket with an edge, at most k - 1. Naming the sums here too (the
-- comparisons always hold) keeps both uses of the bucket table the same plan, so
-- that it is made once.
edges AS (
  SELECT b AS eb, first - 1 AS before, total FROM buckets
  WHERE lo < hi AND m >= 0 AND s >= -double('infinity') AND coalesce(d, 0) >= -9223372036854775807),
again AS (
  SELECT /*+ REPARTITION(b, v, part) */ * FROM (
    SELECT /*+ BROADCAST(edges) */ b, v, shiftright(id, {id_bits}) AS part, id, a, before, total
    FROM base JOIN edges ON b <=> eb)),
fine AS (
  SELECT *, upto - n + 1 AS first FROM (
    SELECT *, before + sum(n) OVER (PARTITION BY b ORDER BY v NULLS FIRST, part
                                    ROWS UNBOUNDED PRECEDING) AS upto
    FROM (SELECT b, v, part, count(id) AS n, sum(a) AS d, first(before) AS before, first(total) AS total
          FROM again GROUP BY b, v, part))),
ranges AS (SELECT *, {tile_first} AS lo, {tile_upto} AS hi FROM fine),
-- A range with an edge meets its rows, another one stays a row by itself. Naming
-- all columns of the rows lets both reads of them share one shuffle.
inside AS (
  SELECT lo, x.v, n, d, coalesce(r.total, x.total) AS total, r.id, r.a, greatest(first - 1, coalesce(r.before, 0))
         + row_number() OVER (PARTITION BY x.b, x.v, x.part ORDER BY r.id) AS rank
  FROM ranges x LEFT JOIN again r ON lo < hi AND x.b <=> r.b AND x.v <=> r.v AND x.part <=> r.part),
parts AS (
  SELECT lo AS tile, n, m, s, d FROM buckets WHERE lo = hi
  UNION ALL
  SELECT if(id IS NULL, lo, {tile_rank}), if(id IS NULL, n, 1), if(v IS NULL, 0, if(id IS NULL, n, 1)),
         coalesce(v * if(id IS NULL, n, 1), 0D), if(id IS NULL, d, a) FROM inside)
SELECT tile, sum(n) AS n, sum(m) AS m, sum(s) AS s, sum(d) AS d FROM parts GROUP BY tile
"""

_CUTS = """
WITH base AS (SELECT id, v, {bucket} AS b FROM {{rows}}),
placed AS (
  SELECT b, n, sum(n) OVER (ORDER BY b NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER () AS total
  FROM (SELECT b, count(1) AS n FROM base GROUP BY b)),
edges AS (
  SELECT b AS eb, upto - n AS before, ranks FROM (
    SELECT *, filter(transform(sequence(1, {k} - 1), j -> j * (total div {k}) + least(j, total % {k})),
                     r -> r > upto - n AND r <= upto) AS ranks FROM placed) WHERE size(ranks) > 0),
again AS (
  SELECT /*+ REPARTITION(b, v, part) */ * FROM (
    SELECT /*+ BROADCAST(edges) */ b, v, shiftright(id, {id_bits}) AS part, id, before, ranks
    FROM base JOIN edges ON b <=> eb)),
fine AS (
  SELECT *, before + sum(n) OVER (PARTITION BY b ORDER BY v NULLS FIRST, part
                                  ROWS UNBOUNDED PRECEDING) AS upto
  FROM (SELECT b, v, part, count(1) AS n, first(before) AS before, first(ranks) AS ranks
        FROM again GROUP BY b, v, part)),
numbered AS (
  SELECT r.v, r.id, r.ranks, greatest(upto - n, r.before)
         + row_number() OVER (PARTITION BY x.b, x.v, x.part ORDER BY r.id) AS rank
  FROM fine x JOIN again r ON x.b <=> r.b AND x.v <=> r.v AND x.part <=> r.part
  WHERE exists(x.ranks, e -> e > upto - n AND e <= upto))
SELECT collect_list(struct(v, id)) AS cuts FROM numbered WHERE array_contains(ranks, rank)
"""


def tile_sums(df: DataFrame, k: int, value: Column, tie: Column, amount: Column) -> DataFrame:
    """Per tile of ``ntile(k)`` ordered by (value nulls first, tie): ``tile``,
    ``n`` rows, ``m`` rows with a value, ``s`` their sum, ``d`` the sum of
    ``amount`` (an integer column). ``tie`` is a unique long.

    Equals grouping by the tile of every row for any data: ties, nulls,
    infinities and NaN included. One SQL statement, so that the plan is analysed once.
    """
    if k <= 0:
        raise ValueError("ntile needs a positive number of tiles")
    rows = df.select(tie.cast("long").alias("id"), value.cast("double").alias("v"),
                     amount.cast("long").alias("a"))
    return df.sparkSession.sql(_SUMS.format(
        bucket=_BUCKET.replace("VALUE", "v"), id_bits=_ID_BITS,
        tile_first=tile_sql("first", "total", k), tile_upto=tile_sql("upto", "total", k),
        tile_rank=tile_sql("rank", "total", k)), rows=rows)


def with_tile(df: DataFrame, k: int, value: Column, tie: Column, out_col: str = "ntile") -> DataFrame:
    """``df`` with the tile (1..k) of every row, ordered by (value nulls first,
    tie). ``value`` is any numeric column, ``tie`` a unique long.

    The edges' keys are a scalar subquery of at most k - 1 entries, so the table
    itself passes through without shuffle; each row compares its key with them.
    """
    if k <= 0:
        raise ValueError("ntile needs a positive number of tiles")
    if k == 1:
        return df.withColumn(out_col, F.lit(1))
    rows = df.select(tie.cast("long").alias("id"), value.alias("v"))
    cuts = df.sparkSession.sql(_CUTS.format(
        bucket=_BUCKET.replace("VALUE", "CAST(v AS DOUBLE)"), k=k, id_bits=_ID_BITS), rows=rows)
    key = F.struct(value.alias("v"), tie.cast("long").alias("id"))
    name = "_ln_cuts"  # a column first: no subquery may stand in a higher-order function
    while name in df.columns:
        name += "_"
    below = F.filter(name, lambda cut: cut < key)
    return df.withColumn(name, cuts.scalar()).withColumn(out_col, (F.size(below) + 1).cast("int")).drop(name)
