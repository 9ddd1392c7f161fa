"""Exact global ``ntile`` / row number without a single-partition window.

The tile of every row under one numeric order column needs no ranks
(``tiles.with_tile``). Row numbers, and tiles under other orders, do:
``ntile(k).over(Window.orderBy(x))`` has no partition key, so Spark moves the
whole table into one task. Here the same numbers come from a distributed plan:

1. ``repartitionByRange`` on the complete sort key (order columns plus a
   unique tie column). Spark samples the key to pick slice bounds; because
   the tie column makes every key distinct, even one value holding a third of
   all rows (for instance null ratios) is spread over many slices.
2. ``sortWithinPartitions`` on the same key, then
   ``monotonically_increasing_id`` gives every row its slice (upper bits) and
   its position inside the slice (lower 33 bits).
3. The positioned rows are checkpointed to the shared checkpoint folder, so
   slice membership is frozen: the two consumers below read identical data
   even if an executor is lost and work is redone.
4. Slice sizes: one row per slice (at most ``spark.sql.shuffle.partitions``
   slices, or the count given), a running sum gives each slice's offset and
   the grand total; that table is broadcast (its size is the slice count, a
   setting, not the data).
5. Global row number = offset + position + 1; ``ntile`` follows from the row
   number and the total with the standard formula (the first ``n mod k``
   tiles hold one extra row).

The result equals ``ntile(k).over(Window.orderBy(*order, tie))`` exactly,
ascending order with nulls first as in Spark's default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import checkpoint_dir
from .tiles import tile_sql, with_tile

_POS_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index
_POS_MASK = (1 << _POS_BITS) - 1
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _sort_key(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def global_row_number(df: DataFrame, order_cols: Sequence[str], tie_col: str,
                      out_col: str = "row_number", total_col: str | None = None,
                      num_slices: int | None = None) -> DataFrame:
    """Add the 1-based global row number in ``(order_cols..., tie_col)``
    ascending, nulls-first order. ``tie_col`` must be unique per row.
    Optionally add the total row count as ``total_col``."""
    spark = df.sparkSession
    checkpoint_dir(spark)  # fail early, and never on a machine-local folder
    keys = [_sort_key(c) for c in (*order_cols, tie_col)]
    # Without a slice count AQE sizes the slices to the data (it merges
    # adjacent ranges only, so slice order stays key order); the count is at
    # most spark.sql.shuffle.partitions.
    ranged = (df.repartitionByRange(num_slices, *keys) if num_slices
              else df.repartitionByRange(*keys))

    positioned = (ranged.sortWithinPartitions(*keys)
                    .withColumn("_ln_pos", F.monotonically_increasing_id()))
    positioned = positioned.checkpoint(eager=True)
    positioned = positioned.select(
        "*",
        F.shiftright("_ln_pos", _POS_BITS).alias("_ln_slice"),
        F.col("_ln_pos").bitwiseAND(F.lit(_POS_MASK)).alias("_ln_local"))

    sizes = positioned.groupBy("_ln_slice").agg(F.count(F.lit(1)).alias("_ln_rows"))
    upto = Window.orderBy("_ln_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        "_ln_slice",
        (F.sum("_ln_rows").over(upto) - F.col("_ln_rows")).alias("_ln_before"),
        F.sum("_ln_rows").over(Window.partitionBy()).alias("_ln_total"))

    out = (positioned.join(F.broadcast(offsets), "_ln_slice")
           .withColumn(out_col, F.col("_ln_before") + F.col("_ln_local") + F.lit(1)))
    if total_col:
        out = out.withColumnRenamed("_ln_total", total_col)
    return out.drop("_ln_pos", "_ln_slice", "_ln_local", "_ln_before", "_ln_total")


def ntile_from_rank(rn: str, total: str, k: int) -> Column:
    """Tile (1..k) of the row with 1-based rank column ``rn`` among ``total``
    rows, in exact integer arithmetic."""
    return F.expr(tile_sql(rn, total, k))


def exact_ntile(df: DataFrame, k: int, order_cols: Sequence[str], tie_col: str,
                out_col: str = "ntile", num_slices: int | None = None) -> DataFrame:
    """``ntile(k)`` over the whole table ordered by ``order_cols`` then
    ``tie_col`` (unique), computed without a single-partition window.

    One numeric order column with an integer tie takes the edges' keys and
    compares (``tiles.with_tile``): no sort, no checkpoint, no job before the
    action. Other orders, or an explicit number of slices, rank the table.
    """
    if k <= 0:
        raise ValueError("ntile needs a positive number of tiles")
    kinds = dict(df.dtypes)
    if (num_slices is None and len(order_cols) == 1 and kinds.get(tie_col) in _INTEGERS
            and isinstance(df.schema[order_cols[0]].dataType, NumericType)):
        return with_tile(df, k, F.col(order_cols[0]), F.col(tie_col), out_col)
    ranked = global_row_number(df, order_cols, tie_col, out_col="_ln_rn",
                               total_col="_ln_n", num_slices=num_slices)
    return (ranked.withColumn(out_col, ntile_from_rank("_ln_rn", "_ln_n", k))
                  .drop("_ln_rn", "_ln_n"))
