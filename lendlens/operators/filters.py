"""Portfolio filters, segment filters and id lookup.

Filters are plain predicates so Catalyst pushes them into the scan (they show
up as ``PushedFilters`` on the parquet source); build them before any
``persist`` so the cache holds only the rows that are needed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import risk_level
from ..schema import ID_COL


def portfolio_predicate(min_credit=None, max_credit=None, min_income=None,
                        credit_col: str = "AMT_CREDIT",
                        income_col: str = "AMT_INCOME_TOTAL") -> Column | None:
    """One predicate for the amount filters, bounds inclusive.

    A bound that is unset *or zero* is no bound (the application tests the
    bound's truthiness). Returns ``None`` when no bound applies.
    """
    conds = []
    if min_credit:
        conds.append(F.col(credit_col) >= F.lit(min_credit))
    if max_credit:
        conds.append(F.col(credit_col) <= F.lit(max_credit))
    if min_income:
        conds.append(F.col(income_col) >= F.lit(min_income))
    return reduce(lambda a, b: a & b, conds) if conds else None


def portfolio_filter(df: DataFrame, min_credit=None, max_credit=None,
                     min_income=None, **cols) -> DataFrame:
    pred = portfolio_predicate(min_credit, max_credit, min_income, **cols)
    return df if pred is None else df.where(pred)


def _as_values(v) -> list | None:
    if v is None:
        return None
    if isinstance(v, str) or not isinstance(v, Iterable):
        return [v]
    return list(v)


def segment_filter(df: DataFrame, segment=None, product=None, risk_levels=None,
                   segment_col: str = "NAME_INCOME_TYPE",
                   product_col: str = "NAME_CONTRACT_TYPE",
                   score_col: str = "risk_score") -> DataFrame:
    """Keep rows of the given income segment(s), contract product(s) and/or
    risk level(s). Risk levels are derived from ``score_col`` with the
    decision bounds, so this filter needs a scored table."""
    conds = []
    for values, col in ((_as_values(segment), F.col(segment_col)),
                        (_as_values(product), F.col(product_col))):
        if values is not None:
            conds.append(col.isin(values))
    levels = _as_values(risk_levels)
    if levels is not None:
        conds.append(risk_level(F.col(score_col)).isin(levels))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def lookup(df: DataFrame, ids, id_col: str = ID_COL,
           report_missing: bool = False) -> DataFrame:
    """Rows of ``df`` for the requested ids.

    ``ids`` is one id, a Python list of ids, or a DataFrame with ``id_col``.
    A literal list becomes an ``IN`` predicate that reaches the scan. With
    ``report_missing`` every requested id yields a row and a ``found``
    column says whether it matched (one left join, no separate count job);
    literal ids first narrow ``df`` by the pushed-down predicate so the join
    sees only matching rows and AQE can broadcast them at run time.
    """
    spark = df.sparkSession
    literal = not isinstance(ids, DataFrame)
    if literal:
        values = _as_values(ids)
        narrowed = df.where(F.col(id_col).isin(values))
        if not report_missing:
            return narrowed
        id_type = df.schema[id_col].dataType
        # The requested ids as a literal array exploded in the JVM (no rows
        # shipped from Python).
        ids_df = spark.range(1).select(F.explode(F.array(
            *[F.lit(v).cast(id_type) for v in values])).alias(id_col))
        right = narrowed
    else:
        ids_df = ids.select(id_col)
        if not report_missing:
            return df.join(ids_df, id_col, "left_semi")
        right = df
    matched = right.withColumn("_lk_hit", F.lit(True))
    return (ids_df.join(matched, id_col, "left")
                  .withColumn("found", F.col("_lk_hit").isNotNull())
                  .drop("_lk_hit"))

