from __future__ import annotations

import pytest

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with columns whose names clash with results."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        if extra:
            from pyspark.sql import functions as F
            for name in ("spans", "hits", "kept", "score", "start", "rep", "bucket", "x", "key", "path"):
                df = df.withColumn(name, F.lit(name))
        return df.repartition(3)
    return make


@pytest.fixture(scope="session")
def rows_of():
    def rows(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()),
                      key=lambda r: tuple((x is not None, x) for x in r))
    return rows
