"""Result sinks: records, client responses, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.cohorts import as_records  # noqa: F401  (re-exported)
from ..operators.scoring import score_response  # noqa: F401  (re-exported)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """Write any result DataFrame (cohort result, scored portfolio, nested
    client responses) without collecting it."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
