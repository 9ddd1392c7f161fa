"""The application's three entry points as DataFrame functions.

* ``dataviz`` — one cohort analysis under amount filters, plus its chart
  metadata (the chart-data request; analysis 2 by default, as there).
* ``predict`` — the per-client answer (report, score, recommendation, run
  stamp, or the not-found message) for any number of ids, from a saved model.
* ``log_feedback`` — normalise feedback records and append them by level.

Nothing is collected: each returns a DataFrame (and plain metadata) for the
caller to write, show or collect.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from .operators import cohorts, decisions, scoring
from .streaming import feedback


def dataviz(applications: DataFrame, analysis_type: int | str = 2,
            filters: Mapping | None = None) -> tuple[DataFrame, dict]:
    """Cohort result and its metadata (chart type, title, filters, axes)."""
    result = cohorts.analyse(applications, analysis_type, filters=filters)
    return result, cohorts.metadata(analysis_type, filters)


def predict(applicants: DataFrame, client_ids, preprocessor: PipelineModel, model,
            run_ts: dt.datetime | None = None) -> DataFrame:
    """Score the requested applicants with the saved pipeline and model and
    answer per id (``found``/``error``, ``client_info``, ``prediction``,
    ``recommendation``, ``metadata``). The ids are looked up before scoring,
    so only their rows go through the model."""
    from .operators.filters import lookup
    wanted = lookup(applicants, client_ids)
    scored = scoring.score(wanted, preprocessor, model)
    return decisions.client_response(scored, client_ids, run_ts or dt.datetime.now())


def log_feedback(records: DataFrame, path: str, checkpoint: str | None = None):
    """Normalise typed feedback records (batch or stream) and append them to
    ``path`` partitioned by level; returns the streaming query for a stream."""
    return feedback.write_feedback(feedback.normalise_feedback(records), path, checkpoint)
