"""Decision and presentation rules as columns over a scored table.

Per-client rules of the application (risk level, recommendation, display
formatting, run stamp) become column expressions evaluated for every row in
one projection. Lookup tables are literal maps (``create_map``) compiled into
the plan, so no join or broadcast is involved; the recommendation table has
three entries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.bands import risk_level
from ..schema import ID_COL
from .filters import lookup
from .scoring import CLIENT_INFO, score_report


def _literal_map(mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), v if isinstance(v, Column) else F.lit(v)]
    return F.create_map(*pairs)


def translate(col: str | Column, mapping: dict) -> Column:
    """Display label for a code; unknown codes (and null) pass unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(_literal_map(mapping), c), c)


def with_risk_level(df: DataFrame, score_col: str = "risk_score",
                    out_col: str = "risk_level") -> DataFrame:
    return df.withColumn(out_col, risk_level(score_col))


def _recommendation_map() -> Column:
    entries = {}
    for rec in L.RECOMMENDATIONS:
        entries[rec["risk_level"]] = F.struct(
            F.lit(rec["decision"]).alias("decision"),
            F.lit(rec["explanation"]).alias("explanation"),
            F.lit(rec["alternative"]).alias("alternative"),
            F.lit(rec["risk_level"]).alias("risk_level"),
            F.array(*[F.lit(a) for a in rec["action_plan"]]).alias("action_plan"))
    return _literal_map(entries)


def recommend(scored: DataFrame, score_col: str = "risk_score",
              out_col: str = "recommendation") -> DataFrame:
    """Add the recommendation struct (decision, explanation, alternative,
    risk level, four-step action plan) chosen by the score's risk level.
    A null score gives a null recommendation; the row is kept."""
    level = risk_level(score_col)
    return scored.withColumn(out_col, F.try_element_at(_recommendation_map(), level))


def format_client(report: DataFrame) -> DataFrame:
    """Display form of a client report: whole-number amounts (half to even),
    tenure to one decimal (values above 100 first taken modulo 100), and the
    French labels of gender, income type, education, family status and
    housing. Unknown codes are left as they are.

    Rounding is ``bround`` on the value's shortest decimal form; it can
    differ from binary half-even rounding on exact ties such as 0.35. A
    tenure that rounds to zero keeps its sign (``-0.0`` stays ``-0.0``), as
    float rounding does.
    """
    ye = F.col("years_employed")
    rounded = F.when(ye > 100, F.bround(ye % 100, 1)).otherwise(F.bround(ye, 1))
    t = L.TRANSLATIONS
    return report.withColumns({
        "age": F.col("age").cast("int"),
        "years_employed": F.when(rounded == 0, F.lit(0.0) * F.signum(ye)).otherwise(rounded),
        "income": F.bround(F.col("income"), 0).cast("long"),
        "credit_amount": F.bround(F.col("credit_amount"), 0).cast("long"),
        "gender": translate("gender", t["gender"]),
        "income_type": translate("income_type", t["income_type"]),
        "education_type": translate("education_type", t["education_type"]),
        "family_status": translate("family_status", t["family_status"]),
        "housing_type": translate("housing_type", t["housing_type"]),
    })


def stamp(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Run metadata columns. The run time is an argument so a rerun of the
    same job gives the same output."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumns({
        "analysis_date": F.date_format(ts, L.DATE_FORMAT),
        "analysis_time": F.date_format(ts, L.TIME_FORMAT),
        **{k: F.lit(v) for k, v in L.STAMP.items()},
    })


def client_dossier(report: DataFrame, identities: DataFrame, id_col: str = ID_COL,
                   report_id_col: str = "client_id") -> DataFrame:
    """Client file: every scored client with its identity (name, photo) when
    one exists. Both sides grow with the portfolio, so the join strategy is
    left to Spark/AQE (shuffle join, or broadcast when the measured size of
    the identity side is under the threshold)."""
    ids = identities.withColumnRenamed(id_col, report_id_col)
    return report.join(ids, report_id_col, "left")


def risk_level_summary(scored: DataFrame, score_col: str = "risk_score",
                       credit_col: str = "AMT_CREDIT") -> DataFrame:
    """Portfolio by risk level: clients, mean score, total credit. Rows
    without a score form their own (null) level."""
    return (scored.groupBy(risk_level(score_col).alias("risk_level"))
                  .agg(F.count(F.lit(1)).alias("CLIENT_COUNT"),
                       F.round(F.avg(score_col), 4).alias("AVG_SCORE"),
                       F.round(F.sum(credit_col), 2).alias("TOTAL_CREDIT")))


_STAMP_FIELDS = ("analysis_date", "analysis_time", *L.STAMP.keys())


def client_response(scored: DataFrame, ids, run_ts: dt.datetime,
                    id_col: str = ID_COL) -> DataFrame:
    """The per-client answer for requested ids, one row per id, as one plan:
    lookup (with not-found report) -> client report -> display formatting
    -> recommendation -> run stamp. A missing id gets ``found = false`` and
    the not-found message in ``error``; its other fields are null.

    ``ids`` is a list (pushed down as ``IN``) or a DataFrame of ids.
    """
    looked = lookup(scored, ids, id_col, report_missing=True)
    answer = stamp(recommend(format_client(score_report(looked, keep=("found",)))), run_ts)
    found = F.col("found")
    return answer.select(
        "client_id", "found",
        F.when(~found, F.format_string(L.CLIENT_NOT_FOUND, F.col("client_id"))).alias("error"),
        F.when(found, F.struct(*CLIENT_INFO)).alias("client_info"),
        F.when(found, F.struct("risk_score", "predicted_default")).alias("prediction"),
        F.when(found, F.col("recommendation")).alias("recommendation"),
        F.when(found, F.struct(*_STAMP_FIELDS)).alias("metadata"))
