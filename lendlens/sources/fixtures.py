"""Portfolio tables derived from the driver's star-schema tables.

The application workload reads a loan-application table; the test data ships
TPC-H-like ``orders``/``customer``/``events`` instead. Each view below is a
deterministic SQL projection of those tables (one application per order),
written once and used by both engines: Spark builds it with ``selectExpr``,
the DuckDB oracle inlines the same text as a CTE. Only the weekday differs
between the dialects.

All work scales with the input: the views are plain projections of a join
that Spark plans like any other (``orders`` is the large side; ``customer``
is broadcast only when its measured size is under the session's broadcast
threshold, otherwise the join is a shuffle join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schema import (BUREAU_COLS, CATEGORICAL_COLS, FLAG_COLS, ID_COL,
                      NUMERIC_COLS)
from . import readers

# --- Fixed values: fixture column expressions (see FIXTURES.md) -------------
# name -> SQL expression over ``orders o JOIN customer c``; ``{weekday}`` is
# filled per dialect.
_APPLICATION_EXPRS = (
    ("SK_ID_CURR", "o.o_orderkey"),
    ("TARGET", "CASE WHEN (o.o_orderkey*31)%1000 < CASE WHEN o.o_orderstatus='F' THEN 250 ELSE 50 END THEN 1 ELSE 0 END"),
    ("NAME_CONTRACT_TYPE", "CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Revolving loans' ELSE 'Cash loans' END"),
    ("CODE_GENDER", "CASE o.o_custkey%3 WHEN 0 THEN 'M' ELSE 'F' END"),
    ("NAME_TYPE_SUITE", "CASE WHEN o.o_orderkey%11=0 THEN NULL WHEN o.o_orderkey%2=0 THEN 'Unaccompanied' ELSE 'Family' END"),
    ("NAME_INCOME_TYPE", "CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Working' WHEN 'AUTOMOBILE' THEN 'Commercial associate' WHEN 'BUILDING' THEN 'State servant' WHEN 'HOUSEHOLD' THEN 'Pensioner' ELSE NULL END"),
    ("NAME_EDUCATION_TYPE", "CASE o.o_custkey%4 WHEN 0 THEN 'Higher education' WHEN 1 THEN 'Secondary / secondary special' WHEN 2 THEN 'Incomplete higher' ELSE 'Lower secondary' END"),
    ("NAME_FAMILY_STATUS", "CASE o.o_custkey%5 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single / not married' WHEN 2 THEN 'Civil marriage' WHEN 3 THEN 'Separated' ELSE 'Widow' END"),
    ("NAME_HOUSING_TYPE", "CASE o.o_custkey%7 WHEN 0 THEN 'Rented apartment' WHEN 1 THEN 'With parents' WHEN 2 THEN 'Municipal apartment' ELSE 'House / apartment' END"),
    ("OCCUPATION_TYPE", "CASE o.o_custkey%6 WHEN 0 THEN NULL WHEN 1 THEN 'Laborers' WHEN 2 THEN 'Managers' ELSE 'Sales staff' END"),
    ("WEEKDAY_APPR_PROCESS_START", "{weekday}"),
    ("ORGANIZATION_TYPE", "CASE c.c_nationkey%3 WHEN 0 THEN 'Self-employed' WHEN 1 THEN 'School' ELSE 'XNA' END"),
    ("FONDKAPREMONT_MODE", "CASE WHEN o.o_orderkey%3=0 THEN 'reg oper account' ELSE NULL END"),
    ("HOUSETYPE_MODE", "CASE WHEN o.o_orderkey%2=0 THEN 'block of flats' ELSE NULL END"),
    ("WALLSMATERIAL_MODE", "CASE o.o_orderkey%4 WHEN 0 THEN 'Panel' WHEN 1 THEN 'Wooden' ELSE NULL END"),
    ("EMERGENCYSTATE_MODE", "CASE o.o_orderkey%10 WHEN 0 THEN 'Yes' WHEN 1 THEN NULL ELSE 'No' END"),
    ("FLAG_OWN_CAR", "CASE WHEN o.o_custkey%2=0 THEN 'Y' ELSE 'N' END"),
    ("FLAG_OWN_REALTY", "CASE WHEN o.o_custkey%3=0 THEN 'N' ELSE 'Y' END"),
    ("CNT_CHILDREN", "CAST((o.o_custkey*7+o.o_orderkey)%5 AS INT)"),
    ("AMT_INCOME_TOTAL", "CASE WHEN c.c_acctbal<0 THEN CAST(0 AS DOUBLE) ELSE c.c_acctbal*10 END"),
    ("AMT_CREDIT", "o.o_totalprice"),
    ("AMT_ANNUITY", "o.o_totalprice/20"),
    ("AMT_GOODS_PRICE", "CASE WHEN o.o_orderkey%13=0 THEN NULL ELSE o.o_totalprice*0.9e0 END"),
    ("REGION_POPULATION_RELATIVE", "CAST(c.c_nationkey AS DOUBLE)/1e3"),
    ("DAYS_BIRTH", "CAST(CASE WHEN o.o_orderkey%97=0 THEN NULL ELSE -(7000+(o.o_orderkey*37)%18000) END AS INT)"),
    ("DAYS_EMPLOYED", "CAST(CASE WHEN o.o_custkey%6=0 THEN 365243 WHEN o.o_orderkey%89=0 THEN NULL ELSE -((o.o_orderkey*13)%6000) END AS INT)"),
    ("DAYS_REGISTRATION", "CAST(-((o.o_orderkey*17)%8000) AS DOUBLE)"),
    ("DAYS_ID_PUBLISH", "CAST(-((o.o_orderkey*19)%6000) AS INT)"),
    ("OWN_CAR_AGE", "CAST(CASE WHEN o.o_custkey%2=0 THEN o.o_orderkey%30 ELSE NULL END AS DOUBLE)"),
    ("CNT_FAM_MEMBERS", "CAST((o.o_custkey*7+o.o_orderkey)%5+1+o.o_custkey%2 AS DOUBLE)"),
    ("EXT_SOURCE_1", "CASE WHEN o.o_orderkey%2=0 THEN NULL ELSE CAST((o.o_orderkey*29)%1000 AS DOUBLE)/1e3 END"),
    ("EXT_SOURCE_2", "CAST((o.o_orderkey*31)%1000 AS DOUBLE)/1e3"),
    ("EXT_SOURCE_3", "CASE WHEN o.o_orderkey%5=0 THEN NULL ELSE CAST((o.o_orderkey*37)%1000 AS DOUBLE)/1e3 END"),
    ("OBS_30_CNT_SOCIAL_CIRCLE", "CAST(o.o_orderkey%9 AS DOUBLE)"),
    ("DEF_30_CNT_SOCIAL_CIRCLE", "CAST(o.o_orderkey%3 AS DOUBLE)"),
    ("OBS_60_CNT_SOCIAL_CIRCLE", "CAST(o.o_orderkey%9 AS DOUBLE)"),
    ("DEF_60_CNT_SOCIAL_CIRCLE", "CAST(o.o_orderkey%2 AS DOUBLE)"),
    ("DAYS_LAST_PHONE_CHANGE", "CAST(-((o.o_orderkey*23)%4000) AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_HOUR", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE CASE WHEN o.o_orderkey%50=1 THEN 1 ELSE 0 END END AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_DAY", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE CASE WHEN o.o_orderkey%40=1 THEN 1 ELSE 0 END END AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_WEEK", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE CASE WHEN o.o_orderkey%30=1 THEN 1 ELSE 0 END END AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_MON", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE o.o_orderkey%3 END AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_QRT", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE o.o_orderkey%2 END AS DOUBLE)"),
    ("AMT_REQ_CREDIT_BUREAU_YEAR", "CAST(CASE WHEN o.o_orderkey%7=0 THEN NULL ELSE o.o_custkey%12 END AS DOUBLE)"),
)

_WEEKDAY = {
    "spark": "upper(date_format(o.o_orderdate,'EEEE'))",
    "duckdb": "upper(dayname(o.o_orderdate))",
}

# Stand-in score of the ``scored`` view: reaches the 0.40 and 0.70 edges.
_RISK_SCORE_EXPR = "CASE WHEN SK_ID_CURR%101=0 THEN NULL ELSE CAST((SK_ID_CURR*53)%1000 AS DOUBLE)/1e3 END"
_PREDICTION_EXPR = "CASE WHEN risk_score>=5e-1 THEN 1e0 ELSE 0e0 END"

# Identity records exist for every application except one in ten.
_IDENTITY_KEEP = "o.o_orderkey%10<>0"

# The portfolio with values outside the usual ones: statuses, flags and codes
# nobody listed, nulls, and tenures above 100 years.
_UNUSUAL_EXPRS = {
    "NAME_FAMILY_STATUS": "CASE WHEN SK_ID_CURR%23=0 THEN 'Unknown' WHEN SK_ID_CURR%29=0 THEN NULL ELSE NAME_FAMILY_STATUS END",
    "FLAG_OWN_REALTY": "CASE WHEN SK_ID_CURR%19=0 THEN 'X' WHEN SK_ID_CURR%31=0 THEN NULL ELSE FLAG_OWN_REALTY END",
    "DAYS_EMPLOYED": "CASE WHEN SK_ID_CURR%17=0 THEN CAST(-36600-(SK_ID_CURR%9000) AS INT) ELSE DAYS_EMPLOYED END",
    "CODE_GENDER": "CASE WHEN SK_ID_CURR%13=0 THEN 'XNA' ELSE CODE_GENDER END",
    "NAME_INCOME_TYPE": "CASE WHEN SK_ID_CURR%11=0 THEN 'Student' WHEN SK_ID_CURR%37=0 THEN 'Entrepreneur' ELSE NAME_INCOME_TYPE END",
    "NAME_EDUCATION_TYPE": "CASE WHEN SK_ID_CURR%41=0 THEN 'Academic degree' WHEN SK_ID_CURR%43=0 THEN 'None' ELSE NAME_EDUCATION_TYPE END",
    "NAME_HOUSING_TYPE": "CASE WHEN SK_ID_CURR%47=0 THEN 'Co-op apartment' WHEN SK_ID_CURR%53=0 THEN 'Office apartment' WHEN SK_ID_CURR%59=0 THEN 'Boat' ELSE NAME_HOUSING_TYPE END",
    "WEEKDAY_APPR_PROCESS_START": "CASE WHEN SK_ID_CURR%61=0 THEN NULL ELSE WEEKDAY_APPR_PROCESS_START END",
}

# Ids asked for by the lookup example: five present at every scale, one absent.
REQUESTED_IDS = (0, 1, 7, 97, 1499, -1)

# Feedback bodies as people send them: broken lines, absent keys, nulls and
# flags that aren't booleans. ``{id}`` and ``{type}`` are put in per dialect.
_RAW_BODY = (
    "CASE WHEN event_id%11=0 THEN '{{not json' WHEN event_id%13=0 THEN '[1]' WHEN event_id%17=0 THEN '' "
    "WHEN event_id%19=0 THEN '{{}}' ELSE "
    "concat('{{\"event_id\": ', {id}, CASE WHEN event_id%3=0 THEN '' WHEN event_id%7=0 THEN ', \"message\": null' "
    "ELSE concat(', \"message\": \"', event_type, '\"') END, CASE event_id%16 WHEN 0 THEN '' "
    "WHEN 1 THEN ', \"is_positive\": 1' WHEN 2 THEN ', \"is_positive\": 0' WHEN 3 THEN ', \"is_positive\": \"false\"' "
    "WHEN 4 THEN ', \"is_positive\": \"\"' WHEN 5 THEN ', \"is_positive\": null' WHEN 6 THEN ', \"is_positive\": []' "
    "WHEN 7 THEN ', \"is_positive\": [0]' WHEN 8 THEN ', \"is_positive\": {{}}' WHEN 9 THEN ', \"is_positive\": 0.0' "
    "WHEN 10 THEN ', \"is_positive\": -2.5' WHEN 11 THEN ', \"is_positive\": false' WHEN 12 THEN ', \"is_positive\": \"0\"' "
    "ELSE ', \"is_positive\": true' END, '}}') END"
)

# Feedback records derived from ``events``.
_FEEDBACK_EXPRS = (
    ("event_id", "event_id"),
    ("message", "CASE WHEN event_id%10=0 THEN NULL ELSE event_type END"),
    ("is_positive", "CASE WHEN event_id%7=0 THEN NULL ELSE event_type<>'error' END"),
)
# ---------------------------------------------------------------------------


def application_exprs(dialect: str = "spark", with_label: bool = True) -> list[str]:
    out = []
    for name, expr in _APPLICATION_EXPRS:
        if name == "TARGET" and not with_label:
            continue
        out.append(f"{expr.format(weekday=_WEEKDAY[dialect])} AS {name}")
    return out


# Schemas of the driver tables read here (given, so no footer-inference job
# runs per query).
_TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.schema(_TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").alias("o")
    c = _table(spark, sf_dir, "customer").alias("c")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner")


def applications(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Labelled portfolio (44 columns, or those named), one row per order."""
    names = [name for name, _ in _APPLICATION_EXPRS]
    return _orders_customers(spark, sf_dir).selectExpr(
        *[e for name, e in zip(names, application_exprs("spark")) if columns is None or name in columns])


# NaN, infinities and nulls among the credits
_ODD_CREDIT = ("CASE SK_ID_CURR % 11 WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 4 THEN CAST('Infinity' AS DOUBLE) "
               "WHEN 5 THEN CAST('-Infinity' AS DOUBLE) WHEN 8 THEN NULL ELSE AMT_CREDIT END")


def odd_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications (SK_ID_CURR, AMT_CREDIT, TARGET) with NaN, infinite and missing credits."""
    return applications(spark, sf_dir, ("SK_ID_CURR", "AMT_CREDIT", "TARGET")).selectExpr(
        "SK_ID_CURR", f"{_ODD_CREDIT} AS AMT_CREDIT", "TARGET")


def duckdb_odd_amounts() -> str:
    """The same over a DuckDB relation ``applications``."""
    return f"SELECT SK_ID_CURR, {_ODD_CREDIT} AS AMT_CREDIT, TARGET FROM applications"


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring input: the same rows without ``TARGET``."""
    return _orders_customers(spark, sf_dir).selectExpr(
        *application_exprs("spark", with_label=False))


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity records (id, name, photo) with one in ten applicants missing."""
    known = _orders_customers(spark, sf_dir).where(_IDENTITY_KEEP)
    return readers.identities(known.select("o_orderkey", "c_name"), "o_orderkey", "c_name")


def feedback_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback bodies as typed records; ``custom_dimensions`` parsed from
    the JSON ``props`` text."""
    ev = _table(spark, sf_dir, "events")
    return ev.selectExpr(
        *[f"{e} AS {n}" for n, e in _FEEDBACK_EXPRS],
        "from_json(props, 'map<string,string>') AS custom_dimensions")


def feedback_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback lines as text, broken ones included: (event_id, value)."""
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{_RAW_BODY.format(id='CAST(event_id AS STRING)')} AS value")


def unusual_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portfolio with unlisted and missing values."""
    apps = applications(spark, sf_dir)
    return apps.selectExpr(*[f"{_UNUSUAL_EXPRS[c]} AS {c}" if c in _UNUSUAL_EXPRS else c for c in apps.columns])


def requested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of ids to look up, some of which have no application."""
    return _table(spark, sf_dir, "customer").selectExpr("c_custkey*3 AS SK_ID_CURR")


def unusual_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored view over unlisted and missing values."""
    return _scored(unusual_applications(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared applicants with a deterministic stand-in ``risk_score`` and
    ``prediction``, so decision rules can be checked without a model."""
    return _scored(applications(spark, sf_dir))


def _scored(apps: DataFrame) -> DataFrame:
    from ..operators.scoring import prepare_features
    base = prepare_features(apps)
    return (base.selectExpr("*", f"{_RISK_SCORE_EXPR} AS risk_score")
                .selectExpr("*", f"{_PREDICTION_EXPR} AS prediction"))


# --- DuckDB text of the same views (used by the oracle queries) -------------

def duckdb_applications_cte(name: str = "applications", with_label: bool = True) -> str:
    cols = ",\n    ".join(application_exprs("duckdb", with_label))
    return (f"{name} AS (\n  SELECT\n    {cols}\n"
            f"  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey\n)")


def duckdb_prepared_select(source: str = "applications") -> str:
    """``prepare_features`` in DuckDB SQL: numeric -> DOUBLE, categorical ->
    text with 'Unknown' for null, flags -> 0/1; other columns unchanged."""
    parts = [ID_COL, "TARGET"]
    parts += [f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_COLS]
    parts += [f"COALESCE(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in CATEGORICAL_COLS]
    parts += [f"CASE WHEN CAST({c} AS VARCHAR) IN ('Y','1') THEN 1 ELSE 0 END AS {c}" for c in FLAG_COLS]
    parts += list(BUREAU_COLS)
    return f"SELECT {', '.join(parts)} FROM {source}"


def duckdb_unusual_cte(source: str = "usual", name: str = "applications") -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in _UNUSUAL_EXPRS.items())
    return duckdb_applications_cte(source) + f",\n{name} AS (SELECT * REPLACE ({cols}) FROM {source})"


def duckdb_bodies_cte(name: str = "bodies") -> str:
    body = _RAW_BODY.format(id="CAST(event_id AS VARCHAR)")
    return f"{name} AS (SELECT event_id, event_type, {body} AS value FROM events)"


def duckdb_scored_ctes(apps: str | None = None) -> str:
    return ((apps or duckdb_applications_cte()) + ",\n"
            f"prepared AS ({duckdb_prepared_select()}),\n"
            f"scored0 AS (SELECT *, {_RISK_SCORE_EXPR} AS risk_score FROM prepared),\n"
            f"scored AS (SELECT *, {_PREDICTION_EXPR} AS prediction FROM scored0)")


def duckdb_identities_cte(name: str = "identities") -> str:
    return (f"{name} AS (SELECT o.o_orderkey AS SK_ID_CURR, c.c_name AS client_name, "
            f"CAST(NULL AS VARCHAR) AS photo_url FROM orders o JOIN customer c "
            f"ON o.o_custkey = c.c_custkey WHERE {_IDENTITY_KEEP})")


def duckdb_feedback_cte(name: str = "feedback") -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in _FEEDBACK_EXPRS)
    return f"{name} AS (SELECT {cols}, props FROM events)"
