"""Typed schema of a loan-application table and its column groups.

The portfolio table is read with an explicit ``StructType`` instead of schema
inference: types are stable across files and no extra pass over the data is
needed to guess them. Extra columns in a source are dropped by column pruning.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID_COL = "SK_ID_CURR"
LABEL_COL = "TARGET"

# --- Fixed values: column groups named by the application workload ---------
NUMERIC_COLS = (
    "CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
    "AMT_GOODS_PRICE", "REGION_POPULATION_RELATIVE", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH",
    "OWN_CAR_AGE", "CNT_FAM_MEMBERS", "EXT_SOURCE_1",
    "EXT_SOURCE_2", "EXT_SOURCE_3", "OBS_30_CNT_SOCIAL_CIRCLE",
    "DEF_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
    "DEF_60_CNT_SOCIAL_CIRCLE", "DAYS_LAST_PHONE_CHANGE",
)

CATEGORICAL_COLS = (
    "NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_TYPE_SUITE",
    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE", "OCCUPATION_TYPE", "WEEKDAY_APPR_PROCESS_START",
    "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
)

FLAG_COLS = ("FLAG_OWN_CAR", "FLAG_OWN_REALTY")

BUREAU_COLS = (
    "AMT_REQ_CREDIT_BUREAU_HOUR", "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_WEEK", "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_YEAR",
)

# ---------------------------------------------------------------------------

# Storage types of the numeric columns; integer day offsets and counts stay
# integral on disk and become doubles only in ``prepare_features``.
_INT_NUMERIC = {"CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH"}


def _numeric_type(name: str) -> T.DataType:
    return T.IntegerType() if name in _INT_NUMERIC else T.DoubleType()


def application_schema(with_label: bool = True) -> T.StructType:
    """The 44-column application schema (43 without ``TARGET``)."""
    fields = [T.StructField(ID_COL, T.LongType(), False)]
    if with_label:
        fields.append(T.StructField(LABEL_COL, T.IntegerType(), True))
    fields += [T.StructField(c, T.StringType(), True) for c in CATEGORICAL_COLS]
    fields += [T.StructField(c, T.StringType(), True) for c in FLAG_COLS]
    fields += [T.StructField(c, _numeric_type(c), True) for c in NUMERIC_COLS]
    fields += [T.StructField(c, T.DoubleType(), True) for c in BUREAU_COLS]
    return T.StructType(fields)


APPLICATION_SCHEMA = application_schema(True)
APPLICANT_SCHEMA = application_schema(False)
