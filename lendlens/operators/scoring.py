"""Feature preparation, model fitting and portfolio scoring with Spark ML.

Scoring is a whole-table operator: the saved preprocessing pipeline and the
logistic regression transform every partition in the JVM, and the class-1
probability is read with ``vector_to_array`` (no Python UDF). A single client
is just a lookup in front of the same plan.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.labels import UNKNOWN
from ..schema import CATEGORICAL_COLS, FLAG_COLS, ID_COL, LABEL_COL, NUMERIC_COLS
from ..session import checkpoint_dir

FEATURES_COL = "features"
SCORE_COL = "risk_score"


def prepare_features(df: DataFrame) -> DataFrame:
    """Type the model inputs in one projection, keeping column order.

    Numeric columns become doubles (malformed text -> null instead of an ANSI
    cast failure), categorical columns become text with ``Unknown`` for null,
    and the two Y/N flags become 1/0 (``Y`` or ``1`` -> 1, anything else,
    null included, -> 0). Columns that are absent are skipped.
    """
    exprs = []
    for c in df.columns:
        col = F.col(c)
        if c in NUMERIC_COLS:
            exprs.append(col.try_cast("double").alias(c))
        elif c in CATEGORICAL_COLS:
            exprs.append(F.coalesce(col.cast("string"), F.lit(UNKNOWN)).alias(c))
        elif c in FLAG_COLS:
            exprs.append(F.when(col.cast("string").isin("Y", "1"), 1).otherwise(0).alias(c))
        else:
            exprs.append(col)
    return df.select(*exprs)


def _feature_stages(df: DataFrame) -> list:
    nums = [c for c in NUMERIC_COLS if c in df.columns]
    cats = [c for c in CATEGORICAL_COLS if c in df.columns]
    flags = [c for c in FLAG_COLS if c in df.columns]
    imputed = [f"{c}__imp" for c in nums]
    indexed = [f"{c}__idx" for c in cats]
    encoded = [f"{c}__vec" for c in cats]
    return [
        Imputer(inputCols=nums, outputCols=imputed, strategy="mean"),
        StringIndexer(inputCols=cats, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=imputed + flags + encoded, outputCol=FEATURES_COL,
                        handleInvalid="keep"),
    ]


def fit_preprocessor(prepared: DataFrame) -> PipelineModel:
    """Imputer, string indexer, one-hot encoder and vector assembler fitted on
    prepared features (means and label counts are aggregations)."""
    return Pipeline(stages=_feature_stages(prepared)).fit(prepared)


def preprocessed_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of the imputed numeric and the indexed categorical columns that
    the preprocessor adds to ``df``."""
    return ([f"{c}__imp" for c in NUMERIC_COLS if c in df.columns],
            [f"{c}__idx" for c in CATEGORICAL_COLS if c in df.columns])


def fit_risk_model(train: DataFrame, path: str | None = None, max_iter: int = 100,
                   reg_param: float = 0.01, tol: float = 1e-6, partitions: int | None = None
                   ) -> tuple[PipelineModel, LogisticRegressionModel, str]:
    """Fit the preprocessing pipeline and a logistic regression on a labelled
    portfolio and save both under ``path`` (default: a fresh folder in the
    shared checkpoint location). Returns (preprocessor, model, path); the
    model's ``summary.totalIterations`` says how long the optimiser took.

    Fitting is distributed: the imputer means and string-index label counts
    are aggregations, and the regression optimiser aggregates gradients
    across partitions (tree aggregation), so no step collects the data.
    The training table, pruned to the model inputs, is persisted
    (memory, spilling to disk) for the duration of the fit only: the
    pipeline stages and the optimiser pass over it several times. With
    ``partitions`` it is first dealt into that many parts by client id, for a
    source of few large scan tasks. The optimiser runs to convergence; reaching ``max_iter`` first is an error.
    """
    inputs = [c for c in (*NUMERIC_COLS, *CATEGORICAL_COLS, *FLAG_COLS) if c in train.columns]
    if partitions:
        train = train.repartition(partitions, ID_COL)
    prepared = (prepare_features(train.select(*inputs, LABEL_COL))
                .where(F.col(LABEL_COL).isNotNull())
                .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        preprocessor = fit_preprocessor(prepared)
        features = preprocessor.transform(prepared).select(
            F.col(FEATURES_COL), F.col(LABEL_COL).cast("double").alias("label"))
        model = LogisticRegression(featuresCol=FEATURES_COL, labelCol="label",
                                   maxIter=max_iter, regParam=reg_param, tol=tol).fit(features)
    finally:
        prepared.unpersist()
    if model.summary.totalIterations >= max_iter:
        raise RuntimeError(f"the optimiser did not converge in {max_iter} iterations")
    return preprocessor, model, save_risk_model(train.sparkSession, preprocessor, model, path)


def save_risk_model(spark, preprocessor: PipelineModel, model: LogisticRegressionModel,
                    path: str | None = None) -> str:
    """Save both artefacts under ``path`` (default: a fresh folder in the
    shared checkpoint location)."""
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/risk-model-{uuid.uuid4().hex}"
    preprocessor.write().overwrite().save(f"{path}/preprocessor")
    model.write().overwrite().save(f"{path}/model")
    return path


def fixed_model(df: DataFrame, preprocessor: PipelineModel, coefficients: dict[str, float],
                intercept: float) -> LogisticRegressionModel:
    """A logistic regression with given coefficients per numeric or flag
    column of ``df`` (0 for all others). Bounds leave the optimiser one point,
    so two made-up rows are enough to get a model of the right size."""
    fields = preprocessor.transform(prepare_features(df)).schema
    size = fields[FEATURES_COL].metadata["ml_attr"]["num_attrs"]
    names = [c for c in (*NUMERIC_COLS, *FLAG_COLS) if c in df.columns]
    values = [coefficients.get(c, 0.0) for c in names] + [0.0] * (size - len(names))
    bound, level = Matrices.dense(1, size, values), Vectors.dense([intercept])
    rows = df.sparkSession.createDataFrame(
        [(0.0, Vectors.dense([0.0] * size)), (1.0, Vectors.dense([1.0] * size))], ["label", FEATURES_COL])
    return LogisticRegression(
        featuresCol=FEATURES_COL, labelCol="label", maxIter=1, standardization=False,
        lowerBoundsOnCoefficients=bound, upperBoundsOnCoefficients=bound,
        lowerBoundsOnIntercepts=level, upperBoundsOnIntercepts=level).fit(rows)


def load_preprocessor(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


def load_risk_model(path: str) -> tuple[PipelineModel, LogisticRegressionModel]:
    """Both artefacts saved by ``fit_risk_model``."""
    return load_preprocessor(f"{path}/preprocessor"), load_model(f"{path}/model")


def fallback_score(df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Score from the hard prediction when no probability exists:
    positive prediction -> 0.75, otherwise 0.25."""
    return df.withColumn(
        SCORE_COL, F.when(F.col(prediction_col) > 0, F.lit(0.75)).otherwise(F.lit(0.25)))


def with_risk_score(predictions: DataFrame, probability_col: str = "probability") -> DataFrame:
    """``risk_score`` = probability of class 1 when the model produced one,
    else the fallback from ``prediction``."""
    if probability_col not in predictions.columns:
        return fallback_score(predictions)
    return predictions.withColumn(SCORE_COL, vector_to_array(F.col(probability_col))[1])


def score(df: DataFrame, preprocessor: PipelineModel, model) -> DataFrame:
    """Score every row of an applicant table: preparation, preprocessing
    pipeline, classifier, then the class-1 probability as ``risk_score``.
    The input columns are kept; ML working columns are dropped. Scoring is a
    map-only job: it runs with the input's partitioning."""
    prepared = prepare_features(df)
    transformed = model.transform(preprocessor.transform(prepared))
    scored = with_risk_score(transformed)
    keep = list(prepared.columns) + [SCORE_COL, "prediction"]
    return scored.select(*keep)


# --- Client report (the per-client answer, for every scored row) -------------

def score_report(scored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat report per scored client: identity fields, age in completed
    years, tenure (null and 'not employed' -> 0), amounts, score and the
    predicted class. Conversions keep nulls; ``keep`` columns pass through."""
    return scored.select(
        *keep,
        F.col("SK_ID_CURR").alias("client_id"),
        F.col("CODE_GENDER").alias("gender"),
        D.age_whole_years("DAYS_BIRTH").alias("age"),
        F.col("CNT_CHILDREN").cast("int").alias("children_count"),
        F.col("AMT_INCOME_TOTAL").cast("double").alias("income"),
        F.col("AMT_CREDIT").cast("double").alias("credit_amount"),
        F.col("NAME_INCOME_TYPE").alias("income_type"),
        F.col("NAME_EDUCATION_TYPE").alias("education_type"),
        F.col("NAME_FAMILY_STATUS").alias("family_status"),
        F.col("NAME_HOUSING_TYPE").alias("housing_type"),
        D.report_years_employed("DAYS_EMPLOYED").alias("years_employed"),
        F.col(SCORE_COL).cast("double").alias("risk_score"),
        F.col("prediction").cast("int").alias("predicted_default"),
    )


CLIENT_INFO = ("gender", "age", "children_count", "income", "credit_amount", "income_type",
                "education_type", "family_status", "housing_type", "years_employed")


def score_response(report: DataFrame) -> DataFrame:
    """Nested response per client: ``client_id``, a ``client_info`` struct
    and a ``prediction`` struct; write it as JSON or parquet."""
    return report.select(
        "client_id",
        F.struct(*[F.col(c) for c in CLIENT_INFO]).alias("client_info"),
        F.struct("risk_score", "predicted_default").alias("prediction"))
