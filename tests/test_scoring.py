"""Feature preparation and the ML scoring path (wiring and sanity)."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendlens.operators import scoring
from lendlens.sources import fixtures as fx


def test_prepare_features_casts_and_defaults(spark):
    df = spark.createDataFrame(
        [("12", None, "Y", "x"), ("oops", "Working", "1", None), (None, "Pensioner", "N", "y")],
        "AMT_CREDIT string, NAME_INCOME_TYPE string, FLAG_OWN_CAR string, OTHER string")
    out = scoring.prepare_features(df).collect()
    assert [r["AMT_CREDIT"] for r in out] == [12.0, None, None]  # malformed -> null
    assert [r["NAME_INCOME_TYPE"] for r in out] == ["Unknown", "Working", "Pensioner"]
    assert [r["FLAG_OWN_CAR"] for r in out] == [1, 1, 0]
    assert [r["OTHER"] for r in out] == ["x", None, "y"]  # untouched


def test_integer_flags(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "FLAG_OWN_REALTY int")
    assert [r[0] for r in scoring.prepare_features(df).collect()] == [1, 0, 0]


@pytest.fixture(scope="module")
def fitted(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    pre, model, path = scoring.fit_risk_model(fx.applications(spark, sf_dir), path=path)
    return pre, model, path


def test_save_load_same_scores(spark, sf_dir, fitted):
    pre, model, path = fitted
    apps = fx.applicants(spark, sf_dir)
    a = {r["SK_ID_CURR"]: r["risk_score"] for r in scoring.score(apps, pre, model).collect()}
    pre2, model2 = scoring.load_risk_model(path)
    b = {r["SK_ID_CURR"]: r["risk_score"] for r in scoring.score(apps, pre2, model2).collect()}
    assert a.keys() == b.keys() and len(a) == 1500
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert all(0.0 <= v <= 1.0 for v in a.values())


def test_model_finds_signal(spark, sf_dir, fitted):
    pre, model, _ = fitted
    scored = scoring.score(fx.applications(spark, sf_dir), pre, model)
    auc = BinaryClassificationEvaluator(rawPredictionCol="risk_score", labelCol="label").evaluate(
        scored.select("risk_score", F.col("TARGET").cast("double").alias("label")))
    assert auc > 0.5


def test_fallback_only_without_probability(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "prediction double")
    assert [r["risk_score"] for r in scoring.with_risk_score(df).collect()] == [0.75, 0.25]


def test_unseen_category_is_scored(spark, sf_dir, fitted):
    pre, model, _ = fitted
    one = fx.applicants(spark, sf_dir).limit(1).withColumn("NAME_INCOME_TYPE", F.lit("Student"))
    assert scoring.score(one, pre, model).first()["risk_score"] is not None


def test_score_response_nested(spark):
    df = spark.createDataFrame(
        [(5, "F", 30, 1, 10.0, 20.0, "Working", "x", "y", "z", 1.5, 0.3, 0)],
        "client_id long, gender string, age int, children_count int, income double, "
        "credit_amount double, income_type string, education_type string, family_status string, "
        "housing_type string, years_employed double, risk_score double, predicted_default int")
    r = scoring.score_response(df).first()
    assert r["client_info"]["gender"] == "F" and r["prediction"]["risk_score"] == 0.3


def test_api_predict_and_dataviz(spark, sf_dir, fitted):
    import datetime as dt

    from lendlens import api
    pre, model, _ = fitted
    out = {r["client_id"]: r for r in api.predict(
        fx.applicants(spark, sf_dir), [7, 123456789], pre, model, dt.datetime(2024, 5, 1, 9, 0)).collect()}
    assert out[7]["found"] and 0.0 <= out[7]["prediction"]["risk_score"] <= 1.0
    assert out[7]["recommendation"]["decision"] in (
        "Refus recommandé", "Acceptation conditionnelle", "Acceptation recommandée")
    assert out[123456789]["error"] == "Client ID 123456789 non trouvé dans les données"
    result, meta = api.dataviz(fx.applications(spark, sf_dir))
    assert meta["analysis_type"] == 2 and meta["chart_type"] == "scatter"
    assert result.count() == 5
