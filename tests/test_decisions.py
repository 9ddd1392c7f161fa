"""Decision rules, display formatting, stamp and client file."""

import datetime as dt

from lendlens.operators import decisions
from lendlens.sources import fixtures as fx


def test_recommendation_by_level(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.4), (3, 0.7), (4, None)], "id long, risk_score double")
    out = {r["id"]: r["recommendation"] for r in decisions.recommend(df).collect()}
    assert out[1]["decision"] == "Acceptation recommandée" and out[1]["risk_level"] == "Faible"
    assert out[2]["decision"] == "Acceptation conditionnelle" and len(out[2]["action_plan"]) == 4
    assert out[3]["risk_level"] == "Élevé"
    assert out[3]["action_plan"][1] == "Proposer un montant réduit (max 30% du revenu)"
    assert out[4] is None


def _report(spark, rows):
    return spark.createDataFrame(rows, (
        "client_id long, gender string, age int, income double, credit_amount double, "
        "income_type string, education_type string, family_status string, housing_type string, "
        "years_employed double"))


def test_format_client(spark):
    rows = [(1, "M", 40, 1234.5, 99.5, "Working", "Academic degree", "Widow", "Co-op apartment", 3.25),
            (2, "Unknown", None, None, 10.4, "Student", "Unknown", "Unknown", "Unknown", 250.44),
            (3, "F", 20, 0.49, 1.5, "Pensioner", "Lower secondary", "Married", "With parents", -0.0)]
    out = {r["client_id"]: r for r in decisions.format_client(_report(spark, rows)).collect()}
    a, b, c = out[1], out[2], out[3]
    assert (a["gender"], a["income_type"], a["education_type"], a["family_status"],
            a["housing_type"]) == ("Homme", "Salarié", "Diplôme universitaire", "Veuf/veuve",
                                   "Coopérative")
    assert (a["income"], a["credit_amount"]) == (1234, 100)  # half to even
    assert a["years_employed"] == 3.2
    assert b["gender"] == "Unknown" and b["income_type"] == "Student" and b["income"] is None
    assert b["years_employed"] == 50.4  # > 100: modulo 100 first
    assert c["family_status"] == "Marié(e)" and c["housing_type"] == "Chez les parents"
    assert str(c["years_employed"]) == "-0.0"


def test_stamp(spark):
    df = spark.createDataFrame([(1,)], "client_id long")
    r = decisions.stamp(df, dt.datetime(2024, 1, 9, 7, 3)).first()
    assert (r["analysis_date"], r["analysis_time"]) == ("09/01/2024", "07:03")
    assert r["model_type"] == "Régression logistique" and r["version"] == "1.2.3"


def test_dossier_keeps_unmatched(spark, sf_dir):
    from lendlens.operators.scoring import score_report
    report = score_report(fx.scored(spark, sf_dir))
    out = decisions.client_dossier(report, fx.identities(spark, sf_dir))
    assert out.count() == 1500
    assert out.where("client_name IS NULL").count() == 150


def test_risk_level_summary(spark):
    df = spark.createDataFrame([(0.1, 10.0), (0.5, 1.0), (0.9, 2.0), (None, 3.0), (0.95, 4.0)],
                               "risk_score double, AMT_CREDIT double")
    out = {r["risk_level"]: r for r in decisions.risk_level_summary(df).collect()}
    assert out["Élevé"]["CLIENT_COUNT"] == 2 and out["Élevé"]["TOTAL_CREDIT"] == 6.0
    assert out[None]["AVG_SCORE"] is None


def test_client_response(spark, sf_dir):
    resp = decisions.client_response(fx.scored(spark, sf_dir), [1, -1], dt.datetime(2024, 1, 9, 7, 3))
    out = {r["client_id"]: r for r in resp.collect()}
    assert out[-1]["found"] is False
    assert out[-1]["error"] == "Client ID -1 non trouvé dans les données"
    assert out[-1]["client_info"] is None and out[-1]["recommendation"] is None
    hit = out[1]
    assert hit["found"] and hit["error"] is None
    assert hit["client_info"]["gender"] in ("Homme", "Femme")
    assert hit["prediction"]["risk_score"] == 0.053
    assert hit["recommendation"]["risk_level"] == "Faible"
    assert hit["metadata"]["analysis_date"] == "09/01/2024"
