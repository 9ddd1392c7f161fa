"""Every registered query against its DuckDB oracle at sf0.001, plus the
driver entry point."""

import pytest

import __spark_entry__ as E
from lendlens.plans import catalog, oracle
from oracle_compare import compare, duck

SQL = oracle.oracle_sql()
QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_oracle_has_a_query():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"fit_risk_model", "score_portfolio"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["RATIO_CATEGORY", "COUNT", "AVG_RATIO", "DEFAULT_RATE"]
    assert df.count() == 5


def test_fit_runs_to_convergence(spark, sf_dir):
    rows = QUERIES["fit_risk_model"](spark, sf_dir).collect()
    assert [r.position for r in rows] == list(range(len(rows))) and len(rows) > 50
    assert 0 < rows[0].iterations < 100 and 0 < rows[0].loss < 0.7


def test_score_portfolio_rows(spark, sf_dir):
    df = QUERIES["score_portfolio"](spark, sf_dir)
    assert df.count() == 1500
    assert df.where("risk_score < 0 OR risk_score > 1 OR risk_score IS NULL").count() == 0


@pytest.mark.parametrize("name", ["credit_income_quintile", "cohort_report", "format_client",
                                  "feedback_json", "client_response"])
def test_results_do_not_depend_on_session_settings(spark, sf_dir, con, name):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "37",
                "spark.sql.ansi.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
