"""Cohort analyses: floors, dispatch, filters, relabels, orders."""

import pytest
from pyspark.sql import functions as F

from lendlens.operators import cohorts, filters
from lendlens.sources import fixtures as fx


def _apps(spark, rows):
    """Minimal application rows: (id, target, income_type, credit, income)."""
    return spark.createDataFrame(
        rows, "SK_ID_CURR long, TARGET int, NAME_INCOME_TYPE string, "
              "AMT_CREDIT double, AMT_INCOME_TOTAL double")


def test_income_floor_is_strict(spark):
    rows = [(i, i % 2, "A", 1.0, 10.0) for i in range(100)]
    rows += [(1000 + i, 0, "B", 1.0, 20.0) for i in range(101)]
    out = cohorts.analyse(_apps(spark, rows), 3).collect()
    assert [r["NAME_INCOME_TYPE"] for r in out] == ["B"]
    assert out[0]["CLIENT_COUNT"] == 101 and out[0]["AVG_INCOME"] == 20.0


def test_family_floor_is_strict(spark):
    rows = [(i, 0, "Married", 0) for i in range(50)] + [(100 + i, 1, "Widow", 2) for i in range(51)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, NAME_FAMILY_STATUS string, "
                                     "CNT_CHILDREN int")
    out = cohorts.analyse(df, 7).collect()
    assert [(r["NAME_FAMILY_STATUS"], r["CLIENT_COUNT"], r["DEFAULT_RATE"]) for r in out] == [
        ("Widow", 51, 100.0)]


def test_dispatch_by_number_text_and_name(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    a = cohorts.analyse(apps, 1).collect()
    assert sorted(a) == sorted(cohorts.analyse(apps, "1").collect())
    assert sorted(a) == sorted(cohorts.analyse(apps, "age_band").collect())
    for bad in (0, 9, "nine"):
        with pytest.raises(ValueError):
            cohorts.analyse(apps, bad)


def test_metadata(spark):
    m = cohorts.metadata(6, {"min_credit": 5})
    assert m["chart_type"] == "bar_grouped" and m["group_col"] == "FLAG_OWN_REALTY"
    assert m["title"] == "Taux de défaut par type de contrat et propriété immobilière"
    assert cohorts.metadata(8)["theta_col"] == "WEEKDAY_APPR_PROCESS_START"


def test_zero_bound_means_no_bound(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    assert filters.portfolio_filter(apps, min_credit=0, max_credit=0, min_income=0).count() \
        == apps.count()


def test_filter_order_irrelevant_and_bands_partition(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    kw = dict(min_credit=100000, max_credit=300000, min_income=20000)
    n = filters.portfolio_filter(apps, **kw).count()
    for number in (1, 4, 5, 8):
        total = cohorts.analyse(apps, number, **kw).agg(F.sum(F.col(
            "APPLICATION_COUNT" if number == 8 else "CLIENT_COUNT"))).first()[0]
        assert total == n
    a = (apps.where(F.col("AMT_INCOME_TOTAL") >= 20000).where(F.col("AMT_CREDIT") <= 300000)
             .where(F.col("AMT_CREDIT") >= 100000))
    assert sorted(cohorts.analyse(a, 1).collect()) == sorted(cohorts.analyse(apps, 1, **kw).collect())


def test_employment_order_is_lexicographic(spark, sf_dir):
    out = [r["EMPLOYMENT_LENGTH"] for r in cohorts.analyse(fx.applications(spark, sf_dir), 4).collect()]
    assert out == ["1-3 ans", "3-5 ans", "5-10 ans", "< 1 an", "> 10 ans"]


def test_weekday_order(spark, sf_dir):
    out = cohorts.analyse(fx.applications(spark, sf_dir), 8).collect()
    assert [r["WEEKDAY_ORDER"] for r in out] == list(range(7))
    assert out[0]["WEEKDAY_APPR_PROCESS_START"] == "MONDAY"


def test_contract_realty_relabel_and_matrix(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    grouped = cohorts.analyse(apps, 6).collect()
    assert {r["FLAG_OWN_REALTY"] for r in grouped} == {"Propriétaire", "Non propriétaire"}
    matrix = {r["NAME_CONTRACT_TYPE"]: r for r in cohorts.contract_realty_matrix(apps).collect()}
    for r in grouped:
        assert matrix[r["NAME_CONTRACT_TYPE"]][r["FLAG_OWN_REALTY"]] == r["DEFAULT_RATE"]


def test_family_matrix_cells_equal_group_rates(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    groups = cohorts.analyse(apps, 7).collect()
    matrix = {r["CNT_CHILDREN"]: r for r in cohorts.family_children_matrix(apps).collect()}
    for g in groups:
        assert matrix[g["CNT_CHILDREN"]][g["NAME_FAMILY_STATUS"]] == g["DEFAULT_RATE"]


def test_quintile_counts(spark, sf_dir):
    out = cohorts.analyse(fx.applications(spark, sf_dir), 2).orderBy("RATIO_CATEGORY").collect()
    assert [r["RATIO_CATEGORY"] for r in out] == [1, 2, 3, 4, 5]
    assert sum(r["COUNT"] for r in out) == 1500


def test_records(spark):
    df = spark.createDataFrame([("< 25 ans", 3, 1.5)], "AGE_GROUP string, CLIENT_COUNT long, DEFAULT_RATE double")
    rec = cohorts.as_records(df).first()["record"]
    assert rec == '{"AGE_GROUP":"< 25 ans","CLIENT_COUNT":3,"DEFAULT_RATE":1.5}'


def test_lookup_reports_missing(spark, sf_dir):
    apps = fx.applicants(spark, sf_dir)
    out = {r["SK_ID_CURR"]: r["found"] for r in
           filters.lookup(apps, [0, 7, -1], report_missing=True).collect()}
    assert out == {0: True, 7: True, -1: False}
    assert filters.lookup(apps, 97).count() == 1
    ids = spark.createDataFrame([(1,), (1,), (-5,)], "SK_ID_CURR long")
    assert [r["SK_ID_CURR"] for r in filters.lookup(apps, ids).collect()] == [1]
    assert filters.lookup(apps, ids, report_missing=True).where("not found").count() == 1


def test_empty_input(spark):
    out = cohorts.analyse(_apps(spark, []), 3)
    assert out.collect() == []


def _nulls_first(t):
    return tuple((v is not None, "" if v is None else str(v)) for v in t)


def test_cohort_report_equals_separate_analyses(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    kw = dict(min_credit=50000)
    rep = cohorts.cohort_report(apps, **kw).collect()
    for number in cohorts.REPORT_ANALYSES:
        s = cohorts.spec(number)
        count_col = "APPLICATION_COUNT" if number == 8 else "CLIENT_COUNT"
        want = sorted((
            (None if r[s.keys[0]] is None else str(r[s.keys[0]]),
             None if len(s.keys) < 2 or r[s.keys[1]] is None else str(r[s.keys[1]]),
             r[count_col], r["DEFAULT_RATE"])
            for r in cohorts.analyse(apps, number, **kw).collect()), key=_nulls_first)
        got = sorted(((r["KEY1"], r["KEY2"], r["CLIENT_COUNT"], r["DEFAULT_RATE"])
                      for r in rep if r["ANALYSIS"] == number), key=_nulls_first)
        assert got == want, number
    with pytest.raises(ValueError):
        cohorts.cohort_report(apps, analyses=(1, 2))


def test_cohort_report_is_one_scan(spark, sf_dir):
    plan = cohorts.cohort_report(fx.applications(spark, sf_dir))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # orders + customer, once each


def test_filters_mapping_equals_keywords(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    a = cohorts.analyse(apps, 3, filters={"min_credit": 100000, "min_income": 0}).collect()
    b = cohorts.analyse(apps, 3, min_credit=100000).collect()
    assert sorted(map(tuple, a), key=_nulls_first) == sorted(map(tuple, b), key=_nulls_first)
    with pytest.raises(ValueError):
        cohorts.analyse(apps, 3, filters={"credit": 1})


def test_dataviz_entry_point(spark, sf_dir):
    from lendlens import api
    apps = fx.applications(spark, sf_dir)
    result, meta = api.dataviz(apps, "6", {"min_credit": 100000, "max_credit": 400000})
    assert meta["filters"] == {"min_credit": 100000, "max_credit": 400000}
    assert meta["group_col"] == "FLAG_OWN_REALTY" and meta["analysis_type"] == 6
    direct = cohorts.analyse(apps, 6, min_credit=100000, max_credit=400000)
    assert sorted(map(tuple, result.collect()), key=_nulls_first) == \
        sorted(map(tuple, direct.collect()), key=_nulls_first)


def test_matrices_keep_unlisted_labels(spark, sf_dir):
    rows = [(f"c{i}", s, k, f, 1 if f == "X" else 0) for i, (s, k, f) in enumerate(
        [("Unknown", 0, "X")] * 60 + [(None, 1, None)] * 60 + [("Married", 1, "Y")] * 60)]
    df = spark.createDataFrame(rows, "id string, NAME_FAMILY_STATUS string, CNT_CHILDREN int, "
                                     "FLAG_OWN_REALTY string, TARGET int")
    df = df.selectExpr("*", "1e0 AS AMT_CREDIT", "1e0 AS AMT_INCOME_TOTAL", "'Cash loans' AS NAME_CONTRACT_TYPE")
    family = cohorts.family_children_matrix(df)
    assert {tuple(r) for r in cohorts.matrix_cells(family).collect()} == {
        (0, "Unknown", 100.0), (1, "(null)", 0.0), (1, "Married", 0.0)}
    realty = cohorts.contract_realty_matrix(df)
    assert {tuple(r) for r in cohorts.matrix_cells(realty).collect()} == {
        ("Cash loans", "X", 100.0), ("Cash loans", "(null)", 0.0), ("Cash loans", "Propriétaire", 0.0)}


def test_unknown_weekday_fails_analysis_and_report_alike(spark, sf_dir):
    apps = fx.applications(spark, sf_dir).withColumn("WEEKDAY_APPR_PROCESS_START", F.lit("Someday"))
    for result in (cohorts.analyse(apps, 8), cohorts.cohort_report(apps)):
        with pytest.raises(Exception, match="unknown weekday"):
            result.collect()


def test_labels_that_look_like_others_stay_apart(spark):
    """A literal (null), or a flag that spells a known label, is never summed with what it looks like."""
    rows = [(s, f, t) for s, f, rates in ((None, "Y", 10), ("(null)", "Propriétaire", 30)) for t in [1] * rates + [0] * (100 - rates)]
    df = spark.createDataFrame(rows, "NAME_FAMILY_STATUS string, FLAG_OWN_REALTY string, TARGET int").selectExpr(
        "*", "monotonically_increasing_id() AS id", "0 AS CNT_CHILDREN", "1e0 AS AMT_CREDIT", "1e0 AS AMT_INCOME_TOTAL",
        "'Cash loans' AS NAME_CONTRACT_TYPE")
    cells = {tuple(r)[1:] for r in cohorts.matrix_cells(cohorts.family_children_matrix(df)).collect()}
    assert cells == {("(null)", 10.0), ('"(null)"', 30.0)}
    cells = {tuple(r)[1:] for r in cohorts.matrix_cells(cohorts.contract_realty_matrix(df)).collect()}
    assert cells == {("Propriétaire", 10.0), ('"Propriétaire"', 30.0)}
