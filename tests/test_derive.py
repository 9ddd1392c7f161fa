"""Band ladders and derived measures on hand-written rows (edges, nulls)."""

from pyspark.sql import functions as F

from lendlens.functions import derive as D
from lendlens.functions.bands import risk_level


def _col(spark, values, typ, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_age_band_from_days_and_null(spark):
    # -9131 days is 24.9993 years; -9132 is 25.0021 years.
    got = _col(spark, [-9131, -9132, -20089, None], "int",
               lambda c: D.age_band(D.age_years(c)))
    assert got == ["< 25 ans", "25-35 ans", "> 55 ans", "> 55 ans"]  # null falls through


def test_age_band_exact_years(spark):
    got = _col(spark, [24.999, 25.0, 34.999, 35.0, 44.999, 45.0, 54.999, 55.0, None],
               "double", D.age_band)
    assert got == ["< 25 ans", "25-35 ans", "25-35 ans", "35-45 ans", "35-45 ans",
                   "45-55 ans", "45-55 ans", "> 55 ans", "> 55 ans"]


def test_years_employed_sentinel_and_null(spark):
    got = _col(spark, [365243, -3653, 0, None], "int", D.years_employed)
    assert got[0] == 0.0
    assert abs(got[1] - 3653 / 365.25) < 1e-12
    assert got[3] is None
    bands = _col(spark, [365243, -365, -366, -1096, -1827, -3653, None], "int",
                 lambda c: D.employment_band(D.years_employed(c)))
    assert bands == ["< 1 an", "< 1 an", "1-3 ans", "3-5 ans", "5-10 ans", "> 10 ans", "> 10 ans"]


def test_employment_band_edges(spark):
    got = _col(spark, [0.999, 1.0, 2.999, 3.0, 4.999, 5.0, 9.999, 10.0], "double",
               D.employment_band)
    assert got == ["< 1 an", "1-3 ans", "1-3 ans", "3-5 ans", "3-5 ans", "5-10 ans",
                   "5-10 ans", "> 10 ans"]


def test_enquiry_bands(spark):
    got = _col(spark, [0.0, 1.0, 2.0, 3.0, 5.0, 6.0, 10.0, 11.0, -1.0], "double",
               D.enquiry_band)
    assert got == ["Aucune demande", "1-2 demandes", "1-2 demandes", "3-5 demandes",
                   "3-5 demandes", "6-10 demandes", "6-10 demandes", "> 10 demandes",
                   "1-2 demandes"]  # negative totals land in the first ladder step


def test_total_enquiries_null_as_zero(spark):
    from lendlens.schema import BUREAU_COLS
    row = [None, 1.0, None, 2.0, None, 3.0]
    df = spark.createDataFrame([tuple(row)], ", ".join(f"{c} double" for c in BUREAU_COLS))
    assert df.select(D.total_enquiries()).first()[0] == 6.0


def test_credit_income_ratio_zero_income_is_null(spark):
    df = spark.createDataFrame([(100.0, 0.0), (100.0, 3.0), (1.0, None)],
                               "AMT_CREDIT double, AMT_INCOME_TOTAL double")
    got = [r[0] for r in df.select(D.credit_income_ratio()).collect()]
    assert got == [None, 33.33, None]


def test_realty_label(spark):
    got = _col(spark, ["Y", "N", "X", None], "string", D.realty_label)
    assert got == ["Propriétaire", "Non propriétaire", None, None]


def test_weekday_rank(spark):
    got = _col(spark, ["MONDAY", "sunday", "Wednesday", None], "string",
               lambda c: D.weekday_rank(c))
    assert got == [0, 6, 2, 0]
    lenient = _col(spark, ["FUNDAY"], "string", lambda c: D.weekday_rank(c, strict=False))
    assert lenient == [None]


def test_weekday_rank_unknown_fails_in_strict_mode(spark):
    import pytest
    df = spark.createDataFrame([("FUNDAY",)], "x string")
    with pytest.raises(Exception, match="unknown weekday"):
        df.select(D.weekday_rank(F.col("x"))).collect()


def test_is_default_null_counts_as_zero(spark):
    assert _col(spark, [1, 0, None, 2], "int", D.is_default) == [1, 0, 0, 0]


def test_report_fields(spark):
    got = _col(spark, [-7305.0, -7304.0, None], "double", D.age_whole_years)
    assert got == [20, 19, None]
    ye = _col(spark, [365243.0, None, -730.5], "double", D.report_years_employed)
    assert ye == [0.0, 0.0, 2.0]


def test_risk_level_edges(spark):
    got = _col(spark, [0.3999, 0.40, 0.6999, 0.70, 1.0, 0.0, None], "double", risk_level)
    assert got == ["Faible", "Moyen", "Moyen", "Élevé", "Élevé", "Faible", None]
