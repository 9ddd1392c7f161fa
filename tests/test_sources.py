"""CSV/parquet readers with the explicit schema, identities."""

import pytest

from lendlens.schema import APPLICATION_SCHEMA
from lendlens.sources import fixtures as fx
from lendlens.sources import readers


def test_csv_roundtrip_with_schema(spark, sf_dir, tmp_path):
    path = str(tmp_path / "apps_csv")
    apps = fx.applications(spark, sf_dir)
    apps.write.option("header", "true").csv(path)
    back = readers.read_applications(spark, path, fmt="csv")
    assert [(f.name, f.dataType) for f in back.schema] == \
        [(f.name, f.dataType) for f in APPLICATION_SCHEMA]
    assert back.count() == 1500
    cols = apps.columns  # file order differs from schema order; names decide
    assert sorted(back.select(cols).collect()) == sorted(apps.collect())


def test_csv_malformed_value_is_null(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("SK_ID_CURR,AMT_CREDIT\n1,12.5\n2,abc\n")
    df = readers.read_applicants(spark, str(path), fmt="csv")
    got = sorted(((r["SK_ID_CURR"], r["AMT_CREDIT"]) for r in df.collect()), key=lambda t: t[0])
    assert got == [(1, 12.5), (2, None)]


def test_csv_whole_numbers_written_as_decimals(spark, tmp_path):
    """A gap in an integer column makes data frames write 1.0; a value that
    can't be read is counted, an empty one isn't."""
    path = tmp_path / "gaps.csv"
    path.write_text("SK_ID_CURR,TARGET,DAYS_BIRTH,CNT_CHILDREN,AMT_CREDIT\n"
                    "1.0,1.0,-9000.0,,1e3\n2,0,-1.5,99999999999,x\n3,,1e2,2,\n")
    rows = sorted(readers.read_applications(spark, str(path), fmt="csv", rejected=True).collect())
    got = [(r.SK_ID_CURR, r.TARGET, r.DAYS_BIRTH, r.CNT_CHILDREN, r.AMT_CREDIT, r[readers.REJECTED]) for r in rows]
    assert got == [(1, 1, -9000, None, 1000.0, 0), (2, 0, None, None, None, 3), (3, None, 100, 2, None, 0)]


def test_csv_analysis_of_gappy_integers(spark, tmp_path):
    from lendlens.operators import cohorts
    path = tmp_path / "young.csv"
    path.write_text("SK_ID_CURR,TARGET,DAYS_BIRTH\n" + "".join(f"{i},1.0,-9000.0\n" for i in range(5)))
    row, = cohorts.analyse(readers.read_applications(spark, str(path), fmt="csv"), 1).collect()
    assert (row.AGE_GROUP, row.CLIENT_COUNT, row.DEFAULT_RATE) == ("< 25 ans", 5, 100.0)


def test_csv_unreadable_id_fails(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("SK_ID_CURR,AMT_CREDIT\nabc,1\n")
    with pytest.raises(Exception, match="unreadable SK_ID_CURR: abc"):
        readers.read_applicants(spark, str(path), fmt="csv").collect()


def test_csv_files_of_other_headers_fail(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("SK_ID_CURR,AMT_CREDIT,AMT_INCOME_TOTAL\n1,10,20\n2,11,21\n")
    (folder / "b.csv").write_text("SK_ID_CURR,AMT_INCOME_TOTAL,AMT_CREDIT\n3,20,10\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_applicants(spark, str(folder), fmt="csv").collect()


def test_stored_table_is_read_as_it_is(spark, sf_dir, tmp_path):
    """No shuffle under an analysis but the one of its grouping."""
    from lendlens.operators import cohorts
    path = str(tmp_path / "apps_pq")
    fx.applications(spark, sf_dir).coalesce(1).write.parquet(path)
    df = readers.read_applications(spark, path)
    assert df.count() == 1500
    plan = cohorts.analyse(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_scratch_folder_goes(spark):
    import os

    from lendlens.sources.scratch import scratch_folder
    with scratch_folder(spark, "test-scratch") as uri:
        spark.range(3).write.parquet(f"{uri}/t")
        path = uri.removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_identities_conformed(spark):
    raw = spark.createDataFrame([("7", "Ann")], "id string, name string")
    out = readers.identities(raw, id_col="id", name_col="name").first()
    assert (out["SK_ID_CURR"], out["client_name"], out["photo_url"]) == (7, "Ann", None)


def test_persist_base(spark, sf_dir):
    base = readers.persist_base(fx.applications(spark, sf_dir).select("SK_ID_CURR", "TARGET"))
    try:
        assert base.is_cached and base.count() == 1500
    finally:
        base.unpersist()


def test_write_result_and_nested_response_as_json(spark, sf_dir, tmp_path):
    import json
    import os

    from lendlens.operators.scoring import score_report, score_response
    from lendlens.sources.sinks import write_result
    out = str(tmp_path / "responses")
    write_result(score_response(score_report(fx.scored(spark, sf_dir))), out, fmt="json")
    lines = [json.loads(line) for f in sorted(os.listdir(out)) if f.endswith(".json")
             for line in open(os.path.join(out, f), encoding="utf-8")]
    assert len(lines) == 1500
    first = lines[0]
    assert set(first) == {"client_id", "client_info", "prediction"}
    assert set(first["prediction"]) <= {"risk_score", "predicted_default"}


def test_write_result_partitioned(spark, sf_dir, tmp_path):
    import os

    from lendlens.operators import cohorts
    from lendlens.sources.sinks import write_result
    out = str(tmp_path / "report")
    write_result(cohorts.cohort_report(fx.applications(spark, sf_dir)), out, partition_by=["ANALYSIS"])
    assert sorted(d for d in os.listdir(out) if d.startswith("ANALYSIS=")) == \
        [f"ANALYSIS={n}" for n in (1, 3, 4, 5, 6, 7, 8)]
    assert spark.read.parquet(out).count() == cohorts.cohort_report(fx.applications(spark, sf_dir)).count()


def test_csv_large_ids_written_as_decimals_stay_exact(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.write_text("SK_ID_CURR,AMT_CREDIT\n9007199254740993.0,1\n-9007199254740995.00,1\n9223372036854775807.,1\n +12.0 ,1\n4e3,1\n")
    df = readers.read_applicants(spark, str(path), fmt="csv")
    assert sorted(r.SK_ID_CURR for r in df.collect()) == [-9007199254740995, 12, 4000, 9007199254740993, (1 << 63) - 1]
