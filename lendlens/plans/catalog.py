"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables under ``sf_dir`` (through the fixture
views in ``sources.fixtures``) and runs over all rows. The matching DuckDB
oracle text lives in ``plans.oracle``; column names agree one to one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import derive
from ..operators import cohorts, decisions, filters, scoring
from ..operators.ntile import exact_ntile
from ..operators.tiles import tile_sums
from ..sources import fixtures as fx
from ..sources import readers
from ..sources.scratch import scratch_folder
from ..streaming import feedback

# Fixed parameters of the example queries.
FILTER_EXAMPLE = {"min_credit": 100000, "max_credit": 300000, "min_income": 0}
QUINTILE_COLUMNS = ("SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL", "TARGET")
FLOOR_EXAMPLE = {"min_credit": 484000}
QUINTILE_FILTER_EXAMPLE = {"min_credit": 50000, "min_income": 20000}
# credit floor under which some family groups fall below the size floor of 50
FAMILY_FLOOR_EXAMPLE = {"min_credit": 460000}
FIXED_COEFFICIENTS = {"EXT_SOURCE_1": -1.25, "EXT_SOURCE_2": -2.0, "EXT_SOURCE_3": 0.75,
                      "OWN_CAR_AGE": 0.03125, "AMT_GOODS_PRICE": 2.0 ** -20, "FLAG_OWN_CAR": 0.5}
FIXED_INTERCEPT = 0.625
SEGMENT_EXAMPLE = {"segment": "Working", "product": "Cash loans", "risk_levels": ["Élevé", "Moyen"]}
RUN_TS = dt.datetime(2024, 6, 3, 14, 5, 0)

Query = Callable[[SparkSession, str], DataFrame]


def _spread(spark: SparkSession) -> int:
    """Parts for a fit whose source scans as few tasks: as many as the session's shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _analysis(number: int, columns: tuple[str, ...] | None = None, **flt) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cohorts.analyse(fx.applications(spark, sf_dir, columns), number, **flt)
    run.__name__ = f"analysis_{number}"
    return run


def credit_income_tiles(spark, sf_dir):
    """Quintile of the credit/income ratio of every application."""
    apps = fx.applications(spark, sf_dir, QUINTILE_COLUMNS).withColumn(
        "CREDIT_INCOME_RATIO", derive.credit_income_ratio())
    return exact_ntile(apps, 5, ["CREDIT_INCOME_RATIO"], "SK_ID_CURR", "RATIO_CATEGORY").select(
        "SK_ID_CURR", "CREDIT_INCOME_RATIO", "RATIO_CATEGORY")


def odd_amount_tiles(spark, sf_dir):
    """Seventh of every application by credit, NaN, infinite and missing ones among them."""
    return exact_ntile(fx.odd_amounts(spark, sf_dir), 7, ["AMT_CREDIT"], "SK_ID_CURR", "TILE").select(
        "SK_ID_CURR", "TILE")


def odd_amount_sums(spark, sf_dir):
    """Rows, credits and defaults per seventh of the same, without ranking."""
    sums = tile_sums(fx.odd_amounts(spark, sf_dir), 7, F.col("AMT_CREDIT"), F.col("SK_ID_CURR"), F.col("TARGET"))
    return sums.select(F.col("tile").alias("TILE"), F.col("n").alias("COUNT"), F.col("m").alias("CREDITS"),
                       F.col("d").alias("DEFAULTS"))


def portfolio_filter(spark, sf_dir):
    apps = fx.applications(spark, sf_dir)
    return (filters.portfolio_filter(apps, **FILTER_EXAMPLE)
            .select("SK_ID_CURR", "AMT_CREDIT", "AMT_INCOME_TOTAL", "TARGET"))


def cohort_report(spark, sf_dir):
    """Analyses 1 and 3-8 from one scan (GROUPING SETS), long form."""
    return cohorts.cohort_report(fx.applications(spark, sf_dir))


def age_band_records(spark, sf_dir):
    """The age-band result as JSON records (one text per group)."""
    return cohorts.as_records(cohorts.analyse(fx.applications(spark, sf_dir), 1))


def contract_realty_matrix(spark, sf_dir):
    return cohorts.contract_realty_matrix(fx.applications(spark, sf_dir))


def family_children_matrix(spark, sf_dir):
    return cohorts.family_children_matrix(fx.applications(spark, sf_dir))


def prepare_features(spark, sf_dir):
    return scoring.prepare_features(fx.applications(spark, sf_dir))


def client_lookup(spark, sf_dir):
    apps = fx.applicants(spark, sf_dir)
    found = filters.lookup(apps, list(fx.REQUESTED_IDS), report_missing=True)
    return found.select("SK_ID_CURR", "found", "AMT_CREDIT", "NAME_CONTRACT_TYPE")


def client_lookup_batch(spark, sf_dir):
    """Lookup of a table of ids, some of them unknown."""
    found = filters.lookup(fx.applicants(spark, sf_dir), fx.requested_ids(spark, sf_dir), report_missing=True)
    return found.select("SK_ID_CURR", "found", "AMT_CREDIT", "NAME_CONTRACT_TYPE")


def fit_risk_model(spark, sf_dir):
    """Fit preprocessing and logistic regression on the labelled portfolio:
    what was fitted and how long the optimiser took, per coefficient. The
    model is ours (no artefact ships), so this has no SQL oracle."""
    with scratch_folder(spark, "lendlens-model") as path:
        _, model, _ = scoring.fit_risk_model(fx.applications(spark, sf_dir), path=path, partitions=_spread(spark))
    facts = model.summary
    rows = [(i, float(c), facts.totalIterations, float(facts.objectiveHistory[-1]))
            for i, c in enumerate([model.intercept, *model.coefficients])]
    return spark.createDataFrame(rows, "position int, coefficient double, iterations int, loss double")


def fit_check(spark, sf_dir):
    """At the optimum the mean score is the share of defaults, as the
    intercept isn't penalised."""
    apps = fx.applications(spark, sf_dir)
    with scratch_folder(spark, "lendlens-model") as path:
        pre, model, _ = scoring.fit_risk_model(apps, path=path, partitions=_spread(spark))
    return scoring.score(apps, pre, model).agg(
        F.count(F.lit(1)).alias("CLIENT_COUNT"), F.round(F.avg("TARGET"), 3).alias("DEFAULT_SHARE"),
        F.round(F.avg("risk_score"), 3).alias("MEAN_SCORE"))


def preprocess_features(spark, sf_dir):
    """Imputed numbers and category indexes of every application, from the
    fitted preprocessing pipeline after saving and loading it."""
    prepared = scoring.prepare_features(fx.applications(spark, sf_dir))
    with scratch_folder(spark, "lendlens-preprocessor") as path:
        scoring.fit_preprocessor(prepared).write().save(path)
        pre = scoring.load_preprocessor(path)
    numbers, indexes = scoring.preprocessed_columns(prepared)
    return pre.transform(prepared).select(
        "SK_ID_CURR", *[F.round(c, 4).alias(c) for c in numbers],
        *[F.col(c).cast("int").alias(c) for c in indexes])


def score_fixed_model(spark, sf_dir):
    """Every applicant scored by a logistic regression of fixed coefficients
    that was saved and loaded, with its level."""
    apps = fx.applications(spark, sf_dir)
    pre = scoring.fit_preprocessor(scoring.prepare_features(apps))
    model = scoring.fixed_model(apps, pre, FIXED_COEFFICIENTS, FIXED_INTERCEPT)
    with scratch_folder(spark, "lendlens-model") as path:
        scoring.save_risk_model(spark, pre, model, path)
        pre, model = scoring.load_risk_model(path)
    scored = decisions.with_risk_level(scoring.score(fx.applicants(spark, sf_dir), pre, model))
    return scored.select("SK_ID_CURR", F.round("risk_score", 6).alias("risk_score"), "prediction", "risk_level")


def score_portfolio(spark, sf_dir):
    """Fit, save, load and score every applicant (our own model: no oracle)."""
    with scratch_folder(spark, "lendlens-model") as path:
        scoring.fit_risk_model(fx.applications(spark, sf_dir), path=path, partitions=_spread(spark))
        pre, model = scoring.load_risk_model(path)
    scored = scoring.score(fx.applicants(spark, sf_dir), pre, model)
    return decisions.with_risk_level(scored).select(
        "SK_ID_CURR", "risk_score", "prediction", "risk_level")


def _csv_round_trip(spark, view, read):
    """A view as CSV, its integers written as a data frame with gaps writes
    them (``1.0``), read back by name."""
    with scratch_folder(spark, "lendlens-csv") as path:
        text = [F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "integer"
                else F.col(f.name) for f in reversed(view.schema.fields)]
        view.select(*text).write.option("header", "true").csv(path)
        return read(spark, path, "csv", rejected=True).checkpoint()


def csv_applications(spark, sf_dir):
    """The labelled portfolio written as CSV and read by the CSV reader."""
    return _csv_round_trip(spark, fx.applications(spark, sf_dir), readers.read_applications)


def csv_applicants(spark, sf_dir):
    """The applicants written as CSV and read by the CSV reader."""
    return _csv_round_trip(spark, fx.applicants(spark, sf_dir), readers.read_applicants)


def contract_realty_matrix_all(spark, sf_dir):
    """Cells of the ownership matrix where flags are unlisted or missing."""
    return cohorts.matrix_cells(cohorts.contract_realty_matrix(fx.unusual_applications(spark, sf_dir)))


def family_children_matrix_all(spark, sf_dir):
    """Cells of the family matrix where statuses are unlisted or missing."""
    cells = cohorts.matrix_cells(cohorts.family_children_matrix(fx.unusual_applications(spark, sf_dir)))
    return cells.withColumn("CNT_CHILDREN", F.col("CNT_CHILDREN").cast("int"))


def base_analyses(spark, sf_dir):
    """Two analyses over one persisted base."""
    base = readers.persist_base(filters.portfolio_filter(fx.applications(spark, sf_dir), **FILTER_EXAMPLE)
                                .select("SK_ID_CURR", "TARGET", "DAYS_BIRTH", "NAME_INCOME_TYPE", "AMT_INCOME_TOTAL"))
    try:
        ages, incomes = cohorts.run_spec(cohorts.spec(1), base), cohorts.run_spec(cohorts.spec(3), base)
        both = (ages.select(F.lit(1).alias("ANALYSIS"), F.col("AGE_GROUP").alias("KEY"), "CLIENT_COUNT", "DEFAULT_RATE")
                .unionByName(incomes.select(F.lit(3).alias("ANALYSIS"), F.col("NAME_INCOME_TYPE").alias("KEY"),
                                            "CLIENT_COUNT", "DEFAULT_RATE")))
        return both.checkpoint()
    finally:
        base.unpersist()


def fallback_score(spark, sf_dir):
    no_prob = fx.scored(spark, sf_dir).drop("risk_score")
    return scoring.with_risk_score(no_prob).select("SK_ID_CURR", "prediction", "risk_score")


def score_report(spark, sf_dir):
    return scoring.score_report(fx.scored(spark, sf_dir))


def recommend(spark, sf_dir):
    rec = decisions.recommend(fx.scored(spark, sf_dir))
    r = F.col("recommendation")
    return rec.select(
        "SK_ID_CURR", "risk_score",
        r["risk_level"].alias("risk_level"), r["decision"].alias("decision"),
        r["explanation"].alias("explanation"), r["alternative"].alias("alternative"),
        F.array_join(r["action_plan"], " | ").alias("action_plan"))


def format_client(spark, sf_dir):
    return decisions.format_client(scoring.score_report(fx.scored(spark, sf_dir)))


def format_unusual_clients(spark, sf_dir):
    """Display form over unlisted codes and tenures above 100 years."""
    return decisions.format_client(scoring.score_report(fx.unusual_scored(spark, sf_dir)))


def score_response(spark, sf_dir):
    """The nested response of every client, flattened."""
    nested = scoring.score_response(scoring.score_report(fx.scored(spark, sf_dir)))
    return nested.select("client_id", "client_info.*", "prediction.*")


def client_response(spark, sf_dir):
    """The full answer for the requested ids (found or not), flattened."""
    # the id filter reaches the scan first, so no per-row work is heavy here
    resp = decisions.client_response(fx.scored(spark, sf_dir), list(fx.REQUESTED_IDS), RUN_TS)
    return resp.select(
        "client_id", "found", "error", "client_info.*", "prediction.*",
        F.col("recommendation.risk_level").alias("risk_level"),
        F.col("recommendation.decision").alias("decision"),
        "metadata.analysis_date", "metadata.analysis_time", "metadata.version")


def stamp(spark, sf_dir):
    report = scoring.score_report(fx.scored(spark, sf_dir)).select("client_id")
    return decisions.stamp(report, RUN_TS)


def client_dossier(spark, sf_dir):
    report = decisions.with_risk_level(scoring.score_report(fx.scored(spark, sf_dir)))
    dossier = decisions.client_dossier(report, fx.identities(spark, sf_dir))
    return dossier.select("client_id", "client_name", "photo_url", "risk_score", "risk_level")


def segment_filter(spark, sf_dir):
    picked = filters.segment_filter(fx.scored(spark, sf_dir), **SEGMENT_EXAMPLE)
    return decisions.with_risk_level(picked).select(
        "SK_ID_CURR", "NAME_INCOME_TYPE", "NAME_CONTRACT_TYPE", "risk_score", "risk_level")


def risk_level_summary(spark, sf_dir):
    return decisions.risk_level_summary(fx.scored(spark, sf_dir))


def feedback_levels(spark, sf_dir):
    norm = feedback.normalise_feedback(fx.feedback_records(spark, sf_dir))
    return norm.select("event_id", "message", "level",
                       F.try_element_at("custom_dimensions", F.lit("k")).alias("k"))


def feedback_json(spark, sf_dir):
    """The same records as JSON bodies (nulls are absent keys in
    ``to_json``) parsed back by the JSON ingestion path."""
    recs = fx.feedback_records(spark, sf_dir)
    bodies = recs.select("event_id", F.to_json(F.struct(
        "message", "custom_dimensions", "is_positive")).alias("value"))
    parsed = feedback.parse_feedback(bodies)
    return parsed.select("event_id", "message", "level", "malformed",
                         F.try_element_at("custom_dimensions", F.lit("k")).alias("k"))


def feedback_malformed(spark, sf_dir):
    """Broken lines, absent keys, nulls and flags that aren't booleans."""
    parsed = feedback.parse_feedback(fx.feedback_bodies(spark, sf_dir))
    return parsed.select("event_id", "message", "is_positive", "level", "malformed", "_corrupt_record")


def feedback_stream(spark, sf_dir):
    """End-to-end streaming ingestion: the feedback bodies are written as
    JSON lines into the shared checkpoint folder, a Structured Streaming job
    (``read_feedback`` -> parquet sink partitioned by level, checkpointed,
    ``availableNow``) ingests them, and the sink's content is returned."""
    with scratch_folder(spark, "feedback") as base:
        recs = fx.feedback_records(spark, sf_dir)
        (recs.select(F.to_json(F.struct("event_id", "message", "custom_dimensions",
                                        "is_positive")).alias("value"))
             .write.text(f"{base}/incoming"))
        records = feedback.read_feedback(spark, f"{base}/incoming", streaming=True, keys=("event_id",))
        query = feedback.write_feedback(records, f"{base}/sink", checkpoint=f"{base}/stream-checkpoint")
        query.awaitTermination()
        return (spark.read.parquet(f"{base}/sink")
                .select(F.col("event_id").cast("long").alias("event_id"), "message", "level", "malformed",
                        F.try_element_at("custom_dimensions", F.lit("k")).alias("k")).checkpoint())


QUERIES: dict[str, Query] = {
    "portfolio_filter": portfolio_filter,
    "age_band": _analysis(1),
    "credit_income_quintile": _analysis(2, QUINTILE_COLUMNS),
    "credit_income_quintile_filtered": _analysis(2, QUINTILE_COLUMNS, **QUINTILE_FILTER_EXAMPLE),
    "credit_income_tiles": credit_income_tiles,
    "odd_amount_tiles": odd_amount_tiles,
    "odd_amount_sums": odd_amount_sums,
    "income_type": _analysis(3),
    "income_type_filtered": _analysis(3, **FLOOR_EXAMPLE),
    "employment_band": _analysis(4),
    "enquiry_band": _analysis(5),
    "contract_realty": _analysis(6),
    "family_children": _analysis(7),
    "family_children_filtered": _analysis(7, **FAMILY_FLOOR_EXAMPLE),
    "weekday": _analysis(8),
    "cohort_report": cohort_report,
    "age_band_records": age_band_records,
    "contract_realty_matrix": contract_realty_matrix,
    "family_children_matrix": family_children_matrix,
    "contract_realty_matrix_all": contract_realty_matrix_all,
    "family_children_matrix_all": family_children_matrix_all,
    "base_analyses": base_analyses,
    "csv_applications": csv_applications,
    "csv_applicants": csv_applicants,
    "prepare_features": prepare_features,
    "preprocess_features": preprocess_features,
    "client_lookup": client_lookup,
    "client_lookup_batch": client_lookup_batch,
    "fit_risk_model": fit_risk_model,
    "fit_check": fit_check,
    "score_fixed_model": score_fixed_model,
    "score_portfolio": score_portfolio,
    "fallback_score": fallback_score,
    "score_report": score_report,
    "score_response": score_response,
    "recommend": recommend,
    "format_client": format_client,
    "format_unusual_clients": format_unusual_clients,
    "stamp": stamp,
    "client_response": client_response,
    "client_dossier": client_dossier,
    "segment_filter": segment_filter,
    "risk_level_summary": risk_level_summary,
    "feedback": feedback_levels,
    "feedback_json": feedback_json,
    "feedback_malformed": feedback_malformed,
    "feedback_stream": feedback_stream,
}
