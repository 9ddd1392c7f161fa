"""Feedback ingestion: defaults, levels, malformed lines, batch and stream."""

import json
import os

from pyspark.sql import functions as F

import pytest

from lendlens.sources import fixtures as fx
from lendlens.streaming import feedback


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_parse_defaults_and_nulls(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_lines(src, "a.json", [
        json.dumps({"message": "ok", "custom_dimensions": {"k": 1}, "is_positive": True}),
        json.dumps({}),
        json.dumps({"message": None, "is_positive": None, "custom_dimensions": None}),
        json.dumps({"message": "bad", "is_positive": False}),
        json.dumps({"message": "odd dims", "custom_dimensions": "text", "is_positive": True}),
        "{not json",
    ])
    rows = feedback.read_feedback(spark, src).collect()
    by_msg = {(r["message"], r["level"], r["malformed"]) for r in rows}
    assert ("ok", "INFO", False) in by_msg
    assert ("Message vide", "INFO", False) in by_msg       # absent keys take defaults
    assert (None, "ERROR", False) in by_msg                # explicit nulls kept, null flag negative
    assert ("bad", "ERROR", False) in by_msg
    bad = [r for r in rows if r["malformed"]]
    assert len(bad) == 1 and bad[0]["_corrupt_record"] == "{not json"
    ok = [r for r in rows if r["message"] == "ok"][0]
    assert ok["custom_dimensions"] == {"k": "1"}
    empty = [r for r in rows if r["message"] == "Message vide"][0]
    assert empty["custom_dimensions"] == {}
    odd = [r for r in rows if r["message"] == "odd dims"][0]   # other fields survive
    assert odd["level"] == "INFO" and odd["custom_dimensions"] is None


def test_lines_that_are_no_feedback_are_kept_apart(spark, tmp_path):
    src = str(tmp_path / "broken")
    _write_lines(src, "a.json", ["{not json", "[1]", '"text"', "7", "null", '{"message": "fine"}'])
    rows = feedback.read_feedback(spark, src).collect()
    broken = [r for r in rows if r["malformed"]]
    assert {r["_corrupt_record"] for r in broken} == {"{not json", "[1]", '"text"', "7", "null"}
    assert {(r["level"], r["message"], r["is_positive"], r["custom_dimensions"]) for r in broken} == {
        ("MALFORMED", None, None, None)}


@pytest.mark.parametrize("flag,positive", [
    ("true", True), ("false", False), ("null", False), ("0", False), ("0.0", False), ("-0.0", False),
    ("1", True), ("-2.5", True), ('""', False), ('"false"', True), ('"0"', True), ("[]", False),
    ("[0]", True), ("{}", False), ('{"a": null}', True)])
def test_flags_count_by_their_truth(spark, tmp_path, flag, positive):
    src = str(tmp_path / "flags")
    _write_lines(src, "a.json", ['{"message": "m", "is_positive": %s}' % flag])
    row = feedback.read_feedback(spark, src, keys=("message",)).first()
    assert (row["is_positive"], row["level"]) == (positive, "INFO" if positive else "ERROR")


def test_table_records(spark, sf_dir):
    norm = feedback.normalise_feedback(fx.feedback_records(spark, sf_dir))
    assert norm.where("message IS NULL OR level IS NULL").count() == 0
    levels = {r["level"] for r in norm.select("level").distinct().collect()}
    assert levels == {"INFO", "ERROR"}


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_dir, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    records = fx.feedback_records(spark, sf_dir).drop("event_id")
    lines = [r[0] for r in records.select(F.to_json(F.struct(*records.columns))).collect()]
    _write_lines(src, "part-0.json", lines[:700] + ["garbage"])
    _write_lines(src, "part-1.json", lines[700:])

    q = feedback.write_feedback(feedback.read_feedback(spark, src, streaming=True), out, ck)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = feedback.read_feedback(spark, src)
    cols = ["message", "level", "malformed"]
    assert sorted(map(repr, streamed.select(cols).collect())) == sorted(map(repr, batch.select(cols).collect()))
    assert streamed.where("malformed").count() == 1
    assert sorted(os.listdir(out)) == ["_spark_metadata", "level=ERROR", "level=INFO", "level=MALFORMED"]

    q2 = feedback.write_feedback(feedback.read_feedback(spark, src, streaming=True), out, ck)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == streamed.count() == len(lines) + 1


def test_batch_sink_partitions_by_level(spark, sf_dir, tmp_path):
    out = str(tmp_path / "batch")
    feedback.write_feedback(feedback.normalise_feedback(fx.feedback_records(spark, sf_dir)), out)
    assert {"level=INFO", "level=ERROR"} <= set(os.listdir(out))
