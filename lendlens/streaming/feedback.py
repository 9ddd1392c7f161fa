"""User feedback ingestion, batch or Structured Streaming.

A feedback body is a JSON object with ``message``, ``custom_dimensions``
(free key/value map) and ``is_positive``. Missing keys take defaults
(``Message vide``, an empty map, positive); a positive record is logged at
INFO, any other at ERROR. A line that is no JSON object is no feedback: it
keeps its text and has the level MALFORMED. The same column logic serves a
batch DataFrame and a stream, and the sink appends parquet partitioned by level.

The job is stateless: no watermark or state store is needed, every record is
handled on its own, so a stream scales with the number of input files and
restarts from its checkpoint without duplicating output (file sink + offset
log are exactly-once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import labels as L

_DIMS_TYPE = "map<string,string>"
_BODY_TYPE = "struct<message:string,custom_dimensions:map<string,string>>"
MALFORMED = "MALFORMED"
_EMPTY_JSON = ("null", "false", '""', "[]", "{}")  # values that count as no


def _truthy(value: Column) -> Column:
    """Whether a JSON value (variant) counts as yes: not null, false, zero or
    empty."""
    text = F.to_json(value)
    return ~(text.isin(*_EMPTY_JSON) | F.coalesce(text.try_cast("double") == 0, F.lit(False)))


def _level(positive: Column) -> Column:
    # Truthiness of the flag: true -> INFO; false or an explicit null -> ERROR.
    return F.when(positive, F.lit(L.FEEDBACK_LEVEL_POSITIVE)).otherwise(
        F.lit(L.FEEDBACK_LEVEL_NEGATIVE))


def normalise_feedback(df: DataFrame) -> DataFrame:
    """Typed feedback records (``message``, ``custom_dimensions``,
    ``is_positive``) -> defaults applied and ``level`` added. In a table a
    null field is an absent key (``to_json`` writes no key for it), so it
    takes the default. Other columns are kept."""
    empty = F.create_map().cast(_DIMS_TYPE)
    positive = F.coalesce(F.col("is_positive"), F.lit(True))
    return df.withColumns({
        "message": F.coalesce(F.col("message"), F.lit(L.FEEDBACK_EMPTY_MESSAGE)),
        "custom_dimensions": F.coalesce(F.col("custom_dimensions"), empty),
        "is_positive": positive,
        "level": _level(positive),
    })


def parse_feedback(df: DataFrame, text_col: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """JSON feedback bodies (one per line) -> normalised records.

    Absent keys take the defaults; a key that is present with JSON ``null``
    keeps null (and a null flag is negative), as a dictionary lookup with a
    default would. A flag that isn't a boolean counts by its truth: null, 0,
    empty text, list or object are negative, anything else is positive.

    Lines that are not a JSON object are kept with ``malformed = true``, the
    level ``MALFORMED``, the raw text in ``_corrupt_record`` and no defaults.
    ``keys`` names further top-level keys to keep, as text columns.
    """
    raw = F.col(text_col)
    names = F.json_object_keys(raw)                 # null unless a JSON object
    malformed = names.isNull()
    body = F.from_json(raw, _BODY_TYPE)
    has = lambda k: F.coalesce(F.array_contains(names, F.lit(k)), F.lit(False))
    flag = F.variant_get(F.try_parse_json(raw), "$.is_positive", "variant")
    positive = F.when(has("is_positive"), F.coalesce(_truthy(flag), F.lit(False))).otherwise(F.lit(True))
    out = df.withColumns({
        **{k: F.get_json_object(raw, f"$.{k}") for k in keys},
        "malformed": malformed,
        "message": F.when(has("message"), body["message"]).when(~malformed, L.FEEDBACK_EMPTY_MESSAGE),
        "custom_dimensions": F.when(has("custom_dimensions"), body["custom_dimensions"])
                              .when(~malformed, F.create_map().cast(_DIMS_TYPE)),
        "is_positive": F.when(~malformed, positive),
    })
    out = out.withColumns({
        "level": F.when(F.col("malformed"), MALFORMED).otherwise(_level(F.col("is_positive"))),
        "_corrupt_record": F.when(F.col("malformed"), raw),
    })
    return out.drop(text_col)


def read_feedback(spark: SparkSession, path: str, streaming: bool = False,
                  max_files_per_trigger: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Feedback JSON lines under ``path`` as normalised records; a stream
    when ``streaming`` (new files are picked up as they land)."""
    if not streaming:
        return parse_feedback(spark.read.text(path), keys=keys)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_feedback(reader.load(path), keys=keys)


def write_feedback(df: DataFrame, path: str, checkpoint: str | None = None,
                   available_now: bool = True) -> StreamingQuery | None:
    """Append records as parquet partitioned by ``level``. A streaming input
    needs a ``checkpoint`` location and returns the running query (with
    ``availableNow`` it processes what is there and stops)."""
    if not df.isStreaming:
        df.write.mode("append").partitionBy("level").parquet(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming feedback sink needs a checkpoint location")
    writer = (df.writeStream.format("parquet").outputMode("append")
                .partitionBy("level").option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)

