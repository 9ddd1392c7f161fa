"""Portfolio sources: application tables, identities, and the shared base.

Readers take an explicit schema (no inference pass over the files). Parquet
is the default at scale: filters and column selection reach the scan.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import APPLICANT_SCHEMA, APPLICATION_SCHEMA, ID_COL


REJECTED = "_rejected"


def _typed(text: Column, kind: T.DataType) -> Column:
    """A CSV value as ``kind``; null when it can't be read. Whole numbers
    written as decimals (``1.0``, ``-9000.0``, as data frames with gaps write
    integer columns) are integers, exactly; so are whole numbers in exponent
    form as far as a double holds them."""
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    number = text.try_cast("double")
    return (F.when(F.trim(text).rlike(r"^[+-]?[0-9]+\.0*$"), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast(kind))
            .otherwise(F.coalesce(text.try_cast(kind),
                                  F.when(number == F.floor(number), number.cast("decimal(38,0)").try_cast(kind)))))


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, rejected: bool) -> DataFrame:
    """CSV with a header: columns are taken by name (an application file has
    its own column order and many more columns), read as text and typed.

    All files of a folder must have the first file's header; another one
    fails the read instead of shifting values. A missing column is a typed
    null. A value that can't be read is null, and ``rejected`` adds the number
    of such values per row as ``_rejected``; in a column that can't be null
    (the client id) it fails the read. No schema-inference pass is made.
    """
    raw = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    out, bad = [], F.lit(0)
    for f in schema.fields:
        if f.name not in raw.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"`{f.name}`")
        value = _typed(text, f.dataType)
        if not f.nullable:
            unreadable = F.concat(F.lit(f"unreadable {f.name}: "), F.coalesce(text, F.lit("(empty)")))
            value = F.coalesce(value, F.raise_error(unreadable).cast(f.dataType))
        bad = bad + F.when(value.isNull() & (F.trim(text) != ""), 1).otherwise(0)
        out.append(value.alias(f.name))
    return raw.select(*out, bad.alias(REJECTED)) if rejected else raw.select(*out)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, rejected: bool) -> DataFrame:
    if fmt == "csv":
        return _read_csv(spark, path, schema, rejected)
    df = spark.read.schema(schema).format(fmt).load(path)
    return df.withColumn(REJECTED, F.lit(0)) if rejected else df


def read_applications(spark: SparkSession, path: str, fmt: str = "parquet",
                      rejected: bool = False) -> DataFrame:
    """Labelled loan applications (44 columns), with ``rejected`` the number
    of values of a row that couldn't be read (CSV)."""
    return _read(spark, path, APPLICATION_SCHEMA, fmt, rejected)


def read_applicants(spark: SparkSession, path: str, fmt: str = "parquet",
                    rejected: bool = False) -> DataFrame:
    """Applications to score; ``TARGET`` is optional and ignored."""
    return _read(spark, path, APPLICANT_SCHEMA, fmt, rejected)


def identities(df: DataFrame, id_col: str = ID_COL, name_col: str = "client_name",
               photo_col: str | None = None) -> DataFrame:
    """Conform any identity source (document store export, table, ...) to
    ``(SK_ID_CURR, client_name, photo_url)``."""
    photo = F.col(photo_col) if photo_col else F.lit(None).cast("string")
    return df.select(F.col(id_col).cast("long").alias(ID_COL),
                     F.col(name_col).cast("string").alias("client_name"),
                     photo.cast("string").alias("photo_url"))


def persist_base(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep a (filtered, pruned) base table across several analyses.

    Apply filters and select the needed columns first so the cache holds
    only what the analyses read; the cache fills on the first action (no
    forcing ``count``). Call ``unpersist`` when done. Spilling to disk keeps
    a base larger than executor memory usable.
    """
    return df.persist(level)
