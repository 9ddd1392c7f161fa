"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the next
stage reads what it wrote. All but the last return the columns of documents.
A stage's statistics, models and duplicate groups come from its own input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lendlens.llm import _shared, decontaminate, minhash, packing, pii, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(df):
    """The columns of documents, with the length of the text as it is now."""
    return df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    docs = docs.select(*COLUMNS)
    described = _shared.materialised(quality.describe(docs), "quality-statistics")
    model = quality.fit(described, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    _shared.forget(described)
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group: the one with the smallest id.
    Rows that repeat an id are one document only where their texts are equal."""
    docs = docs.select(*COLUMNS)
    others = _shared.tidy(spark, "near-duplicates", lambda: (
        minhash.near_duplicate_classes(docs).where(~F.col("lead")).select("doc_id", "text_key").distinct()))
    named = docs.where("doc_id is not null").withColumn("text_key", minhash.text_key(F.col("text")))
    named = named.join(others, ["doc_id", "text_key"], "left_anti").dropDuplicates(["doc_id", "text_key"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def remove_benchmark(spark, docs, sf_dir):
    """Benchmark passages cut out; documents that mostly consist of them go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _columns(decontaminate.decontaminate(docs.select(*COLUMNS), items))


def redact_personal_data(spark, docs, sf_dir):
    """Personal data replaced by its kind."""
    docs = docs.select(*COLUMNS)
    spotted = _shared.materialised(pii.spot(docs), "pii-spotted")
    judge = pii.fit(spotted)
    _shared.forget(spotted)
    return _columns(pii.redact(docs, judge))


def pack(spark, docs, sf_dir):
    """Windows of 1024 token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]


def run(spark, sf_dir):
    """All stages over documents, each written as Parquet and read again; a
    stage's output goes once the next is written."""
    before = None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = _shared.tidy(spark, f"pipeline-{name}", lambda: stage(spark, docs, sf_dir))
        if before is not None:
            _shared.forget(before)
        before = docs
    return docs


# The quality model, the MinHash index and the tokenizer have no SQL form.
ORACLE_SQL = None
