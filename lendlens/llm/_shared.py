"""Tables and files in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder under the shared checkpoint folder (inside
    ``tidy``: under its scratch folder)."""
    base = _scratch.get() or ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a folder URI, for tasks that write or read files
    in a format Spark has no writer for."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts
    the lineage, survives lost executors, computed once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the table that ``materialised`` wrote for ``df``; nothing that
    reads it may run any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        remove(folder)


def tidy(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write the result of ``build`` as a table and read it back; the tables
    and files that ``build`` wrote under the shared folder are removed."""
    result, scratch = shared_folder(spark, name), shared_folder(spark, f"{name}-scratch")
    token = _scratch.set(scratch)
    try:
        df = build()
        df.write.parquet(result)
        return spark.read.schema(df.schema).parquet(result)
    finally:
        _scratch.reset(token)
        remove(scratch)


@contextmanager
def committed(filesystem_: fs.FileSystem, path: str):
    """A file that appears under ``path`` only when complete: each attempt of
    a task writes a file of its own and renames it at the end, so a repeated
    or speculative attempt replaces whole content by the same whole content."""
    attempt = f"{path}.{uuid.uuid4().hex}.attempt"
    with filesystem_.open_output_stream(attempt, compression=None) as out:
        yield out
    if (not isinstance(filesystem_, fs.LocalFileSystem)
            and filesystem_.get_file_info(path).type != fs.FileType.NotFound):
        filesystem_.delete_file(path)
    filesystem_.move(attempt, path)


def make(uri: str) -> None:
    """Make a folder named by ``shared_folder``, for files tasks write themselves."""
    where, path = filesystem(uri)
    where.create_dir(path, recursive=True)


def remove(uri: str) -> None:
    """Remove a folder made by ``shared_folder``."""
    where, path = filesystem(uri)
    if where.get_file_info(path).type == fs.FileType.Directory:
        where.delete_dir(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster's owner
    sets in proportion to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
