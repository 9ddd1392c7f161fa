"""Scratch folders under the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


@contextmanager
def scratch_folder(spark: SparkSession, name: str):
    """URI of a new folder, removed with all it holds at the end. What is read
    from it must be checkpointed or collected before."""
    uri = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        yield uri
    finally:
        where, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
        if where.get_file_info(path).type == fs.FileType.Directory:
            where.delete_dir(path)
