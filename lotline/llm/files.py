"""Files that tasks write into and read from the shared folder.

A task writes each file under a name of its own and reports it in its output rows. Those rows are
the manifest, which Spark commits; readers open only what it lists. Files of failed or repeated
attempts are never listed, so a lost executor leaves no trace in the result.
"""

from __future__ import annotations

import sys
import uuid

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.sources.staging import staged, staging_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/lotline/{label}-{uuid.uuid4().hex}"


def create(folder: str, suffix: str):
    """A new file in ``folder``: its path and an open stream."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return path, system.open_output_stream(inner, compression=None)


def open_to_read(path: str):
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def committed(manifest: DataFrame, label: str) -> DataFrame:
    """Write the files by writing their manifest."""
    return staged(manifest, label)


def spread(manifest: DataFrame, key: str = "path") -> DataFrame:
    """The manifest dealt out so that each task reads few files."""
    return manifest.repartition(max(1, min(manifest.count(), 10_000)), F.xxhash64(key))
