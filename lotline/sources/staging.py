"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

# The folder of the run in progress, below the root.
_run: ContextVar[str] = ContextVar("run", default="")


def staging_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder there that driver and executors share"
        )
    return root.rstrip("/")


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; results must not read them any more."""
    name = f"/run-{uuid.uuid4().hex}"
    token = _run.set(name)
    try:
        yield
    finally:
        _run.reset(token)
        _remove(f"{staging_root(spark)}/lotline{name}")


def _remove(folder: str) -> None:
    """Remove a folder; on a file system that Arrow does not know, it is left to expire."""
    try:
        system, path = fs.FileSystem.from_uri(folder)
    except (OSError, ValueError):
        return
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def staged(df: DataFrame, label: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader of it.

    Several uses then share one computation, its lineage ends at files that outlive any executor,
    and each use reads only the columns it needs. A ``lasting`` table stays when a staging run ends.
    """
    run = "" if lasting else _run.get()
    path = f"{staging_root(df.sparkSession)}/lotline{run}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
