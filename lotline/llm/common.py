"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import sys
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Send this module's code along with functions that use it, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def crc_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of an id's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def drawn(share, column: str = "doc_id") -> Column:
    """Whether the hash of an id lies in the lowest ``share`` of all hashes; no share is too small."""
    return F.xxhash64(column).bitwiseAND((1 << 63) - 1).cast("double") <= share * float(1 << 63)


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker process.

    Functions sent by value get fresh globals for each task; loaded vocabularies and bounded
    caches are kept here instead, so a worker builds them once. Only those of one operator are
    kept at a time: a worker that goes on to another operator's tasks drops the ones before.
    """
    home = sys.modules.setdefault("lotline_worker_store", ModuleType("lotline_worker_store"))
    if getattr(home, "name", None) != name:
        home.name, home.kept = name, {}
    return home.kept
