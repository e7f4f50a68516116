"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. Between stages the rows are
written as Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotline.llm import factorisation, jaccard_rtree, packing, radix_dedup, suffix_arrays
from lotline.llm.common import read
from lotline.llm.queries import WORD_BPE, vocabulary
from lotline.sources.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier rejects go.

    It learns from the labels of this stage's documents; without labels nothing is rejected.
    """
    return factorisation.good_documents(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the row with the largest doc_id stays."""
    return radix_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each component of linked documents the smallest doc_id stays."""
    return jaccard_rtree.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents of which a twentieth or more of the words is benchmark text go."""
    return suffix_arrays.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the sequence and place of each piece of each document."""
    return packing.packed_pieces(docs, vocabulary(WORD_BPE))


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("packed", packed),
]

# A trained classifier and a tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
