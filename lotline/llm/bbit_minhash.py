"""Near-duplicates by b-bit MinHash.

A document is the set of its distinct two-word shingles; two link when their Jaccard similarity is
at least 0.8. Each distinct word sequence is one node. Its ``MINIMA`` smallest hash values serve
twice: ``BANDS`` groups of ``ROWS`` whole minima give a key each, and the lowest ``BITS`` bits of
every minimum, packed into 64 bytes, are kept as the signature.

1. Nodes with a common band key are candidates. Two sets of similarity 0.8 have none of the 51
   keys in common with a probability of 2e-9.
2. In each band group the similarity of candidates is estimated from their signatures: the equal
   low bits are counted with exclusive or and a bit count, and as unequal minima agree in their low
   bits with probability 1/2^b, the bound on the count is corrected for that. Pairs that are not
   5.5 standard deviations below a link make families of nodes, found by a search that gives a
   spanning set of them, not all pairs.
3. In each family the same search confirms links on the full shingle sets. Its links' components
   are the result; equal texts need no comparison.

Families and band groups of any size are cut into cells (see cells.py), so no group meets in one
task and hot groups are spread.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.cells import links_within, numbered
from lotline.llm.components import components
from lotline.llm.shingles import mixed, name_of, shingler, words_of
from lotline.sources.staging import staged, staging_run

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 2
#: Similarity as a percentage.
PERCENT = 80
MINIMA, BITS, BANDS, ROWS = 256, 2, 51, 5
#: Standard deviations that an estimate may lie below a link and still be confirmed.
SIGMAS = 5.5
#: Shingles hashed together, nodes of a cell of a band group and of a family, and shingles of the latter.
ROUND_SHINGLES = 1 << 16
BAND_CELL, FAMILY_CELL, FAMILY_SHINGLES = 4096, 1024, 1 << 21

_WORDS = MINIMA * BITS // 64
_LANES = np.uint64(int("01" * (64 // BITS), 2)) if BITS == 2 else None


# --- signatures ----------------------------------------------------------------------------------


def hash_rules() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of the ``MINIMA`` hash functions."""
    x = mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x >> np.uint64(16)).astype(np.uint32)
    return x[:MINIMA] | np.uint32(1), x[MINIMA:]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, MINIMA) smallest hash values of sets that are not empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    shingles = np.concatenate(sets)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.empty((MINIMA, len(sets)), np.uint32)
    value = np.empty_like(folded)
    for k, (factor, mask) in enumerate(zip(*hash_rules())):
        np.bitwise_xor(folded, mask, out=value)
        np.multiply(value, factor, out=value)
        out[k] = np.minimum.reduceat(value, starts)
    return out.T


def band_keys(found: np.ndarray) -> np.ndarray:
    """(documents, BANDS) 64-bit keys, each of ROWS whole minima and the band's number."""
    bands = found[:, : BANDS * ROWS].reshape(len(found), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for r in range(ROWS):
        key = mixed((key ^ bands[:, :, r]) * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def packed(found: np.ndarray) -> np.ndarray:
    """(documents, words) signatures: the low bits of all minima, side by side."""
    # The smallest of many values has mixed low bits only after another mixing.
    low = mixed(found.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << BITS) - 1)
    per_word = 64 // BITS
    shifts = np.arange(per_word, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(len(found), _WORDS, per_word) << shifts, axis=2)


def agreements(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many minima agree in their low bits with those of ``one``."""
    differ = others ^ one
    differ = (differ | (differ >> np.uint64(1))) & _LANES
    return MINIMA - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def corrected(agreeing):
    """Similarity estimated from agreeing minima, less the chance agreement of unequal ones."""
    chance = 0.5**BITS
    return (agreeing / MINIMA - chance) / (1 - chance)


def least_agreeing() -> int:
    """Agreeing minima from which on a pair is confirmed."""
    chance = 0.5**BITS
    share = PERCENT / 100 * (1 - chance) + chance
    return math.floor(MINIMA * share - SIGMAS * math.sqrt(MINIMA * share * (1 - share)))


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, name, band keys and signature of each document; null names without words."""
    make = shingler(SHINGLE)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        start = held = 0
        names, sets = [], []
        for i in range(batch.num_rows):
            words = words_of(texts[i].as_py())
            names.append(name_of(words) if words else None)
            sets.append(make.set_of(words))
            held += len(sets[-1])
            if held >= ROUND_SHINGLES or i == batch.num_rows - 1:
                yield _signed(batch.slice(start, len(sets)), names, sets)
                start, held, names, sets = i + 1, 0, [], []


def _signed(batch: pa.RecordBatch, names: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [s for s in sets if len(s)]
    found = minima(full) if full else np.zeros((0, MINIMA), np.uint32)
    counts = np.cumsum([0, *[BANDS if len(s) else 0 for s in sets]])
    keys = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(band_keys(found).reshape(-1)))
    signs = iter(packed(found))
    columns = [
        batch.column("row"),
        batch.column("doc_id"),
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(names, pa.binary()),
        keys,
        pa.array([next(signs).tobytes() if len(s) else None for s in sets], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_shingles", "name", "bands", "signature"])


# --- comparisons in a cell -----------------------------------------------------------------------


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(-1, _WORDS)


def alike(table: pa.Table):
    """Estimates that leave a link possible."""
    signs, least = _signatures(table), least_agreeing()
    return lambda i, others: agreements(signs[i], signs[others]) >= least


def linked(table: pa.Table):
    """Links confirmed on the full sets, where sizes and estimates leave one possible."""
    signs, least, make = _signatures(table), least_agreeing(), shingler(SHINGLE)
    sets = [make.set_of(words_of(t.as_buffer().to_pybytes())) for t in table.column("body")]
    sizes = np.array([len(s) for s in sets])
    sets, distinct = numbered(sets)
    mark = np.zeros(distinct, np.int32)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        n, m = sizes[i], sizes[others]
        ok = (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (agreements(signs[i], signs[others]) >= least)
        at = np.flatnonzero(ok)
        if len(at):
            chosen = [sets[j] for j in others[at]]
            mark[sets[i]] = 1
            shared = np.add.reduceat(mark[np.concatenate(chosen)], np.cumsum([0, *map(len, chosen[:-1])]))
            mark[sets[i]] = 0
            ok[at] = 100 * shared >= PERCENT * (n + m[at] - shared)
        return ok

    return near


# --- all together --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, band_cell: int = BAND_CELL, family_cell: int = FAMILY_CELL) -> DataFrame:
    """``docs`` (row, doc_id, text) with n_shingles, component_id and ``first``, one row per row.

    ``row`` must be unique and stay the same when read again. Words are split at ASCII white space
    after lower-casing A-Z. A text of one word is one shingle; one without words, or null, has none
    and is linked with nothing, so its component is its own doc_id. component_id is the smallest
    doc_id that links reach; null doc_ids count only where a component has no other. Repeated rows
    are in one component. ``first`` marks one row of each component: the smallest (doc_id, row),
    null last. Texts are read whole, however long. Other columns are left out, whatever their
    names. An empty table gives an empty result.
    """
    docs = docs.select("row", "doc_id", "text")
    kinds = "row long, doc_id long, n_shingles long, name binary, bands array<long>, signature binary"
    first = staged(docs.mapInArrow(_first_pass, kinds), "minima")
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    # The row of the smallest id stands for all rows with its words.
    names = staged(first.where("name IS NOT NULL").groupBy("name").agg(F.min(lead).alias("lead")), "names")
    with staging_run(docs.sparkSession):
        labels = staged(_labels(docs, first, names, band_cell, family_cell), "labels", lasting=True)
    placed = names.join(labels, F.col("lead.row") == F.col("node"), "left").select(
        "name", "lead", F.coalesce("label", "lead.row").alias("label")
    )
    best = placed.groupBy("label").agg(F.min("lead").alias("best"))
    by_name = placed.join(best, "label").select("name", "best")
    return (
        first.select("row", "doc_id", "n_shingles", "name")
        .join(by_name, "name", "left")
        .select(
            "row",
            "doc_id",
            "n_shingles",
            F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
            F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("first"),
        )
    )


def _labels(docs: DataFrame, first: DataFrame, names: DataFrame, band_cell: int, family_cell: int) -> DataFrame:
    """The component (node, label) of each node that links to another; a node is its first row."""
    leads = names.select(F.col("lead.row").alias("row"))
    nodes = first.join(leads, "row", "left_semi").select(F.col("row").alias("node"), "bands", "signature")
    keyed = nodes.select(F.explode("bands").alias("group"), "node")
    shared = keyed.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    groups = staged(keyed.join(shared, "group"), "band-groups")
    signatures = first.select(F.col("row").alias("node"), "signature")
    candidates = links_within(groups, signatures, alike, band_cell, "band")
    families = staged(components(candidates), "families")
    bodies = (
        families.select("node")
        .join(docs.select(F.col("row").alias("node"), F.col("text").cast("binary").alias("body")), "node")
        .join(signatures, "node")
    )
    sizes = first.select(F.col("row").alias("node"), F.col("n_shingles").alias("weight"))
    members = families.select(F.col("label").alias("group"), "node").join(sizes, "node")
    return components(links_within(members, bodies, linked, family_cell, "family", FAMILY_SHINGLES))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all columns unchanged."""
    numbered = staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("source_row")), "numbered"
    )
    kept = near_duplicates(numbered.select("row", "source_row.doc_id", "source_row.text")).where("first")
    return numbered.join(kept.select("row"), "row", "left_semi").select("source_row.*")
