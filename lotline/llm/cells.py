"""Links within groups of nodes, found in bounded cells and returned as a spanning set.

A group may be of any size. Its nodes are dealt to cells of about ``cell`` nodes, or fewer where they
are heavy, so that a cell of long texts is bounded as well. In a cell a search
starts at a node and compares it with all nodes not reached yet; those that link are reached and
searched from in turn. A node that is reached is never compared with another reached one, so a
dense group of n nodes takes about n comparisons, and at most n - 1 links come out of any cell. No
pair of nodes of different components is left out, whatever the group's shape.

Then groups of several cells whose links leave several components are gone through again, cell
against cell, by the same search, which now starts from whole components and compares across
components only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.components import components
from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = ["group", "low", "high"]


def numbered(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Sorted sets with their numbers replaced by small ones from 0, and how many of those there are.

    One sorted copy of all sets is held beside them, no more.
    """
    every = np.concatenate(sets)
    every.sort()
    every = every[np.append(True, every[1:] != every[:-1])]
    return [np.searchsorted(every, s).astype(np.int32) for s in sets], len(every)


def search(labels: np.ndarray, parts: np.ndarray, near: Callable) -> list[tuple[int, int]]:
    """A spanning set of the links between nodes of different labels and parts.

    ``near(i, others)`` tells which of ``others`` link with node i. Nodes of one label count as
    linked already; nodes of one part and different labels as not linked.
    """
    alone = len(np.unique(labels)) == len(labels)
    crossing = bool((parts != parts[0]).any())
    left, found = np.arange(len(labels)), []
    while len(left) > 1:
        first = left[:1] if alone else left[labels[left] == labels[left[0]]]
        left = left[1:] if alone else left[labels[left] != labels[first[0]]]
        reached = first.tolist()
        while reached and len(left):
            i = reached.pop()
            others = left[parts[left] != parts[i]] if crossing else left
            hits = others[near(i, others)] if len(others) else others
            if not len(hits):
                continue
            if alone:
                found += [(i, j) for j in hits.tolist()]
                left = left[~np.isin(left, hits, assume_unique=True)]
                reached += hits.tolist()
            else:
                new, at = np.unique(labels[hits], return_index=True)
                found += [(i, j) for j in hits[at].tolist()]
                joined = np.isin(labels[left], new)
                reached += left[joined].tolist()
                left = left[~joined]
    return found


def _links(compare: Callable[[pa.Table], Callable]):
    """Links (a, b) of rows sorted by cell; ``compare`` makes the test of a cell's nodes."""

    def of_cell(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held)
        if table.num_rows < 2:
            return None
        node, label, part = (table.column(c).to_numpy() for c in ("node", "label", "part"))
        found = search(label, part, compare(table))
        a, b = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in KEY], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                key = keys[start].tolist()
                if held and key != last:
                    out = of_cell(held)
                    if out is not None:
                        yield out
                    held = []
                held.append(batch.slice(start, stop - start))
                last = key
        out = of_cell(held) if held else None
        if out is not None:
            yield out

    return run


def _searched(rows: DataFrame, compare: Callable) -> DataFrame:
    dealt = rows.repartition(*KEY).sortWithinPartitions(*KEY)
    return dealt.mapInArrow(_links(compare), "a long, b long").distinct()


def links_within(
    members: DataFrame,
    payload: DataFrame,
    compare: Callable[[pa.Table], Callable],
    cell: int,
    label: str,
    cell_weight: int | None = None,
) -> DataFrame:
    """A spanning set (a, b) of the links within the groups of ``members`` (group, node).

    ``payload`` has one row for each node with what ``compare`` needs; it is joined once the cells
    of a node are known. A node may be in several groups. No members give no links. With
    ``cell_weight``, members have a ``weight``, and a cell has about so much of it at most, or one node.
    """
    count = F.count(F.lit(1))
    parts = F.ceil(count / F.lit(cell))
    if cell_weight:
        parts = F.least(count, F.greatest(parts, F.ceil(F.sum("weight") / F.lit(cell_weight))))
    sizes = members.groupBy("group").agg(parts.alias("parts"))
    dealt = staged(
        members.join(sizes.where("parts > 1"), "group", "left").select(
            "group",
            "node",
            F.coalesce("parts", F.lit(1)).alias("parts"),
            F.pmod(F.xxhash64("node", "group"), F.coalesce("parts", F.lit(1))).alias("part"),
        ),
        f"{label}-cells",
    )
    columns = [c for c in payload.columns if c != "node"]
    alone = dealt.join(payload, "node").select(
        "group", F.col("part").alias("low"), F.col("part").alias("high"), "node",
        F.col("node").alias("label"), F.lit(0).cast("long").alias("part"), *columns,
    )
    found = staged(_searched(alone, compare), f"{label}-links")
    cut = dealt.where("parts > 1")
    if cut.isEmpty():
        return found
    labels = components(found)
    placed = cut.join(labels, "node", "left").select(
        "group", "node", "parts", "part", F.coalesce("label", "node").alias("label")
    )
    several = placed.groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    across = (
        placed.join(several.select("group"), "group", "left_semi")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
        .where("other <> part")
        .join(payload, "node")
        .select(
            "group", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "node", "label", "part", *columns,
        )
    )
    # What is one component already goes on as links to its label, so that it is not gathered again.
    stars = labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return staged(stars.union(_searched(across, compare)), f"{label}-links")
