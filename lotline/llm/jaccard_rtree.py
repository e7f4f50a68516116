"""Documents that share most of their word shingles, with count-vector R-trees.

A document is the set of its distinct five-word shingles. Two link when their Jaccard similarity is
at least 0.8. Links between equal word sequences go without saying: each distinct sequence is one
node. The others are found exactly, in these steps:

1. Routing. Linked sets share one of the first n - ceil(0.8 n) + 1 shingles of each in any common
   order. The order is by how common a shingle is (a sketch of fixed size, counted over all
   documents), so routes are mostly shingles that few documents have. Nodes on one route are a
   block; blocks of a single node go, and of blocks with the same nodes one stays. Most routes are
   a single node's, so they travel as packed arrays, sorted and compared in numpy, and only those
   of several nodes become rows. What a task finds shared it sends on once, however often it occurs.
2. Candidates. The shingles of a node are hashed into groups; its group counts are its point. In each
   block an R-tree over the points answers, for one node after the other, which nodes not reached
   yet may link: the overlap of two sets is at most the sum of the smaller counts, that of a set and
   all below a tree node at most the sum with its upper corner, and sizes must fit. Large sets fill
   all groups about alike, so they have a second point of as many groups as they are large, by which
   what the tree leaves is compared; else all long texts of a table would be one family. Reached nodes
   are searched from in turn, so a block gives a spanning set of its candidate pairs, and the
   components of these are families.
3. Links. Each family is searched in the same way, now with an R-tree over finer counts, and what it
   leaves is verified on the sets themselves. Components of these links are the result.

Nodes of different families cannot link, and within a family no pair of different components stays
unlinked that is a link, so none is lost. Blocks and families beyond a cell (for families in nodes or in shingles) are dealt to cells and
then searched cell against cell (see cells.py), so no task holds an unbounded one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.cells import links_within, numbered
from lotline.llm.common import worker_store
from lotline.llm.components import components
from lotline.sources.staging import staged, staging_run

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
#: Similarity as a percentage.
PERCENT = 80
#: Cells of the sketch of shingle frequencies; its size does not grow with the data.
SKETCH_BITS = 18
SKETCH_SLICES = 16
#: Groups of the points, and of those in a family; entries of a tree node.
GROUPS, FINE_GROUPS = 128, 1024
#: Shingles of a group, on average and at most, beyond which a set has a finer point; the most groups of one.
GROUP_SHINGLES, MOST_GROUPS = 8, 1 << 14
LEAF = 16
#: Nodes of a cell of a block and of a family, and shingles of a cell of a family.
CELL, FAMILY_CELL, FAMILY_SHINGLES = 4096, 1024, 1 << 21
#: Routes that a task holds before it sends them on, and about how many it receives.
HELD_ROUTES, TASK_ROUTES = 1 << 20, 1 << 20
#: Slices of the routes for each receiving task, so that tasks get about equal shares.
TASK_SLICES = 8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a word, with the blank after it, that are numbered by their places; words numbered together.
PLACES, TOGETHER = 64, 1 << 16


# --- shingles ------------------------------------------------------------------------------------


class Shingler:
    """Words to 64-bit numbers and texts to shingle sets.

    The number of a word is the sum of a random entry for each of its bytes and their places, so
    that all words of a text are numbered together. The entries are digests: the same everywhere.
    """

    def __init__(self):
        entries = b"".join(blake2b(i.to_bytes(4, "little")).digest() for i in range(PLACES * 32))
        self.entries = np.frombuffer(entries, "<u8").reshape(PLACES, 256).copy()
        self.entries[:, 32] = 0  # the blank after a word is no part of it
        self.entries = self.entries.reshape(-1)

    def words(self, text: bytes | None) -> list[bytes]:
        return text.translate(_LOWER).split() if text else []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word."""
        if len(words) > TOGETHER:
            parts = range(0, len(words), TOGETHER)
            return np.concatenate([self.numbers(words[i : i + TOGETHER]) for i in parts])
        text = np.frombuffer(b" ".join(words), np.uint8)
        starts = np.append(0, np.flatnonzero(text == 32) + 1)
        sizes = np.diff(np.append(starts, len(text) + 1))  # with the blank
        if sizes.max() >= PLACES:
            # A digest stands for a long word; no other has a capital letter in it.
            return self.numbers([w if len(w) < PLACES - 1 else b"A" + blake2b(w, digest_size=16).hexdigest().encode() for w in words])
        place = np.arange(len(text)) - np.repeat(starts, sizes)[: len(text)]
        return np.add.reduceat(self.entries[(place << 8) | text], starts)

    def set_of(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit shingle numbers."""
        if not words:
            return np.zeros(0, np.uint64)
        numbers = self.numbers(words)
        width = min(SHINGLE, len(words))
        value = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
        for j in range(width):
            value = mixed(value * _ODD + numbers[j : j + len(value)])
        value.sort()
        return value[np.append(True, value[1:] != value[:-1])]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def name_of(words: list[bytes]) -> tuple[int, int]:
    """Two 64-bit numbers of a word sequence, which together name it."""
    digest = blake2b(b" ".join(words), digest_size=16).digest()
    return tuple(int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))


def shingler() -> Shingler:
    known = worker_store("shingler")
    return known.get(0) or known.setdefault(0, Shingler())


def needed(n, m):
    """Shared shingles that sets of n and m need to link."""
    total = PERCENT * (n + m)
    return -(-total // (100 + PERCENT))


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, name and point of each document; at the end, this task's part of the sketch."""
    make = shingler()
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    waiting, held = [], 0
    for batch in batches:
        texts, sizes, names, checks, points, fine = batch.column("text").cast(pa.binary()), [], [], [], [], []
        for i in range(batch.num_rows):
            words = make.words(texts[i].as_py())
            shingles = make.set_of(words)
            name, check = name_of(words) if words else (None, None)
            sizes.append(len(shingles))
            names.append(name)
            checks.append(check)
            points.append(group_counts(shingles).tobytes() if words else None)
            groups = fine_groups(len(shingles))
            fine.append(group_counts(shingles, groups).tobytes() if groups else None)
            waiting.append(shingles)
            held += len(shingles)
            if held > 1 << 20:
                sketch += cell_counts(waiting)
                waiting, held = [], 0
        yield _pass_rows(batch.column("row"), batch.column("doc_id"), sizes, names, checks, points, fine, None, None)
    sketch += cell_counts(waiting)
    if sketch.any():
        parts = [p.tobytes() for p in np.split(sketch, SKETCH_SLICES)]
        none = [None] * len(parts)
        yield _pass_rows(none, none, none, none, none, none, none, list(range(len(parts))), parts)


def cell_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles of some sets fall in each cell of the sketch."""
    if not sets:
        return np.zeros(1 << SKETCH_BITS, np.int64)
    cells = np.concatenate(sets) & np.uint64((1 << SKETCH_BITS) - 1)
    return np.bincount(cells.astype(np.int64), minlength=1 << SKETCH_BITS)


def _pass_rows(row, doc_id, sizes, names, checks, points, fine, slices, parts) -> pa.RecordBatch:
    n = len(sizes)
    columns = [
        pa.array(row, pa.int64()) if isinstance(row, list) else row,
        pa.array(doc_id, pa.int64()) if isinstance(doc_id, list) else doc_id,
        pa.array(sizes, pa.int64()),
        pa.array(names, pa.int64()),
        pa.array(checks, pa.int64()),
        pa.array(points, pa.binary()),
        pa.array(fine, pa.binary()),
        pa.array(slices or [None] * n, pa.int32()),
        pa.array(parts or [None] * n, pa.binary()),
    ]
    names = ["row", "doc_id", "n_shingles", "name", "check", "point", "fine", "slice", "part"]
    return pa.RecordBatch.from_arrays(columns, names=names)


PASS_ROWS = (
    "row long, doc_id long, n_shingles long, name long, check long, point binary, fine binary, slice int, part binary"
)


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for index, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
            more = np.frombuffer(part.as_py(), np.int64)
            sums[index] = sums[index] + more if index in sums else more
    yield pa.RecordBatch.from_pydict(
        {"slice": pa.array(list(sums), pa.int32()), "part": pa.array([s.tobytes() for s in sums.values()], pa.binary())}
    )


def sketch_of(first: DataFrame) -> np.ndarray:
    """How many documents have a shingle in each cell, summed over all tasks."""
    parts = (
        first.where("slice IS NOT NULL").select("slice", "part").repartition(SKETCH_SLICES, "slice")
    ).mapInArrow(_sum_slices, "slice int, part binary")
    sketch = np.zeros((SKETCH_SLICES, (1 << SKETCH_BITS) // SKETCH_SLICES), np.int64)
    for r in parts.collect():  # SKETCH_SLICES rows
        sketch[r["slice"]] += np.frombuffer(r["part"], np.int64)
    return sketch.reshape(-1)


# --- routing -------------------------------------------------------------------------------------


def route(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set, rare ones first."""
    common = sketch[(shingles & np.uint64(len(sketch) - 1)).astype(np.int64)]
    k = prefix_size(len(shingles))
    return shingles[np.argsort(common, kind="stable")[:k]]


def shared_routes(routes: np.ndarray, names: np.ndarray, known: np.ndarray):
    """Distinct entries sorted by (route, name), and which routes have several names or are known."""
    order = np.lexsort((~known, names, routes))
    routes, names, known = routes[order], names[order], known[order]
    first = np.ones(len(routes), bool)
    first[1:] = (routes[1:] != routes[:-1]) | (names[1:] != names[:-1])
    routes, names, known = routes[first], names[first], known[first]
    starts = np.flatnonzero(np.append(True, routes[1:] != routes[:-1])[: len(routes)])
    counts = np.diff(np.append(starts, len(routes)))
    several = (counts > 1) | (np.logical_or.reduceat(known, starts) if len(starts) else np.zeros(0, bool))
    return routes, names, known, starts, np.repeat(several, counts)


def _route_rows(slices, bodies, groups, names) -> pa.RecordBatch:
    """Packed routes of some slices, and members (group, name) of shared routes, spread by name."""
    packed, plain = len(slices), len(groups)
    columns = [
        pa.array([*slices, *(names & 0x7FFF).tolist()], pa.int32()),
        pa.array([*bodies, *[None] * plain], pa.binary()),
        pa.array([*[None] * packed, *groups.tolist()], pa.int64()),
        pa.array([*[None] * packed, *names.tolist()], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["slice", "body", "group", "name"])


def _sent(routes: np.ndarray, names: np.ndarray, slices: int) -> pa.RecordBatch:
    """What a task sends of its routes: members of those it knows as shared, and each route once."""
    routes, names, _, starts, several = shared_routes(routes, names, np.zeros(len(routes), bool))
    members = routes[several], names[several]
    routes, names, several = routes[starts], names[starts], several[starts]
    at = (mixed(routes.view(np.uint64)) >> np.uint64(20)) % np.uint64(slices)
    order = np.argsort(at, kind="stable")
    entries = np.stack([routes, names, several.astype(np.int64)], axis=1)[order]
    found, cuts = np.unique(at[order], return_index=True)
    bodies = [part.tobytes() for part in np.split(entries, cuts[1:])] if len(found) else []
    return _route_rows(found.tolist(), bodies, *members)


def _routes(shared, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, sketch, seen = shingler(), shared.value, set()
        keys, names, held = [], [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                words = make.words(texts[i].as_py())
                if not words:
                    continue
                name = name_of(words)[0]
                if name in seen:  # copies take the same routes
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(name)
                keys.append(route(make.set_of(words), sketch).view(np.int64))
                names.append(np.full(len(keys[-1]), name, np.int64))
                held += len(keys[-1])
                if held > HELD_ROUTES:
                    yield _sent(np.concatenate(keys), np.concatenate(names), slices)
                    keys, names, held = [], [], 0
        if held:
            yield _sent(np.concatenate(keys), np.concatenate(names), slices)

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the shared routes among all slices of a task."""
    bodies = []
    for batch in batches:
        plain = batch.filter(batch.column("body").is_null())
        yield plain.select(["group", "name"])
        bodies += [b.as_py() for b in batch.column("body").drop_null()]
    if bodies:
        entries = np.frombuffer(b"".join(bodies), np.int64).reshape(-1, 3)
        routes, names, known, _, several = shared_routes(entries[:, 0], entries[:, 1], entries[:, 2] != 0)
        several &= ~known  # a task that knew a route as shared has sent its members
        yield pa.RecordBatch.from_arrays([pa.array(routes[several]), pa.array(names[several])], names=["group", "name"])


def blocks_of(docs: DataFrame, nodes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(group, node) of every block: a route with several nodes, one route of those with the same nodes.

    ``nodes`` (node, name, n) gives each node's 64-bit name; nodes that share one are all members.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    total = nodes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)).first()[0] or 0
    tasks = int(total) // TASK_ROUTES + 1
    sent = docs.select("text").mapInArrow(
        _routes(shared, TASK_SLICES * tasks), "slice int, body binary, group long, name long"
    )
    members = sent.repartition(tasks, "slice").mapInArrow(_members, "group long, name long").distinct()
    found = staged(members.join(nodes.select("name", "node"), "name").select("group", "node"), "routes")
    # Counts before the join are combined per task, so a hot route sends one row from each.
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    sizes = found.groupBy("group").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.max("node").alias("high"), *marks
    )
    one = sizes.where("size > 1").groupBy("size", "low", "high", "mark0", "mark1").agg(F.min("group").alias("group"))
    return found.join(one.select("group"), "group")


# --- the R-tree ----------------------------------------------------------------------------------


def group_counts(shingles: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The point of a set: its shingles hashed into groups and counted, up to 255."""
    at = (mixed(shingles) >> np.uint64(40)) % np.uint64(groups)
    return np.minimum(np.bincount(at.astype(np.int64), minlength=groups), 255).astype(np.uint8)


def fine_groups(n: int) -> int:
    """Groups of the finer point of a set of n, or 0 where the plain one tells sets of n apart."""
    if n <= GROUP_SHINGLES * GROUPS:
        return 0
    return min(MOST_GROUPS, 1 << ((n - 1) // GROUP_SHINGLES).bit_length())


class RTree:
    """Bulk-loaded tree over points; nodes keep the upper corner and the range of sizes.

    What a point leaves out of a set, as counts end at 255, is its excess; it counts as shared as
    far as both sets have any.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes.astype(np.int64)
        self.excess = self.sizes - points.sum(axis=1, dtype=np.int64)
        runs = self._arranged(np.arange(len(points)))
        self.order = np.concatenate(runs)
        starts = np.cumsum([0, *map(len, runs[:-1])])
        stops = np.append(starts[1:], len(points))
        upper, excess = points[self.order], self.excess[self.order]
        least = most = self.sizes[self.order]
        #: From the leaves up: bounds of each node, and the range of its members a level below.
        self.levels = []
        while True:
            upper, excess = np.maximum.reduceat(upper, starts, axis=0), np.maximum.reduceat(excess, starts)
            least, most = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
            self.levels.append((upper, excess, least, most, starts, stops))
            if len(starts) == 1:
                break
            starts = np.arange(0, len(upper), LEAF)
            stops = np.append(starts[1:], len(upper))

    def _arranged(self, rows: np.ndarray) -> list[np.ndarray]:
        """Leaves: split at the median of the size while sizes differ much, else of the widest group."""
        if len(rows) <= LEAF:
            return [rows]
        sizes, points = self.sizes[rows], self.points[rows]
        by = sizes if 100 * sizes.min() < PERCENT * sizes.max() else points[:, np.argmax(np.ptp(points, axis=0))]
        order = rows[np.argsort(by, kind="stable")]
        half = len(order) // 2
        return [*self._arranged(order[:half]), *self._arranged(order[half:])]

    def _fits(self, i: int, upper, excess, least, most) -> np.ndarray:
        n = self.sizes[i]
        bound = np.minimum(upper, self.points[i]).sum(axis=1, dtype=np.int64) + np.minimum(excess, self.excess[i])
        return (bound >= needed(n, least)) & (100 * most >= PERCENT * n) & (100 * n >= PERCENT * least)

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` the bounds allow to link with entry i."""
        open_nodes = np.zeros(1, np.int64)
        for upper, excess, least, most, starts, stops in reversed(self.levels):
            kept = open_nodes[self._fits(i, upper[open_nodes], excess[open_nodes], least[open_nodes], most[open_nodes])]
            below = [np.arange(starts[k], stops[k]) for k in kept.tolist()]
            open_nodes = np.concatenate(below) if below else np.zeros(0, np.int64)
        rows = self.order[open_nodes]
        rows = rows[self._fits(i, self.points[rows], self.excess[rows], self.sizes[rows], self.sizes[rows])]
        found = np.zeros(len(self.points), bool)
        found[rows] = True
        return found[others]


# --- comparisons in a cell -----------------------------------------------------------------------


def may_link(table: pa.Table):
    """Pairs of a block that an R-tree over their points and, for large sets, finer points do not exclude."""
    points = np.frombuffer(b"".join(table.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)
    sizes = table.column("n").to_numpy()
    tree = RTree(points, sizes)
    if table.num_rows - table.column("fine").null_count < 2:
        return tree.near
    fine = FinePoints(table.column("fine").to_pylist(), sizes)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        ok = tree.near(i, others)
        at = np.flatnonzero(ok)
        ok[at] = fine.allowed(i, others[at])
        return ok

    return near


class FinePoints:
    """Points of as many groups as their sets are large, one table for each number of groups.

    That is a power of two, so a point folds to fewer groups by adding. The bound is that of the tree.
    """

    def __init__(self, points: list[bytes | None], sizes: np.ndarray):
        self.sizes, self.groups = sizes.astype(np.int64), np.array([len(p) if p else 0 for p in points])
        self.place, self.tables = np.zeros(len(points), np.int64), {}
        self.excess = np.zeros(len(points), np.int64)
        for groups in np.unique(self.groups[self.groups > 0]).tolist():
            rows = np.flatnonzero(self.groups == groups)
            table = np.frombuffer(b"".join([points[r] for r in rows]), np.uint8).reshape(-1, groups)
            self.place[rows], self.tables[groups] = np.arange(len(rows)), table
            self.excess[rows] = self.sizes[rows] - table.sum(axis=1, dtype=np.int64)

    def allowed(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` may link with entry i; those without a finer point may."""
        ok, own = np.ones(len(others), bool), int(self.groups[i])
        if not own:
            return ok
        for groups, table in self.tables.items():
            low, at = min(own, groups), np.flatnonzero(self.groups[others] == groups)
            point = self.tables[own][self.place[i]]
            if own > low:
                point = point.reshape(-1, low).sum(axis=0)
            step = max(1, (1 << 20) // groups)
            for begin in range(0, len(at), step):
                part = at[begin : begin + step]
                rows = others[part]
                held = table[self.place[rows]]
                if groups > low:
                    held = held.reshape(len(rows), -1, low).sum(axis=1)
                shared = np.minimum(held, point).sum(axis=1, dtype=np.int64)
                shared += np.minimum(self.excess[rows], self.excess[i])
                ok[part] = shared >= needed(self.sizes[i], self.sizes[rows])
        return ok


def linked(table: pa.Table):
    """Links of a family: what an R-tree over finer points leaves, verified on the full sets."""
    make = shingler()
    sets = [make.set_of(make.words(body.as_buffer().to_pybytes())) for body in table.column("body")]
    sizes = np.array([len(s) for s in sets])
    tree = RTree(np.stack([group_counts(s, FINE_GROUPS) for s in sets]), sizes)
    sets, distinct = numbered(sets)
    mark = np.zeros(distinct, np.int32)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        ok = tree.near(i, others)
        at = np.flatnonzero(ok)
        if len(at):
            chosen = [sets[j] for j in others[at]]
            mark[sets[i]] = 1
            shared = np.add.reduceat(mark[np.concatenate(chosen)], np.cumsum([0, *map(len, chosen[:-1])]))
            mark[sets[i]] = 0
            ok[at] = 100 * shared >= PERCENT * (sizes[i] + sizes[others[at]] - shared)
        return ok

    return near


# --- all together --------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, cell: int = CELL, family_cell: int = FAMILY_CELL) -> DataFrame:
    """``docs`` (row, doc_id, text) with n_shingles and component_id, one row per row.

    ``row`` must be unique and stay the same when read again; other columns are left out, whatever
    their names. Texts are read whole, however long. Words are split at ASCII white space after lower-casing A-Z. A text
    with fewer than five words is one shingle; one without words, or null, has none and is linked
    with nothing, so its component is its own doc_id. component_id is the smallest doc_id that
    links reach; null doc_ids count only where a component has no other. Repeated rows are in one
    component. ``kept`` marks one row of each component: the smallest (doc_id, row) with null last.
    An empty table gives an empty result.
    """
    docs = docs.select("row", "doc_id", "text")
    first = staged(docs.mapInArrow(_first_pass, PASS_ROWS), "shingle-sizes")
    rows = first.where("slice IS NULL").select("row", "doc_id", "n_shingles", "name", "check", "point", "fine")
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    # Both halves of the name tell word sequences apart; a node's number is the row of its lead.
    nodes = staged(
        rows.where("name IS NOT NULL")
        .groupBy("name", "check")
        .agg(F.min(lead).alias("lead"), F.min("point").alias("point"), F.min("fine").alias("fine"), F.min("n_shingles").alias("n"))
        .select(F.col("lead.row").alias("node"), "*"),
        "nodes",
    )
    with staging_run(docs.sparkSession):
        labels = staged(_labels(docs, first, nodes, cell, family_cell), "labels", lasting=True)

    placed = nodes.join(labels, "node", "left").select(
        "name", "check", F.coalesce("label", "node").alias("label"), "lead"
    )
    best = placed.groupBy("label").agg(F.min("lead").alias("best"))
    by_name = placed.join(best, "label").select("name", "check", "best")
    out = rows.join(by_name, ["name", "check"], "left")
    return out.select(
        "row",
        "doc_id",
        "n_shingles",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


def _labels(docs: DataFrame, first: DataFrame, nodes: DataFrame, cell: int, family_cell: int) -> DataFrame:
    """The component (node, label) of each node that links to another."""
    blocks = staged(blocks_of(docs, nodes, sketch_of(first)), "blocks")
    families = staged(components(links_within(blocks, nodes.select("node", "point", "fine", "n"), may_link, cell, "block")), "families")
    bodies = docs.select(F.col("row").alias("node"), F.col("text").cast("binary").alias("body"))
    sizes = nodes.select("node", F.col("n").alias("weight"))
    members = families.select(F.col("label").alias("group"), "node").join(sizes, "node")
    return components(links_within(members, bodies, linked, family_cell, "family", FAMILY_SHINGLES))


def with_rows(docs: DataFrame) -> DataFrame:
    """A written copy of ``docs`` as (row, source_row), each row with a number."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("source_row"))
    return staged(numbered, "numbered")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all columns unchanged."""
    numbered = with_rows(docs)
    texts = numbered.select("row", "source_row.doc_id", "source_row.text")
    kept = near_duplicates(texts).where("kept").select("row")
    return numbered.join(kept, "row", "left_semi").select("source_row.*")
