"""Benchmark decontamination with suffix arrays over the training text.

Each task turns its documents into shards of word numbers, sorts the suffixes of a shard and
binary-searches every benchmark suffix in it. That gives the places of each benchmark window, and at
each of these places the longest verbatim match. No document is shuffled, and one is always in one
shard.

Words are numbered by the benchmark's own vocabulary, an exact dictionary; a word that is not in it
gets 0 and ends a match. Suffixes that meet such a word before the shortest window is complete
cannot hold one and are left out of the array.

The benchmark is the stated query set: it is read in blocks of at most ``BLOCK_BYTES`` of text, and
each block is sent to the tasks whole, so what is broadcast has a fixed bound. With more than one
block, the state between blocks is written to the shared folder.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
#: Text of the benchmark that one pass takes.
BLOCK_BYTES = 16 << 20
#: Words after which a shard is full.
SHARD_WORDS = 1_000_000

# Bytes of words: digits, letters (A-Z as a-z) and all of non-ASCII; every other byte is a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.IntegerType()),
        T.StructField("longest_item", T.StringType()),
        T.StructField("longest_at", T.IntegerType()),
    ]
)
_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hit_spans", pa.list_(pa.list_(pa.int32()))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int32()),
        ("longest_item", pa.string()),
        ("longest_at", pa.int32()),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class Benchmark:
    """The benchmark's words as numbers, and all its suffixes."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        split = [(name, words_of(text)) for name, text in items]
        split = [(name or "", words) for name, words in split if words]
        self.names = [name for name, _ in split]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        self.words = np.array(
            [n for _, ws in split for n in (*(number.setdefault(w, len(number) + 1) for w in ws), 0)]
            + [0],
            np.int64,
        )
        sizes = np.array([len(ws) for _, ws in split], np.int64)
        self.item = np.repeat(np.arange(len(split)), sizes)
        begin = np.cumsum(sizes + 1) - sizes - 1
        inside = np.arange(len(self.item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        #: Place, words to the item's end and window size of each suffix; 0 where no window starts.
        self.place = np.repeat(begin, sizes) + inside
        self.left = np.repeat(sizes, sizes) - inside
        need = np.repeat(np.minimum(sizes, window), sizes)
        self.window = np.where(self.left >= need, need, 0)
        #: Rank of each suffix's item among the names in string order.
        self.ranked = sorted(set(self.names))
        rank = {name: i for i, name in enumerate(self.ranked)}
        self.rank = np.repeat(np.array([rank[name] for name in self.names], np.int64), sizes)
        self.shortest = int(need.min()) if len(need) else 0
        self.deepest = int(sizes.max()) if len(sizes) else 0


def packed(words: np.ndarray, runs: np.ndarray, bits: int) -> np.ndarray:
    """The next few words from each place in one integer, as many as 63 bits hold."""
    per = 63 // bits
    padded = np.concatenate([words, np.zeros(per, words.dtype)])
    key = np.zeros(len(words), np.int64)
    for j in range(per):
        key = (key << bits) | np.where(runs > j, padded[j : j + len(words)], 0)
    return key


def suffix_array(words: np.ndarray, least: int, deepest: int, bits: int) -> np.ndarray:
    """Places that start at least ``least`` known words, sorted by what follows.

    The order looks ``deepest`` words far, which is all a query of that length can tell apart.
    Groups of equal keys are refined by the key a few words on, like an MSD radix sort.
    """
    n = len(words)
    stops = np.flatnonzero(np.append(words, 0) == 0)
    runs = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
    key = np.append(packed(words, runs, bits), 0)
    order = np.flatnonzero(runs >= max(least, 1))
    order = order[np.argsort(key[order], kind="stable")]
    # A group is named by the place of its first member in the array.
    fresh = np.append(True, key[order][1:] != key[order][:-1])[: len(order)]
    group = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    ended = np.zeros(len(order), bool)
    per = 63 // bits
    for depth in range(per, deepest, per):
        same = np.zeros(len(order), bool)
        same[1:] = group[1:] == group[:-1]
        same[:-1] |= same[1:]
        todo = np.flatnonzero(same & ~ended)
        if not len(todo):
            break
        nxt = key[np.minimum(order[todo] + depth, n)]
        # Past the end of a run of known words there is nothing to compare.
        nxt[runs[order[todo]] <= depth] = 0
        turn = np.lexsort((nxt, group[todo]))
        order[todo], nxt = order[todo][turn], nxt[turn]
        fresh = np.append(True, (group[todo][1:] != group[todo][:-1]) | (nxt[1:] != nxt[:-1]))
        group[todo] = todo[fresh][np.cumsum(fresh) - 1]
        ended[todo[nxt == 0]] = True
    return order


def _bound(sa, words, depth, target, low, high, right):
    """First place in [low, high) whose word at ``depth`` is not below (right: above) the target."""
    low, high = low.copy(), high.copy()
    last = len(words) - 1
    while True:
        active = low < high
        if not active.any():
            return low
        middle = (low + high) >> 1
        at = words[np.minimum(sa[np.minimum(middle, len(sa) - 1)] + depth, last)]
        up = active & ((at <= target) if right else (at < target))
        low = np.where(up, middle + 1, low)
        high = np.where(active & ~up, middle, high)


def search(bench: Benchmark, words: np.ndarray, sa: np.ndarray):
    """Binary search of every benchmark suffix, word by word.

    Returns for each suffix the range of the array that starts with its window (empty where the
    window does not occur), and the ranges in which a suffix, its window complete, goes no further
    with all places: low, high, depth in words, rank of the item. A range of the same places may
    come at several depths; for each depth it has the lowest rank.
    """
    q = len(bench.place)
    window_low, window_high = np.zeros(q, np.int64), np.zeros(q, np.int64)
    alive = np.arange(q)
    low, high = np.zeros(q, np.int64), np.full(q, len(sa), np.int64)
    left = [np.zeros((4, 0), np.int64)]
    depth = 0
    while len(alive) and len(sa):
        fits = bench.left[alive] > depth
        target = bench.words[bench.place[alive] + depth]
        new_low = _bound(sa, words, depth, target, low, np.where(fits, high, low), False)
        new_high = _bound(sa, words, depth, target, new_low, np.where(fits, high, new_low), True)
        found = new_low < new_high
        window = bench.window[alive]
        leaves = (window > 0) & (window <= depth) & (new_high - new_low < high - low)
        if leaves.any():
            # Ranges of one depth are equal or apart, so the lower end names them.
            ends = np.stack([low[leaves], high[leaves], bench.rank[alive[leaves]]])
            ends = ends[:, np.lexsort((ends[2], ends[0]))]
            ends = ends[:, np.append(True, ends[0][1:] != ends[0][:-1])]
            left.append(np.insert(ends, 2, depth, axis=0))
        alive, low, high = alive[found], new_low[found], new_high[found]
        depth += 1
        whole = bench.window[alive] == depth
        window_low[alive[whole]], window_high[alive[whole]] = low[whole], high[whole]
    return window_low, window_high, np.concatenate(left, axis=1)


def innermost(low: np.ndarray, high: np.ndarray, depth: np.ndarray):
    """Cuts nested ranges into pieces, each with the number of the deepest range that covers it.

    Two ranges are apart or one holds the other, and then the inner one is deeper.
    """
    pieces: list[tuple[int, int, int]] = []
    around: list[int] = []
    at = 0
    ends = high.tolist()
    order = np.lexsort((depth, -high, low))
    for n, begin in zip(order.tolist(), low[order].tolist()):
        while around and ends[around[-1]] <= begin:
            inner = around.pop()
            pieces.append((at, ends[inner], inner))
            at = ends[inner]
        if around:
            pieces.append((at, begin, around[-1]))
        at = begin
        around.append(n)
    while around:
        inner = around.pop()
        pieces.append((at, ends[inner], inner))
        at = ends[inner]
    begin, end, number = np.array(pieces, np.int64).reshape(-1, 3).T
    # A range over the same places as a deeper one is left without a piece.
    some = begin < end
    return begin[some], end[some], number[some]


def _expanded(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, and which range each is from."""
    sizes = end - begin
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[owner], owner


def match_shard(bench: Benchmark, words: np.ndarray, starts: np.ndarray) -> list[dict | None]:
    """What the benchmark hits in each document of a shard; ``starts`` has one entry more."""
    docs = len(starts) - 1
    out: list[dict | None] = [None] * docs
    bits = max(1, len(bench.vocabulary).bit_length())
    sa = suffix_array(words, bench.shortest, bench.deepest, bits)
    low, high, left = search(bench, words, sa)
    hit_by = np.flatnonzero(high > low)
    if not len(hit_by):
        return out
    # Equal windows have the same range; each range is expanded once.
    ranges, which = np.unique(
        np.stack([low[hit_by], high[hit_by], bench.window[hit_by]]), axis=1, return_inverse=True
    )
    which = which.reshape(-1)
    names: list[set[str]] = [set() for _ in range(ranges.shape[1])]
    for r, s in zip(which, hit_by):
        names[r].add(bench.names[bench.item[s]])
    places, owner = _expanded(ranges[0], ranges[1])
    places = sa[places]
    edge = np.bincount(places, minlength=len(words) + 1) - np.bincount(
        places + ranges[2][owner], minlength=len(words) + 1
    )
    hit = np.cumsum(edge)[:-1] > 0
    doc = np.searchsorted(starts, places, side="right") - 1
    pairs = np.unique(np.stack([doc, owner]), axis=1)
    step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    span_from, span_to = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    span_doc = np.searchsorted(starts, span_from, side="right") - 1
    for d in np.unique(pairs[0]):
        out[d] = {"items": set(), "hit_spans": [], "longest": 0, "longest_item": None, "longest_at": None}
    for d, r in pairs.T:
        out[d]["items"] |= names[r]
    for d, a, b in zip(span_doc, span_from, span_to):
        out[d]["hit_spans"].append([int(a - starts[d]), int(b - starts[d])])
    # Every place of an occurring window, with its longest match; the best one of each document.
    begin, end, number = innermost(left[0], left[1], left[2])
    places, owner = _expanded(begin, end)
    places, depth, rank = sa[places], left[2][number[owner]], left[3][number[owner]]
    doc = np.searchsorted(starts, places, side="right") - 1
    best = np.lexsort((places, -depth, doc))
    best = best[np.append(True, doc[best][1:] != doc[best][:-1])]
    for d, p, n, r in zip(doc[best], places[best], depth[best], rank[best]):
        out[d] |= {"longest": int(n), "longest_item": bench.ranked[r], "longest_at": int(p - starts[d])}
    return out


def _merged(old: dict | None, new: dict | None, n_words: int) -> dict:
    """One document's hits with those of a further block of the benchmark."""
    out = old or {"items": [], "hit_spans": [], "longest": 0, "longest_item": None, "longest_at": None}
    if new:
        spans: list[list[int]] = []
        for a, b in sorted([*out["hit_spans"], *new["hit_spans"]]):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        best = min(
            (h for h in (out, new) if h["longest"]),
            key=lambda h: (-h["longest"], h["longest_at"], h["longest_item"]),
        )
        out = {k: best[k] for k in ("longest", "longest_item", "longest_at")} | {
            "items": sorted({*out["items"], *new["items"]}),
            "hit_spans": spans,
        }
    return out | {"n_words": n_words}


def _scan(shared, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench: Benchmark = shared.value
        known = bench.vocabulary.get
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows, numbers, total = 0, [], 0
            for i in range(batch.num_rows):
                words = words_of(texts[i].as_py())
                numbers.append(np.fromiter((known(w, 0) for w in words), np.int64, len(words)))
                total += len(words)
                if total >= shard_words or i == batch.num_rows - 1:
                    yield _shard(bench, batch.slice(rows, i + 1 - rows), numbers)
                    rows, numbers, total = i + 1, [], 0

    return run


def _shard(bench: Benchmark, batch: pa.RecordBatch, numbers: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in numbers], np.int64)
    # A 0 after each document, so that no match crosses into the next.
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.zeros(int(starts[-1]), np.int64)
    for at, x in zip(starts, numbers):
        words[at : at + len(x)] = x
    found = match_shard(bench, words, starts)
    before = batch.column("hits").to_pylist()
    hits = [_merged(a, b, int(n)) for a, b, n in zip(before, found, sizes)]
    at = batch.schema.get_field_index("hits")
    return batch.set_column(at, pa.field("hits", _HITS), pa.array(hits, _HITS))


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Benchmark]:
    """The benchmark's distinct items in blocks of about ``block_bytes``; the driver holds one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("binary").alias("body"))
    # Copies of an item hash alike, so they would all be in one block.
    items = items.distinct()
    total = items.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    blocks = total // block_bytes + 1
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == b)
        yield Benchmark([(r[0], bytes(r[1]) if r[1] else None) for r in part.toLocalIterator()], window)


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` (doc_id, text, ...) as the struct ``source_row``, with ``hits``.

    ``hits`` holds n_words, the word spans covered by occurring windows, the items they belong to
    (sorted as strings), and the longest verbatim match with its item and word position: of equally
    long ones the first in the text, and of its items the first as a string. A null or empty text has no
    words and no hits; an item without words is no item; a null item_id is named by the empty string;
    repeated items count once. Repeated documents are matched each and alike; a shard ends
    after a whole text, so texts of any length are matched whole; columns of any name stay in the
    struct.
    Empty tables give no hits or no rows.
    """
    spark = docs.sparkSession
    state = docs.select(
        F.struct("*").alias("source_row"), F.col("text"), F.lit(None).cast(HITS).alias("hits")
    )
    for number, bench in enumerate(benchmark_blocks(benchmark, window, block_bytes)):
        if number:
            state = staged(state, "hits")
        shared = spark.sparkContext.broadcast(bench)
        state = state.mapInArrow(_scan(shared, shard_words), state.schema)
    return state.drop("text")


def contamination(state: DataFrame) -> DataFrame:
    """``matched`` rows with n_words, n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate("hits.hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return (
        state.withColumn("n_words", F.col("hits.n_words"))
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("hits.items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "hits.items").cast("binary"), 256))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which less than a twentieth of the words is benchmark text."""
    kept = contamination(matched(docs, benchmark)).where("NOT contaminated")
    return kept.select("source_row.*")
