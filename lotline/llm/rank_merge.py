"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch that have not been counted yet are held together as one ragged
numpy array of symbols. Every round looks up the rank of all neighbouring pairs at once, finds the
lowest rank of each sequence, and merges that pair wherever it occurs in the sequence, left to
right, in all sequences at the same time. A sequence without a ranked pair leaves; its surviving
symbols are its token count. Counts of pieces are kept in bounded dictionaries of the worker.

Merging all occurrences of a sequence's lowest pair in one round is the same as merging them one
by one when no merge can create a pair of lower rank than its own; the rank table is checked for
that when it is loaded.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import worker_store
from lotline.llm.units import LETTERS, PRE_TOKENS, RUNS, Uneven, check_even

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 512
#: Entries of a dictionary of counts; a full one starts anew.
MEMO_ENTRIES = 400_000
#: Bytes of pre-tokens that are merged together.
ROUND_BYTES = 1 << 20
NONE = np.iinfo(np.int32).max


class MergeTable:
    """Ranked merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.start = np.array([vocabulary[LETTERS[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        born = np.full(max(vocabulary.values()) + 1, -1, np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        if len(pairs) and (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge precedes the merges that make its parts")
        self.factor = np.int64(len(born))
        keys = left * self.factor + right
        order = np.argsort(keys)
        # A last key that no pair has, so that every search ends inside the array.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, NONE).astype(np.int32)
        self.made = np.append(made, 0).astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.factor + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merged_counts(pieces: list[bytes], table: MergeTable) -> np.ndarray:
    """Number of symbols of each piece after all merges."""
    counts = np.zeros(len(pieces), np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    symbols = table.start[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), sizes)
    ranks = _pair_ranks(table, symbols, owner)
    while len(symbols):
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(ranks, begin)
        length = np.diff(np.append(begin, len(symbols)))
        over = lowest == NONE
        counts[owner[begin[over]]] = length[over]
        hit = (ranks == np.repeat(lowest, length)) & (ranks != NONE)
        # In a row of touching hits (aaaa) every second one merges.
        place = np.arange(len(symbols))
        before = np.maximum.accumulate(np.where(hit, -1, place))
        hit &= (place - before) % 2 == 1
        symbols[hit] = table.made[ranks[hit]]
        stay = ~np.append(False, hit[:-1]) & ~np.repeat(over, length)
        touched = hit | np.append(hit[1:], False)
        symbols, owner, ranks, touched = symbols[stay], owner[stay], ranks[stay], touched[stay]
        again = np.flatnonzero(touched)
        if len(again):
            nxt = np.minimum(again + 1, len(symbols) - 1)
            fresh = table.rank(symbols[again], symbols[nxt])
            ranks[again] = np.where((nxt > again) & (owner[nxt] == owner[again]), fresh, NONE)
    return counts


def _pair_ranks(table: MergeTable, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Rank of each symbol with its right neighbour in the same piece."""
    ranks = np.full(len(symbols), NONE, np.int32)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    ranks[inner] = table.rank(symbols[inner], symbols[inner + 1])
    return ranks


class Counter:
    """Token counts of texts; what is unknown is gathered and merged together."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.tokens: dict[str, int] = {}
        #: Counts of runs as they stand, and of pieces with a blank before them.
        self.runs: dict[str, int] = {}
        self.after_blank: dict[str, int] = {}

    def _segments(self, text: str) -> list[str]:
        segments = [text]
        for special in self.table.special:
            segments = [part for s in segments for part in s.split(special)]
        return segments

    def _merge(self, tokens: Iterable[str]) -> None:
        waiting, size = [], 0
        for token in tokens:
            waiting.append(token)
            size += len(token)
            if size >= ROUND_BYTES:
                self._merge_now(waiting)
                waiting, size = [], 0
        self._merge_now(waiting)

    def _merge_now(self, tokens: list[str]) -> None:
        if tokens:
            counts = merged_counts([t.encode() for t in tokens], self.table)
            self.tokens.update(zip(tokens, counts.tolist()))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Special strings inside a text count as one token each."""
        even: list[tuple[str, list[str]] | None] = []
        runs: list[list[str]] = []
        specials, owners = [0] * len(texts), []
        for i, text in enumerate(texts):
            segments = self._segments(text)
            specials[i] = len(segments) - 1
            for segment in segments:
                if segment:
                    owners.append(i)
                    first, *rest = segment.split(" ")
                    even.append((first, rest))
                    runs.append([segment])
        # Pieces seen for the first time, and the pre-tokens in them.
        fresh_after = set().union(*(rest for _, rest in even)) - self.after_blank.keys() if even else set()
        uneven = set()
        for piece in fresh_after:
            try:
                check_even(piece)
            except Uneven:
                uneven.add(piece)
        plain: list[list[str]] = []
        for i, (first, rest) in enumerate(even):
            suits = first and not (uneven and not uneven.isdisjoint(rest))
            try:
                check_even(first)
            except Uneven:
                suits = False
            plain.append([first] if suits else RUNS.findall(runs[i][0]))
            if not suits:
                even[i] = None
        fresh_after -= uneven
        fresh_runs = set().union(*plain) - self.runs.keys() if plain else set()
        split_after = {p: PRE_TOKENS.findall(" " + p) for p in fresh_after}
        split_runs = {r: PRE_TOKENS.findall(r) for r in fresh_runs}
        wanted = set()
        for parts in (split_after, split_runs):
            for tokens in parts.values():
                wanted.update(tokens)
        self._merge(wanted - self.tokens.keys())
        get = self.tokens.__getitem__
        self.after_blank.update((p, sum(map(get, t))) for p, t in split_after.items())
        self.runs.update((r, sum(map(get, t))) for r, t in split_runs.items())
        out = specials
        after, alone = self.after_blank.__getitem__, self.runs.__getitem__
        for owner, pair, own in zip(owners, even, plain):
            out[owner] += sum(map(alone, own)) + (sum(map(after, pair[1])) if pair else 0)
        for memo in (self.tokens, self.runs, self.after_blank):
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
        return out


def counter(path: str) -> Counter:
    known = worker_store("rank_merge")
    return known.get(path) or known.setdefault(path, Counter(path))


def _count(path: str, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts, sizes, n_tokens, at, size = batch.column("text"), [], [], 0, 0
            for i in range(batch.num_rows):
                sizes.append(0 if not texts[i].is_valid else texts[i].as_buffer().size)
                size += sizes[-1]
                if size >= batch_bytes or i == batch.num_rows - 1:
                    n_tokens += count.counts([t or "" for t in texts.slice(at, i + 1 - at).to_pylist()])
                    at, size = i + 1, 0
            rest = batch.drop_columns("text")
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(sizes, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[*rest.schema.names, "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, batch_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` (doc_id, text) with n_bytes, n_tokens and over_limit, one row per row.

    ``path`` is a byte-level BPE file. Null counts as empty: 0 bytes and 0 tokens. Every text is
    counted whole; repeated rows are counted each; other columns are left out, whatever their names.
    An empty table gives an empty result.
    """
    counted = docs.select("doc_id", "text").mapInArrow(
        _count(path, batch_bytes), "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
