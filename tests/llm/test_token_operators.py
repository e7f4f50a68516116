"""Token counts, token files and packing against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotline.llm import huffman as H, packing as P, rank_merge as M, units as U
from lotline.llm.queries import BYTE_BPE, BYTE_BPE_IDS, WORD_BPE, vocabulary


def library(name):
    return Tokenizer.from_file(vocabulary(name))


def plain_ids(name, text):
    return library(name).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name, kind", [(BYTE_BPE, U.ByteEncoder), (WORD_BPE, U.WordEncoder)])
def test_encoders_give_the_librarys_ids(hard_texts, name, kind):
    rng = random.Random(1)
    parts = ["a", "B", "é", " ", "  ", "\n", "'s", "23", "²", "_", "!", "<|endoftext|>", "\x1c", "\x85", " ", "漢", "é", "Σ"]
    texts = [t for t in hard_texts if t] + ["".join(rng.choice(parts) for _ in range(12)) for _ in range(1500)]
    encoder, tokenizer = kind(vocabulary(name)), library(name)
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]


def test_memo_is_bounded():
    memo = U.Memo(str, 10)
    assert [memo[i] for i in [*range(40), 1]] == [str(i) for i in [*range(40), 1]]
    assert len(memo) + len(memo.old) <= 11


def test_token_counts(docs, no_docs):
    found = M.token_counts(docs.withColumn("n_tokens", F.lit("clash")), vocabulary(BYTE_BPE), batch_bytes=500)
    tokenizer = library(BYTE_BPE)
    wanted = []
    for r in docs.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        wanted.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    key = lambda r: (r[0] is not None, *map(lambda v: v or 0, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(wanted, key=key)
    assert M.token_counts(no_docs, vocabulary(BYTE_BPE)).collect() == []


def test_touching_pairs_merge_left_to_right():
    table = M.MergeTable(vocabulary(BYTE_BPE))
    tokenizer = library(BYTE_BPE)
    pieces = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 9)] + ["====" * 9, "ééé"]
    wanted = [len(tokenizer.encode(p, add_special_tokens=False).ids) for p in pieces]
    assert M.merged_counts([p.encode() for p in pieces], table).tolist() == wanted


# --- Huffman files -------------------------------------------------------------------------------


@pytest.mark.parametrize("counts", [[3], [0, 5], [1, 1], [1, 1, 1], list(2 ** np.arange(25)), [0] * 4])
def test_codes(counts):
    counts = np.array(counts)
    lengths = H.code_lengths(counts, 12)
    assert lengths.max(initial=0) <= 12 and (lengths > 0).tolist() == (counts > 0).tolist()
    if counts.any():
        assert sum(2.0 ** -int(n) for n in lengths[lengths > 0]) <= 1
        ids = np.tile(np.flatnonzero(counts), 700)
        bits, at = H.to_bits(ids, H.canonical_codes(lengths), lengths)
        assert (H.Decoder(lengths).decode(bits, at[::64], len(ids), 64) == ids).all()


def test_lengths_are_optimal_without_a_limit():
    counts = np.array([45, 13, 12, 16, 9, 5])
    assert (H.code_lengths(counts) * counts).sum() == 224
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(9, int), 3)


def test_huffman_round_trip(docs, no_docs):
    found = H.round_trip(docs, vocabulary(BYTE_BPE), BYTE_BPE_IDS).orderBy("start").collect()
    tokenizer = library(BYTE_BPE)
    wanted = defaultdict(list)
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        wanted[r.doc_id].append((len(ids), crc(ids)))
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
        wanted[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(wanted.values())
    assert H.round_trip(no_docs, vocabulary(BYTE_BPE), BYTE_BPE_IDS).collect() == []


def test_ids_are_counted_as_they_are_made(docs, no_docs, monkeypatch):
    """The tasks' own counts are those of a second look at all ids, however many documents count together."""
    path = vocabulary(BYTE_BPE)
    wanted = H.id_counts(H.tokenized(docs, path), BYTE_BPE_IDS)
    for together in (3, 1000):
        monkeypatch.setattr(H, "COUNTED_ROWS", together)
        both = H.tokenized_and_counted(docs, path, BYTE_BPE_IDS)
        assert both.where("counts IS NULL").count() == docs.count()
        assert (H.id_counts(both, BYTE_BPE_IDS) == wanted).all()
    assert not H.id_counts(H.tokenized_and_counted(no_docs, path, BYTE_BPE_IDS), BYTE_BPE_IDS).any()


def test_files_roll_over_and_broken_ones_fail(spark, docs, tmp_path):
    tokens = H.tokenized(docs.where("doc_id IS NOT NULL"), vocabulary(BYTE_BPE)).coalesce(1)
    lengths = H.code_lengths(H.id_counts(tokens, BYTE_BPE_IDS))
    manifest = H.write_ids(tokens, str(tmp_path), lengths, file_ids=1500)
    assert manifest.count() > 3
    rows = H.read_ids(manifest, with_ids=True).collect()
    assert len(rows) == docs.where("doc_id IS NOT NULL").count()
    assert all(crc(r.ids) == r.ids_crc32 and r.ids[-1] == 2 for r in rows)
    path = manifest.first().path
    data = open(path, "rb").read()
    for broken in (data[:-1], b"x" + data[1:]):
        open(path, "wb").write(broken)
        with pytest.raises(ValueError):
            H.read_file(path)


# --- packing -------------------------------------------------------------------------------------


def test_best_fit_takes_the_fullest_bin_that_fits():
    bins = P.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # exactly full, so it closes
    assert bins.place(3) == (0, 6) and bins.place(2) == (2, 0)
    assert bins.place(9) == (3, 0)  # bin 0 (free 1) was the fullest and closed
    assert bins.place(1) == (3, 9) and bins.place(1) == (2, 2)
    assert bins.place(10) == (4, 0)


@pytest.mark.parametrize("again", [100_000, 40])
def test_bins_of_many_small_partitions_are_joined(docs, monkeypatch, again):
    capacity = 64
    few = P.packed_pieces(docs.coalesce(1), vocabulary(WORD_BPE), capacity).collect()
    monkeypatch.setattr(P, "AGAIN_PIECES", again)
    many = P.packed_pieces(docs.repartition(60), vocabulary(WORD_BPE), capacity).collect()
    assert Counter(tuple(p)[:5] for p in few) == Counter(tuple(p)[:5] for p in many)
    sequences = defaultdict(list)
    for p in many:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        ends = [at + length for at, length in sorted(parts)]
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    least = -(-sum(p.length for p in many) // capacity)
    assert len(sequences) <= 1.03 * least + 1 + len(many) // again


@pytest.mark.parametrize("most", [1, 7])
def test_no_pass_has_more_open_bins(most, monkeypatch):
    """A bin is open until no later piece can go there; ``OpenBins`` never holds more than ``most``."""
    rng = random.Random(3)
    lengths = [rng.randrange(1, 65) for _ in range(400)]
    bins = P.OpenBins(64, most)
    for length in lengths:
        bins.place(length)
        assert bins.open <= most and bins.open == sum(map(len, bins.by_free))
    task = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(P, "TaskContext", task)
    rows = [(i, 0, 0, n, 0, i, 0) for i, n in enumerate(lengths)]
    out = list(P._pack_again(64, most)(iter([P._batch(rows, P._PIECES)])))
    opened = out[0].column("sequence_id").to_pylist()
    full, last = Counter(), {b: at for at, b in enumerate(opened)}
    for bin_, n in zip(opened, lengths):
        full[bin_] += n
    for at in range(len(opened)):
        assert len({b for b in opened[: at + 1] if last[b] > at}) <= most
    assert max(full.values()) <= 64


def test_packing_leaves_clashing_columns_out(docs):
    extra = docs.selectExpr("doc_id", "text", "1 AS piece", "'x' AS open", "2 AS sequence_id", "3 AS length")
    plain = P.packed_pieces(docs, vocabulary(WORD_BPE), 64).collect()
    found = P.packed_pieces(extra, vocabulary(WORD_BPE), 64).collect()
    assert Counter(tuple(p)[:5] for p in found) == Counter(tuple(p)[:5] for p in plain)


@pytest.mark.parametrize("most", [1, 3, 1024])
def test_packing(docs, no_docs, most):
    capacity = 64
    pieces = P.packed_pieces(docs, vocabulary(WORD_BPE), capacity, most=most).collect()
    wanted = defaultdict(int)
    tokenizer = library(WORD_BPE)
    total = 0
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for n, at in enumerate(range(0, len(ids), capacity)):
            wanted[(r.doc_id, n, at, len(ids[at : at + capacity]), crc(ids[at : at + capacity]))] += 1
    for p in pieces:
        wanted[tuple(p)[:5]] -= 1
    assert not any(wanted.values())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= (1.6 if most == 1 else 1.25) * total / capacity + 3
    assert P.packed_pieces(no_docs, vocabulary(WORD_BPE)).collect() == []
