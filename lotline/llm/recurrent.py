"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into segments of ``SEGMENT`` bytes. One network reads each segment forwards, another
backwards; the two states at a byte give that byte's language probabilities, and a text's are the
mean over all its bytes. The gates use x / (1 + |x|) as their curve, scaled to (0, 1) where needed:
the shape of a sigmoid at a fraction of its cost.

The network is trained in numpy by backpropagation through time, on one window of text from each
of at most about ``TRAIN_DOCS`` documents. Prediction runs in the tasks that scan the texts, many
segments side by side, and reads every byte.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import crc_of_id, drawn

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: About how many documents the network is trained on; fewer where the table has fewer.
TRAIN_DOCS = 4_000
TRAIN_CHARS = 256
#: A language has at least one in so many of the documents that equal shares would give it.
RARE_PART = 4
HIDDEN = 8
SEGMENT = 128
#: Segments that are read side by side.
ABREAST = 2048
STEPS, BATCH, RATE = 300, 96, 0.03
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"


def curve(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Cell:
    """Gated recurrent unit over byte numbers; arrays are (features, batch).

    ``inputs`` has a column for each byte, so reading a byte is a look-up. Rows are the update
    gate, the reset gate and the candidate.
    """

    def __init__(self, inputs: np.ndarray, hidden: np.ndarray):
        self.inputs, self.hidden = inputs, hidden

    def states(self, bytes_: np.ndarray, valid: np.ndarray | None, backwards: bool) -> np.ndarray:
        """The state after each step, as (steps, hidden, batch); invalid steps leave it at zero."""
        steps, batch = bytes_.shape
        h = self.hidden.shape[1]
        out = np.empty((steps, h, batch), np.float32)
        state = np.zeros((h, batch), np.float32)
        seen, mixed = np.empty((3 * h, batch), np.float32), np.empty((3 * h, batch), np.float32)
        bend = np.empty((2 * h, batch), np.float32)
        for t in range(steps - 1, -1, -1) if backwards else range(steps):
            np.take(self.inputs, bytes_[t], axis=1, out=seen, mode="clip")
            np.matmul(self.hidden, state, out=mixed)
            gates = seen[: 2 * h]
            gates += mixed[: 2 * h]
            np.abs(gates, out=bend)
            bend += 1
            gates /= bend
            gates += 1
            gates *= 0.5
            new = mixed[2 * h :]
            new *= gates[h:]
            new += seen[2 * h :]
            np.abs(new, out=bend[:h])
            bend[:h] += 1
            new /= bend[:h]
            # state = z * state + (1 - z) * new
            state -= new
            state *= gates[:h]
            state += new
            if valid is not None:
                state *= valid[t]
            out[t] = state
        return out

    def learn(self, bytes_: np.ndarray, backwards: bool, valid: np.ndarray | None = None):
        """As ``states``, with what ``backpropagate`` needs."""
        steps, batch = bytes_.shape
        h = self.hidden.shape[1]
        state = np.zeros((h, batch), np.float32)
        trace = []
        order = range(steps - 1, -1, -1) if backwards else range(steps)
        out = np.empty((steps, h, batch), np.float32)
        for t in order:
            seen, mixed = self.inputs[:, bytes_[t]], self.hidden @ state
            raw = seen[: 2 * h] + mixed[: 2 * h]
            gates = 0.5 * (1 + curve(raw))
            raw_new = gates[h:] * mixed[2 * h :] + seen[2 * h :]
            new = curve(raw_new)
            trace.append((t, state, raw, gates, mixed[2 * h :], raw_new, new))
            state = gates[:h] * state + (1 - gates[:h]) * new
            if valid is not None:
                state = state * valid[t]
            out[t] = state
        return out, trace

    def backpropagate(
        self, bytes_: np.ndarray, trace: list, slopes: np.ndarray, valid: np.ndarray | None = None
    ):
        """Slopes of ``inputs`` and ``hidden`` from those of the states, back through time."""
        h = self.hidden.shape[1]
        d_inputs, d_hidden = np.zeros_like(self.inputs), np.zeros_like(self.hidden)
        d_state = np.zeros_like(slopes[0])
        for t, state, raw, gates, mixed, raw_new, new in reversed(trace):
            d_state = d_state + slopes[t]
            if valid is not None:
                d_state = d_state * valid[t]
            update, reset = gates[:h], gates[h:]
            d_new = d_state * (1 - update) / (1 + np.abs(raw_new)) ** 2
            d_raw = np.concatenate([d_state * (state - new), d_new * mixed])
            d_raw *= 0.5 / (1 + np.abs(raw)) ** 2
            d_mixed = np.concatenate([d_raw, d_new * reset])
            d_seen = np.concatenate([d_raw, d_new])
            np.add.at(d_inputs.T, bytes_[t], d_seen.T)
            d_hidden += d_mixed @ state.T
            d_state = d_state * update + self.hidden.T @ d_mixed
        return d_inputs, d_hidden


@dataclass
class Network:
    languages: list[str]
    forward: Cell
    backward: Cell
    #: (languages, 2 * hidden) and (languages, 1).
    out: np.ndarray
    bias: np.ndarray

    def byte_probabilities(self, bytes_: np.ndarray, valid: np.ndarray | None) -> np.ndarray:
        """(steps, languages, batch) probabilities of every byte."""
        h = self.out.shape[1] // 2
        logits = np.matmul(self.out[:, :h], self.forward.states(bytes_, valid, False))
        logits += np.matmul(self.out[:, h:], self.backward.states(bytes_, valid, True))
        return _softmax(logits, self.bias)


def _softmax(logits: np.ndarray, bias: np.ndarray) -> np.ndarray:
    logits += bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def fit(windows: list[bytes], labels: list[str], seed: int = 11) -> Network:
    """Train on segments of ``windows``: each byte's language is that of its document.

    ``STEPS`` batches of Adam, however many windows there are. A window shorter than a training
    segment is padded and the padding masked; every window of a batch counts alike.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    spread = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    cells = [Cell(spread(3 * HIDDEN, 256), spread(3 * HIDDEN, HIDDEN)) for _ in range(2)]
    net = Network(languages, *cells, spread(len(languages), 2 * HIDDEN), np.zeros((len(languages), 1), np.float32))
    if len(languages) < 2:
        return net
    number = {name: i for i, name in enumerate(languages)}
    steps = SEGMENT // 2
    kept = [(w, number[name]) for w, name in zip(windows, labels) if w]
    if not kept:
        return net
    values = [cells[0].inputs, cells[0].hidden, cells[1].inputs, cells[1].hidden, net.out, net.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        picked = rng.integers(0, len(kept), BATCH)
        begin = [rng.integers(0, max(0, len(kept[p][0]) - steps) + 1) for p in picked]
        parts = [kept[p][0][b : b + steps] for p, b in zip(picked, begin)]
        length = np.array([len(part) for part in parts])
        bytes_ = np.stack(
            [np.frombuffer(part.ljust(steps, b"\0"), np.uint8) for part in parts], axis=1
        ).astype(np.int64)
        full = length.min() == steps
        valid = None if full else (np.arange(steps)[:, None] < length).astype(np.float32)
        truth = np.array([kept[p][1] for p in picked])
        ahead, ahead_trace = cells[0].learn(bytes_, False, valid)
        back, back_trace = cells[1].learn(bytes_, True, valid)
        both = np.concatenate([ahead, back], axis=1)
        wrong = _softmax(np.matmul(net.out, both), net.bias)
        wrong[:, truth, np.arange(BATCH)] -= 1
        wrong /= (length * BATCH).astype(np.float32)
        if valid is not None:
            wrong *= valid[:, None, :]
        d_both = np.matmul(net.out.T, wrong)
        slopes = [
            *cells[0].backpropagate(bytes_, ahead_trace, d_both[:, :HIDDEN], valid),
            *cells[1].backpropagate(bytes_, back_trace, d_both[:, HIDDEN:], valid),
            np.einsum("tlb,thb->lh", wrong, both),
            wrong.sum(axis=(0, 2))[:, None],
        ]
        size = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        rate = RATE * (1 - (step - 1) / STEPS) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for v, a, b, s in zip(values, first, second, slopes):
            s = s * min(1, 1 / (size + 1e-9))
            a += 0.1 * (s - a)
            b += 0.01 * (s**2 - b)
            v -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return net


class Pool:
    """Adds up byte probabilities by document, for many documents at a time."""

    def __init__(self, net: Network, abreast: int = ABREAST):
        self.net, self.abreast = net, abreast

    def means(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): each text's mean over all its bytes; zero for an empty one."""
        sizes = np.array([len(t) for t in texts], np.int64)
        whole = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum(sizes) - sizes
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        rank = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + rank * SEGMENT
        length = np.minimum(SEGMENT, sizes[owner] - rank * SEGMENT)
        total = np.zeros((len(texts), len(self.net.languages)))
        # Full segments first, then the shorter ones by length, so few steps need a mask.
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), self.abreast):
            now = order[at : at + self.abreast]
            steps = np.arange(int(length[now].max()))[:, None]
            full = length[now].min() == len(steps)
            place = np.minimum(begin[now] + steps, len(whole) - 1)
            valid = None if full else (steps < length[now]).astype(np.float32)
            by_byte = self.net.byte_probabilities(whole[place], valid)
            if valid is not None:
                by_byte *= valid[:, None, :]
            np.add.at(total, owner[now], by_byte.sum(axis=0).T)
        return total / np.maximum(1, sizes)[:, None]


# --- Spark ---------------------------------------------------------------------------------------


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Network:
    """Train on ``docs`` (doc_id, text, lang) outside the held-out fold, of known language.

    About ``rows`` of them, drawn by a hash of doc_id and per language: each has its share of the
    documents, but not less than a quarter of an equal part, so that a rare one is learned as well
    and there are never more than about 1.25 times ``rows``. Of each document one window of
    ``TRAIN_CHARS`` characters at a hashed place is taken; the driver holds no more than that. A
    doc_id with several rows counts once. Empty tables give a network without languages. Other
    columns are not looked at.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & (crc_of_id() % FOLDS != HELD_OUT)
    )
    # A row for each language, as the network has an output for each.
    counts = usable.groupBy("lang").agg(F.count_distinct("doc_id").alias("n"))
    total, langs = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    share = F.greatest(F.lit(rows / max(1, total or 0)), rows / (RARE_PART * langs * F.col("n")) if langs else F.lit(0.0))
    shares = counts.select("lang", F.least(F.lit(1.0), share).alias("share"))
    room = F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), room).cast("int") + 1
    sample = (
        usable.join(F.broadcast(shares), "lang")
        .where(drawn(F.col("share")))
        # One window of each doc_id, so that a repeated one cannot outgrow the sample.
        .groupBy("doc_id")
        .agg(F.max(F.struct(F.substring(F.col("text"), place, F.lit(TRAIN_CHARS)).alias("part"), "lang")).alias("row"))
        .select("row.*")
        .toPandas()
        .sort_values(["lang", "part"], kind="stable")
    )
    return fit([p.encode() for p in sample["part"]], sample["lang"].tolist())


def _label(shared, group_bytes: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network = shared.value
        pool = Pool(net)
        for batch in batches:
            texts, labels, scores = batch.column("text"), [], []
            waiting, size = [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                waiting.append(text.encode() if any(map(str.isalpha, text)) else b"")
                size += len(waiting[-1])
                if size >= group_bytes or i == batch.num_rows - 1:
                    if net.languages:
                        means = pool.means(waiting)
                        best = means.argmax(axis=1)
                        labels += [net.languages[b] if t else UNKNOWN for b, t in zip(best, waiting)]
                        scores += [float(min(1.0, m[b])) for m, b in zip(means, best)]
                    else:
                        labels += [UNKNOWN] * len(waiting)
                        scores += [0.0] * len(waiting)
                    waiting, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def identified(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` (doc_id, text) with held_out, lang_pred and score, one row per row.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if there
    was nothing to learn from. A null doc_id is in no fold, so it is not held out. Texts are read
    whole, however long; repeated rows are labelled each and alike; other columns are left out,
    whatever their names. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    out = docs.select("doc_id", "text").mapInArrow(
        _label(shared), "doc_id long, lang_pred string, score double"
    )
    held_out = F.coalesce(crc_of_id() % FOLDS == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
