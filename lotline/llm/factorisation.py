"""Text quality by a factorisation machine.

Features of a text are its distinct words, hashed into buckets, and structure statistics and
metadata (``n_chars``) cut into ranges at quantiles of the training sample. The score is
w0 + sum w_i x_i + the low-rank interactions of all feature pairs, computed in linear time as
half of sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.

The model is fitted in numpy on at most about ``TRAIN_ROWS`` labelled rows, drawn by a hash of
doc_id; scoring reads every text whole, in the tasks that scan it, without a shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import crc_of_id, drawn
from lotline.llm.suffix_arrays import words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: About how many labelled rows the model is fitted on; fewer where the labels have fewer.
TRAIN_ROWS = 10_000
BUCKETS = 1 << 13
FACTORS = 8
RANGES = 16
EPOCHS = 12
BATCH = 256
RATE = 0.02
DECAY = 1e-4
#: Rows whose remainder is HELD_OUT are never learned from.
FOLDS, HELD_OUT = 3, 1

STATISTICS = (
    "bytes", "stated_chars", "upper", "digits", "white", "marks", "symbols", "non_ascii", "word_length",
    "word_variety", "line_variety", "line_length", "top_byte", "words_a_mark", "top_word",
)

_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~", np.uint8)
_MARKS = np.frombuffer(b"!\"'(),-.:;?[]", np.uint8)


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, list[float]]:
    """Distinct hashed words of a text, and its statistics in the order of STATISTICS."""
    words = words_of(text)
    distinct = set(words)
    buckets = np.array(sorted({crc32(w) & (BUCKETS - 1) for w in distinct}), np.int32)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = max(1, len(text)), max(1, len(words))
    lines = text.split(b"\n")
    marks, white = int(counts[_MARKS].sum()), int(counts[32] + counts[9:14].sum())
    return buckets, [
        np.log1p(len(text)),
        -1.0 if n_chars is None else np.log1p(max(0, n_chars)),
        counts[65:91].sum() / size,
        counts[48:58].sum() / size,
        white / size,
        marks / size,
        counts[_SYMBOLS].sum() / size,
        counts[128:].sum() / size,
        sum(map(len, words)) / n,
        len(distinct) / n,
        len(set(lines)) / len(lines),
        np.log1p(size / len(lines)),
        counts[counts != counts[32]].max(initial=0) / size,
        n / (1 + marks),
        len(words) / (1 + len(distinct)),
    ]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    #: Where the ranges of each statistic begin.
    cuts: np.ndarray

    def encode(self, buckets: list[np.ndarray], statistics: np.ndarray):
        """Feature numbers and values of some texts in one row, and where each text begins."""
        ranges = np.stack(
            [np.searchsorted(c, s, side="right") for c, s in zip(self.cuts, statistics.T)], axis=1
        )
        ranges = BUCKETS + ranges + np.arange(len(self.cuts)) * (RANGES + 1)
        sizes = np.array([len(b) for b in buckets])
        ids = np.concatenate([x for pair in zip(buckets, ranges) for x in pair]).astype(np.int64)
        begin = np.cumsum(sizes + len(self.cuts)) - sizes - len(self.cuts)
        values = np.repeat(1 / np.sqrt(np.maximum(1, sizes)), sizes + len(self.cuts))
        for i in range(len(self.cuts)):
            values[begin + sizes + i] = 1 / np.sqrt(len(self.cuts))
        return ids, values, begin

    def margin(self, ids: np.ndarray, values: np.ndarray, begin: np.ndarray):
        """Scores before the logistic function, and each text's factor sums."""
        linear = np.add.reduceat(self.weights[ids] * values, begin)
        parts = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(parts, begin, axis=0)
        pairs = 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((parts**2).sum(axis=1), begin))
        return self.bias + linear + pairs, sums

    def scores(self, buckets: list[np.ndarray], statistics: np.ndarray) -> np.ndarray:
        margin, _ = self.margin(*self.encode(buckets, statistics))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def prior_machine(labels: np.ndarray, cuts: np.ndarray) -> Machine:
    """Scores by the share of label 1 alone; 0.5 without any label."""
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    n = BUCKETS + len(STATISTICS) * (RANGES + 1)
    return Machine(float(np.log(rate / (1 - rate))), np.zeros(n), np.zeros((n, FACTORS)), cuts)


def fit(buckets: list[np.ndarray], statistics: np.ndarray, labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by Adam over minibatches; the order of rows is drawn from ``seed``."""
    inner = np.linspace(0, 1, RANGES + 2)[1:-1]
    cuts = (
        np.quantile(statistics, inner, axis=0).T
        if len(labels)
        else np.zeros((len(STATISTICS), RANGES))
    )
    machine = prior_machine(labels, cuts)
    if len(np.unique(labels)) < 2:
        return machine
    rng = np.random.default_rng(seed)
    machine.factors = rng.normal(0, 0.05, machine.factors.shape)
    state = [machine.weights, machine.factors]
    moments = [[np.zeros_like(s), np.zeros_like(s)] for s in state]
    step, bias_moments = 0, [0.0, 0.0]
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            ids, values, begin = machine.encode([buckets[r] for r in rows], statistics[rows])
            margin, sums = machine.margin(ids, values, begin)
            wrong = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)
            owner = np.repeat(np.arange(len(rows)), np.diff(np.append(begin, len(ids))))
            pull = wrong[owner] * values
            v = machine.factors[ids]
            by_feature = pull[:, None] * (sums[owner] - v * values[:, None])
            n = len(machine.weights)
            slopes = [
                np.bincount(ids, pull, n) + DECAY * machine.weights,
                np.stack([np.bincount(ids, by_feature[:, f], n) for f in range(FACTORS)], axis=1)
                + DECAY * machine.factors,
            ]
            step += 1
            shift = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for value, (first, second), slope in zip(state, moments, slopes):
                first += 0.1 * (slope - first)
                second += 0.001 * (slope**2 - second)
                value -= rate * shift * first / (np.sqrt(second) + 1e-8)
            slope = wrong.sum()
            bias_moments[0] += 0.1 * (slope - bias_moments[0])
            bias_moments[1] += 0.001 * (slope**2 - bias_moments[1])
            machine.bias -= rate * shift * bias_moments[0] / (np.sqrt(bias_moments[1]) + 1e-8)
    return machine


# --- Spark ---------------------------------------------------------------------------------------


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, chars = batch.column("text").cast(pa.binary()), batch.column("n_chars").to_pylist()
        made = [features(texts[i].as_py() or b"", chars[i]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("quality"),
                pa.array([m[0].tobytes() for m in made], pa.binary()),
                pa.array([m[1] for m in made], pa.list_(pa.float64())),
            ],
            names=["quality", "buckets", "statistics"],
        )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fit on ``docs`` (doc_id, text, n_chars) that ``labels`` (doc_id, quality) marks.

    Only rows outside the held-out fold are learned from, and of them about ``rows``, drawn by a
    hash of doc_id, so the sample that is broadcast and collected has a fixed bound. Null labels
    and null doc_ids are left out; a doc_id with several labels has the largest, one with several
    rows counts once. Texts are read whole, however long. Empty tables, or no labels, give a
    machine that scores every text 0.5. Other columns are not looked at.
    """
    usable = (
        labels.where(F.col("quality").isNotNull() & (crc_of_id() % FOLDS != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max(F.col("quality").cast("int")).alias("quality"))
    )
    share = min(1.0, rows / max(1, usable.count()))
    sample = usable.where(drawn(F.lit(share)))
    made = (
        docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars"))
        .join(F.broadcast(sample), "doc_id")
        # One text of each doc_id, so that a repeated one cannot outgrow the sample.
        .groupBy("doc_id")
        .agg(F.max(F.struct("text", "n_chars", "quality")).alias("row"))
        .select("row.*")
        .mapInArrow(_featurize, "quality int, buckets binary, statistics array<double>")
        .toPandas()
    )
    # The order in which rows arrive must not matter.
    made = made.sort_values(["buckets", "quality"], kind="stable")
    return fit(
        [np.frombuffer(b, np.int32) for b in made["buckets"]],
        np.array(made["statistics"].tolist(), float).reshape(-1, len(STATISTICS)),
        made["quality"].to_numpy(float),
    )


def _score(shared, group_bytes: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine = shared.value
        for batch in batches:
            texts, chars = batch.column("text").cast(pa.binary()), batch.column("n_chars").to_pylist()
            scores, buckets, statistics, size = [], [], [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or b""
                made = features(text, chars[i])
                buckets.append(made[0])
                statistics.append(made[1])
                size += len(text)
                if size >= group_bytes or i == batch.num_rows - 1:
                    scores += machine.scores(buckets, np.array(statistics)).tolist()
                    buckets, statistics, size = [], [], 0
            yield batch.drop_columns(["text", "n_chars"]).append_column(
                "score", pa.array(scores, pa.float64())
            )

    return run


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` as the struct ``source_row``, with held_out, score and predicted.

    A null text scores like an empty one. A null doc_id is in no fold, so it is not held out.
    Without labels every score is 0.5; with one class only, scores follow the share of label 1.
    Texts are scored whole, however long; repeated rows are scored each and alike; columns of any
    name stay in the struct. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(
        F.struct("*").alias("source_row"), F.col("text"), F.col("n_chars").cast("long").alias("n_chars")
    )
    schema = rows.select("source_row", F.lit(0.0).alias("score")).schema
    out = rows.mapInArrow(_score(shared), schema)
    return out.select(
        "source_row",
        F.coalesce(crc_of_id("source_row.doc_id") % FOLDS == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return scored(docs, train(docs, labels)).where("predicted = 1").select("source_row.*")
