"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each).  Every passage is encoded
from its text alone: shares of byte classes, word lengths, repeated words.  The
model is ``h = tanh(W x)`` per passage, gated attention
``a = softmax(w . (tanh(V h) * sigmoid(U h)))`` over the passages of a document, and
``score = sigmoid(c . sum(a h) + b)``; only document labels are used to learn it.

Learning takes a bounded sample on the driver: the ``sample`` labelled documents of the
smallest hashed id, of each at most ``sample_passages`` passages (evenly spaced).
Scoring takes every passage of every document, in numpy inside Arrow batches.

Defined cases: a null or empty text is one passage of zeros and gets a score; null
labels or ids are not learned from; of repeated labels of an id the lowest counts;
without labels of both kinds the score is the labels' smoothed share; rows of
documents are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import mapped, text_slices, tidy, word_hashes, words_in

PASSAGE = 64
SAMPLE, SAMPLE_PASSAGES = 6000, 128
HIDDEN, GATE = 32, 16


def byte_classes() -> np.ndarray:
    """A class for lower case, upper case, digits, other bytes of letters and controls each; one for every mark."""
    kind = np.zeros(256, np.int64)
    kind[128:] = 1
    for k, (first, last) in enumerate((("a", "z"), ("A", "Z"), ("0", "9")), start=2):
        kind[ord(first) : ord(last) + 1] = k
    marks = [b for b in range(32, 127) if not chr(b).isalnum()] + [10]
    kind[marks] = np.arange(len(marks)) + 5
    return kind


CLASSES = byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
N_FEATURES = 2 * N_CLASSES + 5
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def passages(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, features) of every passage of the texts ``data[at[i]:at[i + 1]]``; each text has at least one."""
    n_rows = len(at) - 1
    starts, word_end, row_of_word = words_in(data, ~IS_SPACE[data], at)
    n_words = np.bincount(row_of_word, minlength=n_rows)
    place = np.arange(len(starts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    row = np.repeat(np.arange(n_rows), n_passages)
    begin = at[row].copy()
    later = np.flatnonzero(np.concatenate(([False], row[1:] == row[:-1])) if len(row) else [])
    begin[later] = starts[(place % PASSAGE == 0) & (place > 0)]
    end = np.concatenate((begin[1:], at[-1:]))
    size = end - begin
    passage = np.repeat(np.arange(len(row)), size)
    counts = np.bincount(passage * N_CLASSES + CLASSES[data], minlength=len(row) * N_CLASSES).reshape(len(row), N_CLASSES)
    share = counts / np.maximum(size, 1)[:, None]

    hashes = word_hashes(data, starts, word_end)
    passage_of_word = (np.cumsum(n_passages) - n_passages)[row_of_word] + place // PASSAGE
    words = np.bincount(passage_of_word, minlength=len(row))
    letters = np.bincount(passage_of_word, weights=word_end - starts, minlength=len(row))
    key = np.sort((passage_of_word.astype(np.uint64) << np.uint64(36)) | (hashes >> np.uint64(28)))
    distinct = np.bincount((key[np.concatenate(([True], key[1:] != key[:-1]))] >> np.uint64(36)).astype(np.int64), minlength=len(row)) if len(key) else words
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (passage_of_word[1:] == passage_of_word[:-1]))
    repeated = np.bincount(passage_of_word[again], minlength=len(row)) if len(again) else np.zeros(len(row))
    per = np.maximum(words, 1)
    more = np.stack([letters / per / 10, distinct / per, repeated / per, np.log1p(words) / 5, np.log1p(size) / 7], axis=1)
    return row, np.concatenate([share, np.sqrt(share), more], axis=1).astype(np.float32)


def softmax_by(row: np.ndarray, first: np.ndarray, logits: np.ndarray) -> np.ndarray:
    weights = np.exp(logits - np.maximum.reduceat(logits, first)[row])
    return weights / np.add.reduceat(weights, first)[row]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, row: np.ndarray, x: np.ndarray) -> tuple:
        w = self.weights
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        bag = np.cumsum(np.concatenate(([0], row[1:] != row[:-1])))
        h = np.tanh(x @ w["W"] + w["Wb"])
        t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        a = softmax_by(bag, first, (t * g) @ w["w"])
        z = np.add.reduceat(a[:, None] * h, first)
        return first, bag, h, t, g, a, z, sigmoid(z @ w["c"] + w["b"])

    def score(self, row: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Of each row 0..n-1 (all have passages); six digits, which don't depend on the rows scored together."""
        if self.constant is not None:
            return np.full(row[-1] + 1 if len(row) else 0, self.constant)
        return np.round(self.forward(row, (features.astype(np.float64) - self.mean) / self.scale)[-1], 6)


def fit(row: np.ndarray, features: np.ndarray, labels: np.ndarray, epochs: int = 30, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on the log loss of document labels; ``row`` is sorted, 0..len(labels)-1."""
    constant = None if 0 < labels.sum() < len(labels) else (labels.sum() + 1) / (len(labels) + 2)
    mean, scale = (features.mean(axis=0), features.std(axis=0) + 1e-2) if len(features) else (0.0, 1.0)
    rng = np.random.default_rng(seed)
    shapes = {"W": (N_FEATURES, HIDDEN), "Wb": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": ()}
    w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "Wb" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    model = Model(mean, scale, w, constant)
    if constant is not None:
        return model
    x_all = ((features - mean) / scale).astype(np.float32)
    bounds = np.searchsorted(row, np.arange(len(labels) + 1))
    m, v = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), 128):
            docs = order[k : k + 128]
            pick = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            sizes = bounds[docs + 1] - bounds[docs]
            x, y = x_all[pick], labels[docs]
            first, bag, h, t, g, a, z, p = model.forward(np.repeat(np.arange(len(docs)), sizes), x)
            d_out = (p - y) / len(docs)
            grad = {"c": z.T @ d_out, "b": d_out.sum()}
            d_z = (d_out[:, None] * w["c"])[bag]
            d_a = (d_z * h).sum(axis=1)
            d_logit = a * (d_a - np.add.reduceat(a * d_a, first)[bag])
            grad["w"] = (t * g).T @ d_logit
            d_tg = d_logit[:, None] * w["w"]
            d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
            grad["V"], grad["U"] = h.T @ d_t, h.T @ d_g
            d_h = (a[:, None] * d_z + d_t @ w["V"].T + d_g @ w["U"].T) * (1 - h * h)
            grad["W"], grad["Wb"] = x.T @ d_h, d_h.sum(axis=0)
            step += 1
            now = rate * (1 - epoch / epochs)
            for key, value in grad.items():
                value = value + 1e-5 * w[key]
                m[key] = 0.9 * m[key] + 0.1 * value
                v[key] = 0.999 * v[key] + 0.001 * value * value
                w[key] = (w[key] - now * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    sample_passages: int = SAMPLE_PASSAGES,
) -> Model:
    """A model of the labels of ``docs``, from a sample of at most ``sample`` documents.

    An id that is there more than once counts once, with its text of the least hash.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.min(label_col).cast("double").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = [], []
            for _, _, data, at in text_slices(batch.column(1)):
                row, x = passages(data, at)
                for r in range(len(at) - 1):
                    own = np.flatnonzero(row == r)
                    if len(own) > sample_passages:
                        own = own[np.linspace(0, len(own) - 1, sample_passages).astype(int)]
                    kept.append(len(own))
                    values.append(x[own].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary()), *batch.columns[2:]], ["id", "x", "y", "h"])

    id_type = docs.schema[id_col].dataType.simpleString()
    made = chosen.select("id", "text", "y", F.xxhash64("text").alias("h")).mapInArrow(tidy(run), f"id {id_type}, x binary, y double, h long")
    # of rows that share an id the one whose text has the least hash: at most ``sample`` rows are collected
    rows = made.groupBy("id").agg(F.min(F.struct("h", "x", "y")).alias("r")).select("id", "r.x", "r.y").collect()
    rows = sorted(rows, key=lambda r: r.id)
    bags = [np.frombuffer(r.x, "<f4").reshape(-1, N_FEATURES) for r in rows]
    features = np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32)
    row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return fit(row, features, np.array([r.y > 0 for r in rows], np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` as ``doc`` with ``score``, from all its passages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 10,000 numbers

    def run(batches: Iterator[pa.StructArray]) -> Iterator[tuple[pa.StructArray, list[pa.Array]]]:
        for rows in batches:
            scores = [shared.value.score(*passages(data, at)) for _, _, data, at in text_slices(rows.field(text_col))]
            yield rows, [pa.array(np.concatenate(scores).astype(np.float64) if scores else [], pa.float64())]

    return mapped(docs, "score double", run)
