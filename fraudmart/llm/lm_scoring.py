"""Language-model scoring with a weighted backoff automaton.

Words (lower-cased A-Z, divided by white space) and one end token a text.  The model is
an interpolated n-gram model with a Dirichlet prior: with ``c`` the training counts,

    p(w)      = (c(w) + 1) / (N + V + 1)
    p(w | h)  = (c(h w) + m p(w | h')) / (c(h) + m)        h' is h without its first word

As an automaton, every context h that was seen is a state, every n-gram h w that was
seen an arc with weight log10 p(w | h), and an unseen one takes the failure arc of h,
of weight log10(m / (c(h) + m)), into the state of h'.  The empty context has an arc for
every word, also the unknown one.  A text is read once from left to right; its score
is the sum of the weights on its way.

The whole corpus is counted and no model is ever in one place:

1. Tasks cut their texts into chunks of about ``CHUNK_TOKENS`` and store each chunk as one row: its
   distinct words, and its texts as indexes of them; nothing else of the corpus is written.
2. For one order after another, every chunk counts its distinct n-grams, as sorted 64-bit hashes
   dealt into buckets by their top bits.  One row per chunk and bucket is shuffled, whatever the
   frequency of a word.  A bucket adds up the chunks' counts and answers each chunk with the
   corpus's totals, in the chunk's own order.  What an order has shuffled goes before the next begins.
3. A chunk meets its answers, makes the part of the automaton that its texts can
   reach, and sends all of its texts through it.

Defined cases: a null or empty text is the end token alone; a null ``held_out`` counts as
false (training); rows are scored one by one and each counts, also repeated ones;
without training text every probability is that of an unknown word; an empty
table gives no rows; input columns other than the id are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import drop_shuffles, mix64, staged, text_slices, tidy, tidy_cogroup, tidy_group, word_hashes, words_in

ORDER = 2
#: Weight m of the shorter context.
PRIOR = 60.0
CHUNK_TOKENS = 2_000_000
#: Text bytes of the corpus for each bucket of n-grams.
BUCKET_BYTES = 4 << 20

IS_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
START, END = (mix64(np.array([x], np.uint64))[0] for x in (0x5354415254, 0x454E44))


def grams(tokens: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1..order-grams that end at each token; ``place`` counts from each text's start token.

    Entry n - 1 holds n-grams; it is right only where ``place >= n - 1``.
    """
    found = [tokens]
    for n in range(2, order + 1):
        longer = np.zeros_like(tokens)
        longer[1:] = mix64(found[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + tokens[1:] + np.uint64(n))
        found.append(longer)
    return found


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes, all lowest first, compressed: high bytes that are equal cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes())


def from_planes(packed: bytes, dtype: str) -> np.ndarray:
    width, data = np.dtype(dtype).itemsize, zstandard.ZstdDecompressor().decompress(packed)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def delta(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def from_delta(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "<u8"), dtype=np.uint64)


class Chunk:
    """Texts that are counted and scored together: tokens with a start before each text."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        self.tokens, self.lengths = tokens, lengths
        first = np.cumsum(lengths) - lengths
        self.place = np.arange(len(tokens)) - np.repeat(first, lengths)
        self.row = np.repeat(np.arange(len(lengths)), lengths)

    def of_order(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct n-grams, tokens that end one, which one each ends)."""
        at = np.flatnonzero(self.place >= n - 1)
        keys, which = np.unique(grams(self.tokens, self.place, n)[-1][at], return_inverse=True)
        return keys, at, which

    def distinct(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`of_order` for n = 1..order."""
        return (self.of_order(n) for n in range(1, order + 1))


#: A chunk: its texts' ids, flags and lengths, their words as indexes, which of the sorted word hashes ``keys`` each index means.
TABLE = "chunk long, ids array<long>, held array<boolean>, lengths binary, tokens binary, words binary, keys binary"
TABLE_NAMES = [c.split()[0] for c in TABLE.split(", ")]
TABLE_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def cut_chunks(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """Rows of ``TABLE`` from (id, text, held_out)."""

    def row_of(chunk_id: int, ids: list, held: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(h) for h in hashes])
        keys, which = np.unique(np.concatenate(hashes), return_inverse=True)
        # by falling frequency: most indexes are small then, and compress
        falling = np.argsort(-np.bincount(which, minlength=len(keys)), kind="stable").astype("<u4")
        place = np.empty_like(falling)
        place[falling] = np.arange(len(falling), dtype="<u4")
        inner = np.ones(len(which), bool)
        inner[np.cumsum(lengths) - lengths] = False
        row = (chunk_id, ids, held, planes(lengths.astype("<u4")), planes(place[which[inner]]), planes(falling), delta(keys))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TABLE_TYPES)], TABLE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_id = TaskContext.get().partitionId() << 32
        ids, held, hashes, n_tokens = [], [], [], 0
        for batch in batches:
            keys, flags = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, last, data, at in text_slices(batch.column(1)):
                data = LOWERED[data]
                starts, ends, row = words_in(data, IS_WORD[data], at)
                words = word_hashes(data, starts, ends)
                cuts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=last - first))))
                for k in range(last - first):
                    hashes.append(np.concatenate(([START], words[cuts[k] : cuts[k + 1]], [END])))
                n_tokens += len(words) + 2 * (last - first)
                ids += keys[first:last]
                held += flags[first:last]
                if n_tokens >= chunk_tokens:
                    yield row_of(chunk_id, ids, held, hashes)
                    chunk_id += 1
                    ids, held, hashes, n_tokens = [], [], [], 0
        if ids:
            yield row_of(chunk_id, ids, held, hashes)

    return docs.mapInArrow(tidy(run), TABLE)


def read_chunk(row: dict) -> tuple[Chunk, np.ndarray]:
    """(chunk, which of its tokens aren't starts) of a row of ``TABLE``."""
    lengths = from_planes(row["lengths"], "<u4").astype(np.int64)
    tokens = np.full(lengths.sum(), START, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(lengths) - lengths] = False
    tokens[inner] = from_delta(row["keys"])[from_planes(row["words"], "<u4")[from_planes(row["tokens"], "<u4")]]
    return Chunk(tokens, lengths), inner


ASKED = "chunk long, bucket long, keys binary, counts binary"
ANSWERED = "chunk long, bucket long, totals binary, n_tokens long, n_words long"


def count_chunk(row: dict, n: int, bits: int) -> pa.RecordBatch:
    """One chunk's distinct n-grams and their training counts, a row for each bucket."""
    chunk, _ = read_chunk(row)
    train = ~np.array(row["held"], bool)[chunk.row]
    keys, at, which = chunk.of_order(n)
    counts = np.bincount(which, weights=train[at], minlength=len(keys)).astype("<u4")
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    ends = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    cuts = [(b, i, j) for b, (i, j) in enumerate(zip(ends, ends[1:])) if i < j]
    made = {
        "chunk": pa.array([row["chunk"]] * len(cuts), pa.int64()),
        "bucket": pa.array([b for b, _, _ in cuts], pa.int64()),
        "keys": pa.array([delta(keys[i:j]) for _, i, j in cuts], pa.binary()),
        "counts": pa.array([planes(counts[i:j]) for _, i, j in cuts], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(made.values()), list(made))


def total(bucket: pa.Table, words: bool) -> pa.Table:
    """Of one bucket: for each row, the corpus's counts of its n-grams; and, of ``words``, the training tokens and words on its first row."""
    keys = [from_delta(k.as_buffer().to_pybytes()) for k in bucket["keys"]]
    counts = [from_planes(c.as_buffer().to_pybytes(), "<u4") for c in bucket["counts"]]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(which, weights=np.concatenate(counts), minlength=len(distinct)).astype("<u8")
    answers = [planes(part) for part in np.split(sums[which], np.cumsum([len(k) for k in keys])[:-1])]
    real = sums[distinct != START] if words else np.zeros(0)
    first = np.arange(len(keys)) == 0
    return pa.table(
        {
            "chunk": bucket["chunk"],
            "bucket": bucket["bucket"],
            "totals": pa.array(answers, pa.binary()),
            "n_tokens": np.where(first, int(real.sum()), 0),
            "n_words": np.where(first, int((real > 0).sum()), 0),
        }
    )


class Automaton:
    """The states and arcs that a chunk's texts can reach.

    ``counts[n - 1]`` holds the totals of the chunk's distinct n-grams.  The state in
    which a token of place p is read is its context of up to ``order - 1`` tokens.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], n_tokens: int, n_words: int, prior: float):
        self.chunk, self.counts, self.prior = chunk, counts, prior
        order = len(counts)
        size = len(chunk.tokens)
        #: of each token, the n-gram that ends there (or -1), for n = 1..order
        self.ends = [np.full(size, -1, np.int64) for _ in range(order)]
        for n, (_, at, which) in enumerate(chunk.distinct(order)):
            self.ends[n][at] = which
        # arcs by rising order: each needs the weight of the shorter context's arc
        unigram = (counts[0] + 1.0) / (n_tokens + n_words + 1.0)
        probability = unigram[self.ends[0]]
        self.arcs = [np.log10(unigram)]
        self.failure: list[np.ndarray] = []  # of a state of n tokens, for n = 1..order - 1
        for n in range(2, order + 1):
            at = np.flatnonzero(self.ends[n - 1] >= 0)
            arc, state = self.ends[n - 1][at], self.ends[n - 2][at - 1]
            context = counts[n - 2].astype(np.float64)
            probability = probability.copy()
            probability[at] = (counts[n - 1][arc] + prior * probability[at]) / (context[state] + prior)
            weight = np.zeros(len(counts[n - 1]))
            weight[arc] = np.log10(probability[at])
            self.arcs.append(weight)
            self.failure.append(np.log10(prior / (context + prior)))

    def read(self) -> np.ndarray:
        """log10 probability of each text: every token follows its state's arc, or failure arcs until there is one."""
        chunk = self.chunk
        weight = np.zeros(len(chunk.tokens))
        waiting = np.flatnonzero(chunk.place > 0)
        for n in range(len(self.arcs), 0, -1):
            gram = self.ends[n - 1][waiting]
            if n == 1:
                weight[waiting] += self.arcs[0][gram]
                break
            longest = gram >= 0  # a text's first tokens have shorter contexts
            seen = longest & (self.counts[n - 1][gram] > 0)
            weight[waiting[seen]] += self.arcs[n - 1][gram[seen]]
            fails = waiting[longest & ~seen]
            weight[fails] += self.failure[n - 2][self.ends[n - 2][fails - 1]]
            waiting = waiting[~seen]
        return np.bincount(chunk.row, weights=weight, minlength=len(chunk.lengths))


SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_chunk(row: dict, answers: pa.Table, order: int, n_tokens: int, n_words: int, prior: float) -> pa.Table:
    """Scores of one chunk's texts, given the corpus's counts of its n-grams."""
    answers = answers.sort_by([("gram", "ascending"), ("bucket", "ascending")])
    gram = answers["gram"].to_numpy()
    parts = [from_planes(t.as_buffer().to_pybytes(), "<u8") for t in answers["totals"]]
    counts = [np.concatenate([parts[i] for i in np.flatnonzero(gram == n)] or [np.zeros(0, "<u8")]) for n in range(1, order + 1)]
    chunk, inner = read_chunk(row)
    automaton = Automaton(chunk, counts, n_tokens, n_words, prior)
    known = counts[0][automaton.ends[0]] * inner > 0
    base = np.where(inner, automaton.arcs[0][automaton.ends[0]], 0.0)
    return pa.table(
        {
            "id": pa.array(row["ids"], pa.int64()),
            "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": chunk.lengths - 1,
            "n_known": np.bincount(chunk.row, weights=known, minlength=len(chunk.lengths)).astype(np.int64),
            "base_score": np.bincount(chunk.row, weights=base, minlength=len(chunk.lengths)),
            "score": automaton.read(),
        }
    )


def score_texts(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    prior: float = PRIOR,
    chunk_tokens: int = CHUNK_TOKENS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, base_score, score and train_tokens of every row, learned where ``held_out`` is not true."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / bucket_bytes))))
    chunks = staged(cut_chunks(rows, chunk_tokens), "lm-chunks")

    def answers_of(n: int) -> DataFrame:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(len(batch)):
                    yield count_chunk(batch.slice(k, 1).to_pylist()[0], n, bits)

        def answer(bucket: pa.Table) -> pa.Table:
            return total(bucket, n == 1)

        asked = chunks.mapInArrow(tidy(ask), ASKED)
        answered = asked.groupBy("bucket").applyInArrow(tidy_group(answer), ANSWERED)
        return staged(answered.withColumn("gram", F.lit(n)), f"lm-totals-{n}")

    answers = []
    for n in range(1, order + 1):
        answers.append(answers_of(n))
        drop_shuffles(docs.sparkSession)
    sums = answers[0].agg(F.sum("n_tokens"), F.sum("n_words")).first()
    n_tokens, n_words = sums[0] or 0, sums[1] or 0

    def score(chunk: pa.Table, own: pa.Table) -> pa.Table:
        return score_chunk(chunk.to_pylist()[0], own, order, n_tokens, n_words, prior)

    every = reduce(DataFrame.union, answers).select("chunk", "bucket", "gram", "totals")
    scored = chunks.groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(tidy_cogroup(score), SCORES)
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
