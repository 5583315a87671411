"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by the letter).  An n-gram's
vector binds its letters: the vector of the letter k places before the last is
permuted k times (rotated), and all are multiplied.  A text bundles (sums) the
vectors of its n-grams; a language's prototype bundles its training texts, each
scaled to length one.  The language with the largest cosine is predicted.

Bundling is linear, so a text is first counted: vector = counts x n-gram vectors, a
matrix product for a slice of texts.  Training sums per task, then per language
and dimension in Spark; only the prototypes (languages x dimensions) reach the
driver, and their number is checked against ``MAX_LANGUAGES``.

A text of over ``SLICE`` characters is bundled in parts of that many.

Defined cases: a null text or one without a letter is ``und`` with score 0; runs of
other characters are one gap; without any training text every text is ``und``; null
languages are not learned from; rows are judged one by one, also repeated ones;
ties go to the language first by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import mapped, tidy

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Languages that the driver and each task hold as prototypes.
MAX_LANGUAGES = 2048
#: n-gram kinds that are looked at together, and characters of a slice.
KINDS, SLICE = 4096, 1 << 20
GAP = 0

_vectors: dict[tuple[int, int], np.ndarray] = {}  # of this process, by letter and dimensions


def letter_vector(letter: int, dimensions: int) -> np.ndarray:
    if (letter, dimensions) not in _vectors:
        if len(_vectors) > 50_000:
            _vectors.clear()
        bits = np.random.Generator(np.random.PCG64([letter, 2024])).integers(0, 2, dimensions, dtype=np.int8)
        _vectors[letter, dimensions] = (2 * bits - 1).astype(np.float32)
    return _vectors[letter, dimensions]


def gram_vectors(grams: np.ndarray, letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of ``grams``, rows of places in ``letters``."""
    base = np.stack([letter_vector(int(x), dimensions) for x in letters])
    bound = np.ones((len(grams), dimensions), np.float32)
    n = grams.shape[1]
    for k in range(n):
        bound *= np.roll(base, n - 1 - k, axis=1)[grams[:, k]]
    return bound


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, everything but letters a gap."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


_is_letter = np.zeros(0, bool)


def letter_table() -> np.ndarray:
    global _is_letter
    if not len(_is_letter):
        _is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _is_letter


def spelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters and single gaps of all texts, the text of each, whether each text has a letter)."""
    points = [letters_of(t) for t in texts]
    # a gap on each side, so that short words and ends count too
    row = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in points])
    whole = np.concatenate([x for p in points for x in (p, [GAP])]).astype(np.uint32)
    whole[~letter_table()[whole]] = GAP
    has = np.bincount(row[whole != GAP], minlength=len(texts)) > 0
    keep = (whole != GAP) | np.concatenate(([True], whole[:-1] != GAP)) | np.concatenate(([True], row[1:] != row[:-1]))
    return whole[keep], row[keep], has


def bundles(texts: list[str], dimensions: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(bundled vector of each text, whether it has a letter)."""
    whole, row, has = spelled(texts)
    return gram_bundles(whole, row, len(texts), dimensions, gram), has


def gram_bundles(whole: np.ndarray, row: np.ndarray, n_texts: int, dimensions: int, gram: int) -> np.ndarray:
    """The bundled vector of each text, from its letters and gaps."""
    letters, places = np.unique(whole, return_inverse=True)
    out = np.zeros((n_texts, dimensions), np.float32)
    n = len(whole) - gram + 1
    if n < 1:
        return out
    base = len(letters)
    code = np.zeros(n, np.int64)
    for k in range(gram):
        code = code * base + places[k : k + n]
    code = code[inside := row[:n] == row[gram - 1 :]]
    row = row[:n][inside]
    if base**gram <= 1 << 20:
        seen = np.flatnonzero(np.bincount(code, minlength=1))
        kind = np.zeros(base**gram, np.int64)
        kind[seen] = np.arange(len(seen))
        kind = kind[code]
    else:
        seen, kind = np.unique(code, return_inverse=True)
    for first in range(0, len(seen), KINDS):
        part = seen[first : first + KINDS]
        mine = slice(None) if len(seen) <= KINDS else (kind >= first) & (kind < first + KINDS)
        counts = np.bincount(row[mine] * len(part) + kind[mine] - first, minlength=n_texts * len(part))
        grams = np.stack([part // base ** (gram - 1 - k) % base for k in range(gram)], axis=1)
        out += counts.reshape(n_texts, len(part)).astype(np.float32) @ gram_vectors(grams, letters, dimensions)
    return out


def bundled(texts: list[str], dimensions: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """``bundles``, with a text of over ``SLICE`` characters taken in parts whose vectors add up.

    A part reaches ``gram`` - 1 letters into the next, so every n-gram is in exactly one.
    """
    if len(texts) != 1 or len(texts[0]) <= SLICE:
        return bundles(texts, dimensions, gram)
    whole, row, has = spelled(texts)
    parts = ((whole[k : k + SLICE + gram - 1], row[k : k + SLICE + gram - 1]) for k in range(0, len(whole), SLICE))
    return sum(gram_bundles(*part, 1, dimensions, gram) for part in parts), has


def batches_of(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` characters and at most 512 rows."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and (held + len(text) > SLICE or i - first >= 512):
            yield first, i
            first, held = i, 0
        held += len(text)
    if texts:
        yield first, len(texts)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Prototype of every language of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for first, last in batches_of(texts):
                vectors, _ = bundled(texts[first:last], dimensions, gram)
                vectors = unit(vectors)
                here = np.array(langs[first:last], object)
                for lang in set(langs[first:last]):
                    sums[lang] = sums.get(lang, 0) + vectors[here == lang].sum(axis=0, dtype=np.float64)
        names = sorted(sums)
        values = pa.array([sums[n].tolist() for n in names], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), values], ["lang", "sums"])

    labelled = docs.select(F.col(lang_col).cast("string"), text_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sums = labelled.mapInArrow(tidy(run), "lang string, sums array<double>").select("lang", F.posexplode("sums").alias("d", "v"))
    rows = sums.groupBy("lang", "d").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("vs"))
    rows = rows.select("lang", F.col("vs.v").alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is {lang_col} a language?")
    return {r.lang: np.array(r.v, np.float32) for r in sorted(rows, key=lambda r: r.lang) if np.any(r.v)}


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", dimensions: int = DIMENSIONS, gram: int = GRAM
) -> DataFrame:
    """Each row of ``docs`` as ``doc`` with ``lang_pred`` and ``score``, the cosine with that prototype (0 to 1)."""
    names = list(prototypes)
    matrix = docs.sparkSession.sparkContext.broadcast(unit(np.stack(list(prototypes.values()))) if names else None)

    def run(batches: Iterator[pa.StructArray]) -> Iterator[tuple[pa.StructArray, list[pa.Array]]]:
        for rows in batches:
            texts = [t or "" for t in rows.field(text_col).to_pylist()]
            langs, scores = [], []
            for first, last in batches_of(texts):
                if not names:
                    langs += [UNKNOWN] * (last - first)
                    scores += [0.0] * (last - first)
                    continue
                vectors, has = bundled(texts[first:last], dimensions, gram)
                cosine = unit(vectors) @ matrix.value.T
                best = cosine.argmax(axis=1)
                langs += [names[b] if h else UNKNOWN for b, h in zip(best, has)]
                scores += np.where(has, np.clip(cosine.max(axis=1), 0, 1), 0.0).tolist()
            yield rows, [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return mapped(docs, "lang_pred string, score double", run)
