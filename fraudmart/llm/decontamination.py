"""Benchmark decontamination: one Aho-Corasick automaton, one scan of every text.

A-Z are lower-cased and every other ASCII character but digits and letters
divides words; each benchmark item gives its windows of ``window`` consecutive
words (an item of fewer words is one window).  All windows go into one
automaton over the normalised UTF-8 bytes; normalising maps byte to byte, so a
match leads back to offsets in the original text.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of text: its size is
measured first, and with more than one block a task holds one automaton at a
time and runs its batch through each.  Documents are never shuffled.

Defined cases: a null or empty text, or one of separators only, has no words and no
hits; an item without words has no windows; items of the same id are one item and
a null id is written as the empty string; rows of documents are judged one by one,
also repeated ones; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import kept, mapped, text_slices

#: Benchmark text in one automaton; it has about ``window`` states a byte.
BLOCK_BYTES = 128 << 10

_KEPT = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("a", "z"), ("A", "Z")):
    _KEPT[ord(_first) : ord(_last) + 1] = True
_KEPT[128:] = True
#: Lower-cases A-Z, keeps digits, letters and all bytes of other characters, makes the rest a space.
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b) if _KEPT[b] else 32 for b in range(256))

ADDED = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def build_automaton(items: list[tuple[str, str]], window: int) -> ahocorasick.Automaton:
    """Of the windows of (id, text); a window's value is its number of words and its items."""
    windows: dict[bytes, tuple[int, set[str]]] = {}
    for name, text in items:
        words = words_of(text.encode())
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            windows.setdefault(b" " + b" ".join(part) + b" ", (len(part), set()))[1].add(name)
    automaton = ahocorasick.Automaton()
    for pattern, value in windows.items():
        automaton.add_word(pattern.decode("latin-1"), value)
    if windows:
        automaton.make_automaton()
    return automaton


_built: dict[tuple[str, int], ahocorasick.Automaton] = {}  # of this worker: the last automaton
kept[__name__] = _built


def automaton_of(name: str, block: Broadcast, window: int) -> ahocorasick.Automaton:
    if (name, window) not in _built:
        _built.clear()
        _built[name, window] = build_automaton(block.value, window)
    return _built[name, window]


def original_spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as [start, end) in characters of the original text."""
    spots = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", text.translate(NORMAL))]
    characters = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return [{"start": int(characters[spots[a][0]]), "end": int(characters[spots[b - 1][1]])} for a, b in zip(edge[::2], edge[1::2])]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[tuple[str, Broadcast]]:
    """The benchmark as named broadcasts of about ``block_bytes``, each collected by itself."""
    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    blocks = []
    for k in range(n):
        part = named if n == 1 else named.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        rows = sorted((r.id, r.text) for r in part.collect())
        blocks.append((hashlib.sha256(repr(rows).encode()).hexdigest(), items.sparkSession.sparkContext.broadcast(rows)))
    return blocks


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each row of ``docs`` as ``doc``, with n_words, n_hit, items (sorted ids) and spans of hit words in the original text."""
    blocks = item_blocks(items, item_id, item_text, block_bytes)

    def scan(batches: Iterator[pa.StructArray]) -> Iterator[tuple[pa.StructArray, list[pa.Array]]]:
        for rows in batches:
            texts, normal, n_words = [], [], []
            for first, last, data, at in text_slices(rows.field(text_col)):
                data = data.tobytes()
                changed = data.translate(NORMAL)
                for i in range(last - first):
                    words = changed[at[i] : at[i + 1]].split()
                    n_words.append(len(words))
                    texts.append((data, at[i], at[i + 1]))
                    normal.append(b" " + b" ".join(words) + b" ")
            found: dict[int, list] = {}
            for name, block in blocks:
                automaton = automaton_of(name, block, window)
                if not len(automaton):
                    continue
                for i, text in enumerate(normal):
                    if got := list(automaton.iter(text.decode("latin-1"))):
                        found.setdefault(i, []).extend(got)
            n_hit, names, spans = [0] * len(rows), [[]] * len(rows), [[]] * len(rows)
            for i, got in found.items():
                gaps = np.flatnonzero(np.frombuffer(normal[i], np.uint8) == 32)
                last_word = np.searchsorted(gaps, [end for end, _ in got])
                lengths = np.array([value[0] for _, value in got])
                change = np.zeros(n_words[i] + 1, np.int64)
                np.add.at(change, last_word - lengths, 1)
                np.add.at(change, last_word, -1)
                hit = np.cumsum(change)[:-1] > 0
                data, a, b = texts[i]
                n_hit[i] = int(hit.sum())
                names[i] = sorted(set().union(*(value[1] for _, value in got)))
                spans[i] = original_spans(data[a:b], hit)
            yield rows, [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, SPANS)]

    return mapped(docs, ADDED, scan, __name__)
