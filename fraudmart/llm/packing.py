"""Packing of tokenised documents into sequences by best-fit decreasing.

A document's ids end with one closing id.  Documents longer than a sequence are
first cut into full windows; what is left goes, longest first, into the open
window with the least room that still takes it.  The open windows stand in a
segment tree indexed by remaining capacity, so each choice is O(log length).

A task packs its own partition in groups of about ``GROUP_TOKENS``; nothing is
shuffled and memory does not grow with the partition.  At the end of a group the
windows that are not full are closed by cutting: the emptiest are taken apart and
their pieces fill the room of the others.  The one window that may stay open is
cut into sequences of powers of two, which need no padding.

Defined cases: a null or empty text is its closing id alone; rows are packed one by
one, also repeated ones; an empty table gives no sequences; input columns stay in ``doc``
only by the id column.
"""

from __future__ import annotations

import array
import os
import re
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import kept, text_slices, tidy

LENGTH = 2048
END_ID = 1
#: Ids that a task holds while it packs one group.
GROUP_TOKENS = 2 << 20
#: Words whose ids a worker remembers, and the longest one.
KNOWN_WORDS, KNOWN_BYTES = 400_000, 40


#: A word of plain letters (A-Z and those of Latin-1), then maybe marks: two pieces for the tokenizer, whose
#: pattern keeps letters together and marks together; an apostrophe or digit is left to the tokenizer itself.
PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


class WordTokenizer:
    """Ids of whole texts, word by word.

    The tokenizer drops white space, lower-cases, and never joins across white space,
    so a text's ids are those of its words one after another.  Words met lately are
    remembered in two generations: when the young one is full it becomes the old one.
    New words of plain letters are encoded a few hundred at once; the ids that end a
    word (``</w>`` in the vocabulary) divide the result.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.plain = Tokenizer.from_file(path)  # for lower-case letters and spaces alone
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, words: list[bytes]) -> list[bytes]:
        """By the tokenizer as it is."""
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in encoded]

    def encode_plain(self, words: list[bytes], at_once: int = 256) -> list[bytes]:
        """Of words of plain letters."""
        out: list[bytes] = []
        groups = [words[k : k + at_once] for k in range(0, len(words), at_once)]
        joined = self.plain.encode_batch_fast([b" ".join(g).decode().lower() for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, joined):
            ids = np.array(encoded.ids, np.uint32)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) == len(group):
                data = ids.tobytes()
                out += map(data.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))
            else:
                out += self.encode(group)
        return out

    def learn(self, words: set[bytes]) -> None:
        """Put ``words`` into the young generation."""
        young, old = self.young, self.old
        plain: list[tuple[bytes, bytes, bytes]] = []
        other: list[bytes] = []
        parts: set[bytes] = set()
        for word in words:
            if word in old:
                young[word] = old[word]
            elif match := PLAIN.fullmatch(word):
                letters, marks = match.groups()
                plain.append((word, letters, marks))
                parts.add(letters)
                if marks and marks not in young:
                    other.append(marks)
            else:
                other.append(word)
        ids = {w: got for w in parts if (got := young.get(w) or old.get(w))}
        new = list(parts - ids.keys())
        ids.update(zip(new, self.encode_plain(new)))
        young.update(zip(other, self.encode(other)))
        young.update((word, ids[letters] + young[marks] if marks else ids[letters]) for word, letters, marks in plain)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """32-bit ids of each text, in the machine's byte order (little-endian wherever Spark runs)."""
        # only a special token's name tells upper from lower case
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        missing = set(filterfalse(self.young.__contains__, chain.from_iterable(split)))
        self.learn(missing)
        found = [b"".join(map(self.young.__getitem__, words)) for words in split]
        for word in missing:
            if len(word) > KNOWN_BYTES:
                del self.young[word]
        if len(self.young) > KNOWN_WORDS:
            self.young, self.old = {}, self.young
        return found


_tokenizers: dict[str, WordTokenizer] = {}  # of this worker, by path
kept[__name__] = _tokenizers


def tokenizer_of(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class OpenWindows:
    """Windows by remaining room: a segment tree over 1..length tells where any are."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.tree = bytearray(2 * self.size)
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, window: int, room: int) -> None:
        if not room:
            return
        self.by_room[room].append(window)
        node = self.size + room
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out (window, room) of the least room of at least ``need``."""
        node = self.size + need
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.tree[node]:
                    node += 1
        room = node - self.size
        window = self.by_room[room].pop()
        if not self.by_room[room]:
            self.tree[node] = 0
            node >>= 1
            while node and not (self.tree[2 * node] or self.tree[2 * node + 1]):
                self.tree[node] = 0
                node >>= 1
        return window, room


Piece = tuple[int, int, int]  # document (index in the group), first id, ids


def best_fit(tails: list[Piece], length: int) -> list[list[Piece]]:
    """``tails`` packed whole, longest first."""
    windows: list[list[Piece]] = []
    open_ = OpenWindows(length)
    for piece in sorted(tails, key=lambda p: (-p[2], p[0])):
        if got := open_.tightest(piece[2]):
            window, room = got
        else:
            window, room = len(windows), length
            windows.append([])
        windows[window].append(piece)
        open_.add(window, room - piece[2])
    return windows


def close_windows(windows: list[list[Piece]], length: int) -> list[list[Piece]]:
    """No room left but in one window: the emptiest are cut up to fill the others."""
    fill = [sum(p[2] for p in w) for w in windows]
    order = sorted(range(len(windows)), key=lambda i: (-fill[i], i))
    a, b = 0, len(order) - 1
    while a < b:
        taker, giver = order[a], order[b]
        if fill[taker] == length:
            a += 1
        elif not windows[giver]:
            b -= 1
        else:
            doc, start, n = windows[giver].pop()
            take = min(n, length - fill[taker])
            # the cut is at the piece's end, so what is left keeps its start
            windows[taker].append((doc, start + n - take, take))
            if take < n:
                windows[giver].append((doc, start, n - take))
            fill[taker] += take
            fill[giver] -= take
    closed = [windows[i] for i in order[: b + 1] if windows[i]]
    last = closed.pop() if closed and sum(p[2] for p in closed[-1]) < length else []
    while last:  # of powers of two
        part: list[Piece] = []
        size = 1 << (sum(p[2] for p in last).bit_length() - 1)
        while size:
            doc, start, n = last[0]
            take = min(n, size)
            part.append((doc, start, take))
            last = last[1:] if take == n else [(doc, start + take, n - take), *last[1:]]
            size -= take
        closed.append(part)
    return closed


def pack(lengths: list[int], length: int = LENGTH) -> list[list[Piece]]:
    """Sequences for documents of so many ids: full windows of overlong ones, then best fit of the rest."""
    full, tails = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % length
        full += [[(doc, at, length)] for at in range(0, cut, length)]
        if n > cut:
            tails.append((doc, cut, n - cut))
    return full + close_windows(best_fit(tails, length), length)


SCHEMA = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``sequence_id`` is unique over all tasks (partition number, then a count), and the
    same again when a lost task is run anew.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        names: list = []
        ids: list[bytes] = []
        held = 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            columns: list[list] = [[] for _ in NAMES]
            for pieces in pack([len(i) // 4 for i in ids], length):
                at = 0
                for doc, start, n in pieces:
                    row = (names[doc], start, n, ids[doc][4 * start : 4 * (start + n)], len(ids[doc]) // 4, sequence, at)
                    for column, value in zip(columns, row):
                        column.append(value)
                    at += n
                sequence += 1
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], NAMES)
            for first in range(0, len(whole), 4096):
                yield whole.slice(first, 4096)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, last, data, at in text_slices(batch.column(1)):
                data = data.tobytes()
                new = [i + end for i in tokenizer.ids([data[at[k] : at[k + 1]] for k in range(last - first)])]
                names += keys[first:last]
                ids += new
                held += sum(map(len, new)) // 4
                if held >= group_tokens:
                    yield from emit()
                    names, ids, held = [], [], 0
        if ids:
            yield from emit()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(run, __name__), SCHEMA)


def padding(lengths: list[int], length: int = LENGTH) -> int:
    """Ids of padding for sequences of so many ids: none at a power of two."""
    return sum(0 if n & (n - 1) == 0 else length - n for n in lengths)
