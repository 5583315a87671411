"""Suffix order and common prefixes of one shard by induced sorting, with queues on disk.

Suffixes are of type S if smaller than the next one, else L.  The leftmost S ones
(about a third) are sorted by naming the substrings between them and doubling over
the string of names; all other suffixes are induced from them.  Going up through the first characters,
a sorted suffix puts the one before it (if L) at the end of its character's queue; going
down, the same in the mirrored alphabet gives the S ones.  A queue holds (position,
common prefix with the entry before): for two entries of one queue that is one more than the
least common prefix between the suffixes that induced them.  As keys only grow, the
priority queue of suffixes is one first-in-first-out queue per character.  What
queues hold beyond ``held`` entries goes to an unnamed temporary file of the task, which the
system removes with the task, and is read back when its character comes up.

Whole queues are moved at once in numpy.  Common prefixes are cut at ``cap``; suffixes
that agree so far stand in any order.
"""

from __future__ import annotations

import tempfile

import numpy as np

HELD = 8 << 20
SENTINEL, SEPARATOR, FIRST = 0, 1, 2


class Queues:
    """A first-in-first-out queue of (position, common prefix) for every character."""

    def __init__(self, sigma: int, held: int):
        self.parts: list[list] = [[] for _ in range(sigma)]
        self.size, self.held = 0, held
        self.file = None

    def push(self, char: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[char].append((pos, lcp))
        self.size += len(pos)
        if self.size > self.held:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    self.file.seek(0, 2)
                    parts[k] = (self.file.tell(), len(part[0]))
                    self.file.write(part[0].astype(np.int64).tobytes() + part[1].tobytes())
        self.size = 0

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for a, b in self.parts[char]:
            if isinstance(a, np.ndarray):
                self.size -= len(a)
                found.append((a, b))
            else:
                self.file.seek(a)
                found.append((np.frombuffer(self.file.read(8 * b), np.int64), np.frombuffer(self.file.read(b), np.uint8)))
        self.parts[char] = []
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def close(self) -> None:
        if self.file:
            self.file.close()


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a + 1 .. b]) for each pair a < b, by a table of minima over powers of two."""
    out = np.zeros(len(a), values.dtype)
    if not len(a):
        return out
    power = np.log2(b - a).astype(np.int64)
    level = values
    for k in range(int(power.max()) + 1):
        if k:
            half = 1 << (k - 1)
            level = np.minimum(level[:-half], level[half:])
        own = np.flatnonzero(power == k)
        if len(own):
            out[own] = np.minimum(level[a[own] + 1], level[b[own] - (1 << k) + 1])
    return out


def induce(text: np.ndarray, can: np.ndarray, run: np.ndarray, seeds: list, cap: int, held: int) -> list:
    """For every character the suffixes of ``can`` in order, with common prefixes, from the sorted ``seeds``.

    ``seeds[c]`` stand behind the induced ones of c.  ``run`` is the length of the run of equal characters.
    """
    sigma = len(seeds)
    queues = Queues(sigma, held)
    out = []
    before = np.concatenate(([-1], np.where(can, text, -1)[:-1]))  # of each suffix, the character it induces
    for c in range(sigma):
        pos, lcp = queues.pop(c)
        parts, length = [(pos, lcp)], 1
        while len(own := np.flatnonzero(before[pos] == c)):
            lcp = np.concatenate(([length], np.minimum(least_between(lcp, own[:-1], own[1:]), cap - 1) + 1)).astype(np.uint8)
            lcp[0] = min(length, cap)
            pos = pos[own] - 1
            parts.append((pos, lcp))
            length += 1
        pos, lcp = np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])
        if len(lcp):
            lcp = lcp.copy()
            lcp[0] = 0
        out.append((pos, lcp))
        seed, seed_lcp = seeds[c]
        if len(seed):
            edge = min(run[pos[-1]], run[seed[0]]) if len(pos) else 0
            pos, lcp = np.concatenate((pos, seed)), np.concatenate((lcp, [edge], seed_lcp[1:])).astype(np.uint8)
        into = before[pos]
        own = np.flatnonzero((into >= 0) & (into != c))
        if not len(own):
            continue
        own = own[np.argsort(into[own], kind="stable")]
        into = into[own]
        new = np.ones(len(own), np.uint8)
        same = np.flatnonzero(into[1:] == into[:-1])
        new[same + 1] = np.minimum(least_between(lcp, own[same], own[same + 1]), cap - 1) + 1
        cuts = np.flatnonzero(np.concatenate(([True], into[1:] != into[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(own)]):
            queues.push(int(into[a]), pos[own[a:b]] - 1, new[a:b])
    queues.close()
    return out


def next_change(text: np.ndarray) -> np.ndarray:
    """Of each place the last one of its run of equal characters."""
    last = np.concatenate((text[1:] != text[:-1], [True]))
    places = np.where(last, np.arange(len(text)), len(text))
    return np.minimum.accumulate(places[::-1])[::-1]


def name(lms: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from each leftmost S to the next, six symbols of 10 bits at a time."""
    length = np.concatenate((np.diff(lms) + 1, [1]))
    rank = np.zeros(len(lms), np.int64)
    left, padded, done = np.arange(len(lms)), np.concatenate((symbols, np.zeros(6, symbols.dtype))), 0
    while len(left):
        key = np.zeros(len(left), np.uint64)
        for k in range(6):
            inside = length[left] > done + k
            key = (key << np.uint64(10)) | np.where(inside, padded[np.minimum(lms[left] + done + k, len(padded) - 1)] + 1, 0).astype(np.uint64)
        order = np.lexsort((key, rank[left]))
        ranks, keys = rank[left][order], key[order]
        new = np.concatenate(([True], (ranks[1:] != ranks[:-1]) | (keys[1:] != keys[:-1])))
        head = np.concatenate(([True], ranks[1:] != ranks[:-1]))
        # rank is the number of smaller ones: the group's rank, and the place in it
        place = np.arange(len(order))
        first = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
        rank[left[order]] = ranks + first
        done += 6
        size = np.bincount(np.cumsum(new) - 1)
        tied = np.repeat(size > 1, size)
        left = left[order[tied]]
        left = np.sort(left[length[left] > done])
    return rank


def sort_lms(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The leftmost S suffixes in order of their first ``cap`` characters, with common prefixes."""
    rank = name(lms, text.astype(np.int64) * 2 + is_s)
    span = 1
    order = np.argsort(rank, kind="stable")
    while span < cap:  # a substring has two characters or more, its last is the next one's first
        ranks = rank[order]
        same = ranks[1:] == ranks[:-1]
        slots = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
        if not len(slots):
            break
        tied = order[slots]
        later = np.where(tied + span < len(rank), rank[np.minimum(tied + span, len(rank) - 1)] + 1, 0)
        key = (rank[tied].astype(np.uint64) << np.uint64(32)) | later.astype(np.uint64)
        again = np.argsort(key, kind="stable")
        tied, key = tied[again], key[again]
        order[slots] = tied
        rank[tied] = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), slots, 0))
        span *= 2
    pos = lms[order]
    lcp = np.zeros(len(pos), np.uint8)
    left = np.arange(1, len(pos))
    for k in range(cap):
        left = left[np.maximum(pos[left], pos[left - 1]) + k < len(text)]
        left = left[text[pos[left] + k] == text[pos[left - 1] + k]]
        if not len(left):
            break
        lcp[left] += 1
    return pos, lcp


def split_by(text: np.ndarray, pos: np.ndarray, lcp: np.ndarray, sigma: int) -> list:
    cuts = np.searchsorted(text[pos], np.arange(sigma + 1))
    return [(pos[a:b], lcp[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def sorted_suffixes(text: np.ndarray, cap: int, held: int = HELD):
    """Yields (positions, common prefixes with the one before) for each first character, in order.

    ``text`` has characters of ``FIRST`` and more, ``SEPARATOR`` between strings, and one
    ``SENTINEL`` at its end (whose own suffix is left out).
    """
    sigma = int(text.max()) + 1
    change = next_change(text)
    after = np.minimum(change + 1, len(text) - 1)
    is_s = text[change] < text[after]
    is_s[-1] = True
    run = np.minimum(change - np.arange(len(text)) + 1, cap).astype(np.uint8)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    pos, lcp = sort_lms(text, is_s, lms, cap)
    text = text.astype(np.int16)
    up = induce(text, ~is_s, run, split_by(text, pos, lcp, sigma), cap, held)
    turned = []
    for pos, lcp in reversed(up):
        turned.append((pos[::-1], np.concatenate((lcp[:1] * 0, lcp[:0:-1]))))
    down = induce(sigma - 1 - text, is_s, run, turned, cap, held)
    for c in range(sigma):
        (first, first_lcp), (pos, lcp) = up[c], down[sigma - 1 - c]
        if len(pos):
            edge = min(run[first[-1]], run[pos[-1]]) if len(first) else 0
            first = np.concatenate((first, pos[::-1]))
            first_lcp = np.concatenate((first_lcp, [edge], lcp[:0:-1])).astype(np.uint8)
        yield first, first_lcp
