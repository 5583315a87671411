"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def lm_scores(rows: list[tuple], order: int, prior: float) -> tuple[list[tuple], int]:
    """(n_tokens, n_known, base, score) for each of (text, held out), and the training tokens."""
    seqs = [["<s>"] + [("word", w) for w in words(text)] + ["</s>"] for text, _ in rows]
    counts: Counter = Counter()
    for seq, (_, held) in zip(seqs, rows):
        if not held:
            for n in range(1, order + 1):
                counts.update(tuple(seq[k : k + n]) for k in range(len(seq) - n + 1))
    n_tokens = sum(len(s) - 1 for s, (_, held) in zip(seqs, rows) if not held)
    n_words = len({g for g in counts if len(g) == 1 and g != ("<s>",)})
    out = []
    for seq in seqs:
        base = score = 0.0
        known = 0
        for k in range(1, len(seq)):
            p = (counts[(seq[k],)] + 1) / (n_tokens + n_words + 1)
            base += math.log10(p)
            known += counts[(seq[k],)] > 0
            for n in range(2, min(order, k + 1) + 1):
                p = (counts[tuple(seq[k - n + 1 : k + 1])] + prior * p) / (counts[tuple(seq[k - n + 1 : k])] + prior)
            score += math.log10(p)
        out.append((len(seq) - 1, known, base, score))
    return out, n_tokens


def shingles(text: str | None, size: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def near_components(rows: list[tuple], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """id -> (shingles, smallest id reachable)."""
    sets = {i: shingles(text, size) for i, text in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeats(rows: list[tuple], length: int) -> dict[int, tuple[int, int, int, str]]:
    """id -> (bytes, removed, runs, sha256 of what is left)."""
    seen: set[bytes] = set()
    out = {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if (window := data[p : p + length]) in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        left = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def without_boilerplate(rows: list[tuple], min_sites: int) -> dict[int, str | None]:
    """id -> text left, of (id, text, site)."""
    sites: dict[str, set] = {}
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if site is not None:
                sites.setdefault(line.strip(" \t\r"), set()).add(site)
    seen: set[str] = set()
    out = {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[i] = None
            continue
        kept = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r")
            if bare and len(sites.get(bare, ())) >= min_sites and bare in seen:
                continue
            seen.add(bare)
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(text: str | None, items: list[tuple[int, str]], window: int = 10) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """(words, hit words, items, runs of hit words as characters)."""
    low = (text or "").translate(LOWER)
    spots = [m.span() for m in NORMAL.finditer(low)]
    w = [low[a:b] for a, b in spots]
    hit, names = [False] * len(w), set()
    for name, item in items:
        v = NORMAL.findall(item.translate(LOWER))
        for k in range(max(1, len(v) - window + 1) if v else 0):
            part = v[k : k + window]
            for p in range(len(w) - len(part) + 1):
                if w[p : p + len(part)] == part:
                    names.add(str(name))
                    hit[p : p + len(part)] = [True] * len(part)
    runs = []
    for p, h in enumerate(hit):
        if h and not (p and hit[p - 1]):
            runs.append([spots[p][0], spots[p][1]])
        elif h:
            runs[-1][1] = spots[p][1]
    return len(w), sum(hit), sorted(names), [tuple(r) for r in runs]
