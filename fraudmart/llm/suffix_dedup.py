"""Suffix-array dedup: every byte under a string of ``LENGTH`` bytes that starts earlier too is removed.

Strings are compared as UTF-8 bytes inside one document; earlier means a smaller id, or
the same document and an earlier start.

1. Reduction, exact and over the whole corpus.  Of the ``GRAM``-byte hashes in each
   window of ``LENGTH`` bytes the least is its anchor, so equal windows have equal anchors.
   The windows that follow each other with one anchor form a segment of at most
   ``2 * LENGTH - GRAM`` bytes.  Segments go by anchor into buckets (as sorted columns of a
   chunk of texts, equal segments of a chunk already reduced to the first).  An anchor
   met once has no repeated window; equal segments are repeated as a whole, but
   for the first.  Only anchors with different segments are left open.
2. Sorting.  The open segments (the first of equal ones) are cut out of the texts and dealt into shards by
   anchor.  A shard sorts all suffixes of its segments by external induced sorting
   (``induced_sort``), which gives common prefixes too: suffixes between which no common
   prefix falls below ``LENGTH`` begin with the same window, and all but the earliest are repeated.
   An anchor whose open segments exceed a shard is not sorted: its windows are dealt one by one, by
   two hashes of each, so that equal ones meet and a hot anchor is spread over many tasks.
3. The repeated runs of each document are joined to its text and removed.

Hashes are 64 bits for an anchor and 48 more for a segment; as many for a hot anchor's window.

Defined cases: a null or empty text has no bytes; texts shorter than ``LENGTH`` are kept; rows
with a null id are kept and are earlier than nothing; rows of one id are one document and lose
the same bytes; an empty table gives no rows; input columns stay in ``doc``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import mapped, mix64, staged, text_slices, tidy, tidy_group
from fraudmart.llm.induced_sort import FIRST, SENTINEL, SEPARATOR, sorted_suffixes

LENGTH, GRAM = 100, 32
#: Window starts looked at together; with a window's length they need 20 bits at most.
BLOCK = (1 << 19) - 256
#: Text bytes of a chunk, of the corpus for each bucket of anchors, and of segments for a shard.
CHUNK_BYTES, BUCKET_BYTES, SHARD_BYTES = 8 << 20, 2 << 20, 3 << 19

_STEP = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}  # of this process


def powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd step and of its inverse modulo 2**64, and a random value for each byte."""
    if not _powers:
        for key, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(BLOCK + 512, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
        _powers["letters"] = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _powers["up"], _powers["down"], _powers["letters"]


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of (text, first byte in it, bytes, anchor's hash, segment's hash) of the texts ``data[at[i]:at[i + 1]]``."""
    up, down, letters = powers()
    width = length - gram + 1  # grams of a window
    place_bits = np.uint64((1 << 20) - 1)
    for block in range(0, max(0, len(data) - length + 1), BLOCK):
        part = data[block : block + BLOCK + length - 1]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[part] * up[:n], out=sums[1:])
        grams = mix64((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        # a place in the low bits makes the leftmost least and tells where it is
        least = (grams & ~place_bits) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
        anchor = (least & place_bits).astype(np.int64)
        start = np.arange(len(anchor)) + block
        text = np.searchsorted(at, start, side="right") - 1
        whole = start + length <= at[text + 1]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        keep = whole[first]
        first, last = first[keep], last[keep]
        size = last - first + length
        content = mix64((sums[first + size] - sums[first]) * down[first] ^ mix64(size.astype(np.uint64) << np.uint64(8) | (anchor[first] - first).astype(np.uint64)))
        own = text[first]
        yield own, first + block - at[own], size, grams[anchor[first]], content >> np.uint64(16)


def planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each value, all lowest first."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return wide.view("<u8").ravel()


#: Columns of a chunk's or shard's segments, with the bytes that each takes; ids are signed.
WIDTHS = {"anchor": 8, "content": 6, "id": 8, "start": 8, "size": 2}
OPENED = "anchor long, id long, start long, size long"


def pack_columns(columns: dict[str, np.ndarray]) -> bytes:
    return b"".join(planes(columns[k].view(np.uint64) if columns[k].dtype == np.int64 else columns[k], w) for k, w in WIDTHS.items())


def unpack_columns(blobs: list[bytes]) -> dict[str, np.ndarray]:
    total = sum(WIDTHS.values())
    out: dict[str, list[np.ndarray]] = {k: [] for k in WIDTHS}
    for blob in blobs:
        n, spot = len(blob) // total, 0
        for k, w in WIDTHS.items():
            out[k].append(from_planes(blob[spot : spot + n * w], w))
            spot += n * w
    found = {k: np.concatenate(v) if v else np.zeros(0, np.uint64) for k, v in out.items()}
    return found | {k: found[k].view(np.int64) for k in ("id", "start", "size")}


def first_of_equal(columns: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(columns by anchor, content, id and start; which rows are the first of their anchor and content)."""
    order = np.lexsort((columns["start"], columns["id"], columns["content"], columns["anchor"]))
    columns = {k: v[order] for k, v in columns.items()}
    a, c = columns["anchor"], columns["content"]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    # rows of one id are one document: its segment at one place is one segment
    same = ~first[1:] & (columns["id"][1:] == columns["id"][:-1]) & (columns["start"][1:] == columns["start"][:-1])
    keep = np.concatenate(([True], ~same)) if len(a) else np.zeros(0, bool)
    return {k: v[keep] for k, v in columns.items()}, first[keep]


def joined_runs(id_: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes covered by (id, start, size), those that touch joined."""
    if not len(id_):
        return id_, start, size
    order = np.lexsort((start, id_))
    id_, start, end = id_[order], start[order], (start + size)[order]
    # an offset for each id keeps the ends of one below the starts of the next
    offset = np.cumsum(np.concatenate(([0], id_[1:] != id_[:-1]))) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + offset)
    new = np.ones(len(id_), bool)
    new[1:] = start[1:] + offset[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(id_)) - 1
    return id_[first], start[first], reach[last] - offset[first] - start[first]


def pack_runs(runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    return np.stack(runs).astype("<i8").tobytes()


FOUND = "bucket long, columns binary, runs binary"


def rows_of(parts: list[dict[str, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``FOUND`` from the columns of one chunk."""
    columns, first = first_of_equal({k: np.concatenate([p[k] for p in parts]) for k in WIDTHS})
    runs = joined_runs(*(columns[k][~first] for k in ("id", "start", "size")))
    columns = {k: v[first] for k, v in columns.items()}
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    ends = [0, *np.searchsorted(columns["anchor"], bounds).tolist(), len(columns["anchor"])]
    full = [(b, pack_columns({k: v[i:j] for k, v in columns.items()})) for b, (i, j) in enumerate(zip(ends, ends[1:])) if i < j]
    shares = zip(*(np.array_split(r, len(full)) for r in runs))
    buckets, blobs, more = zip(*((b, blob, pack_runs(share)) for (b, blob), share in zip(full, shares)))
    yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary()), pa.array(more, pa.binary())], ["bucket", "columns", "runs"])


def find_segments(docs: DataFrame, bits: int, length: int, gram: int, chunk_bytes: int) -> DataFrame:
    """Of every chunk of (id, text), per bucket: the columns of its segments, and some of the runs that are repeated in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, last, data, at in text_slices(batch.column(1), BLOCK):
                for text, start, size, anchor, content in segments(data, at, length, gram):
                    if len(text):
                        parts.append({"anchor": anchor, "content": content, "id": ids[first:last][text], "start": start, "size": size})
                held += len(data)
                if held >= chunk_bytes and parts:
                    yield from rows_of(parts, bits)
                    parts, held = [], 0
        if parts:
            yield from rows_of(parts, bits)

    return docs.mapInArrow(tidy(run), FOUND)


def judge(bucket: pa.Table) -> pa.Table:
    """Of one bucket of anchors: what is repeated as a whole (no anchor), and the open segments with their anchor."""
    columns, first = first_of_equal(unpack_columns([c.as_buffer().to_pybytes() for c in bucket["columns"]]))
    anchor = columns["anchor"]
    kinds, n = np.unique(anchor[first], return_counts=True)
    open_ = first & np.isin(anchor, kinds[n > 1])
    runs = [np.frombuffer(r.as_buffer(), "<i8").reshape(3, -1) for r in bucket["runs"]]
    gone = joined_runs(*(np.concatenate([columns[k][~first], *(r[i] for r in runs)]) for i, k in enumerate(("id", "start", "size"))))
    return pa.table(
        {
            "anchor": pa.concat_arrays([pa.nulls(len(gone[0]), pa.int64()), pa.array(anchor[open_].view(np.int64))]),
            **{k: np.concatenate([g, columns[k][open_]]) for k, g in zip(("id", "start", "size"), gone)},
        }
    )


def cut_out(docs: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """(shard, ids, starts, sizes, bytes) of the segments ``asked`` (anchor, id, start, size), from the texts they lie in."""
    # the columns of a document's segments stay arrays of numbers; a long document has many
    lists = asked.groupBy("id").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("own"))
    met = docs.join(lists, "id").select("id", "text", "own.anchor", "own.start", "own.size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).value_lengths().to_numpy()
            anchor, start, size = (batch.column(k).flatten().to_numpy() for k in (2, 3, 4))
            ids = np.repeat(batch.column(0).to_numpy(), n)
            texts = batch.column(1).cast(pa.large_binary())
            base = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts)]
            data = np.frombuffer(texts.buffers()[2], np.uint8)
            begin = np.repeat(base, n) + start
            shard = (anchor.view(np.uint64) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
                for k in range(0, len(own), 8_000):
                    some = own[k : k + 8_000]
                    spot = np.repeat(begin[some], size[some]) + np.arange(size[some].sum()) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
                    row = [[int(shard[some[0]])], [ids[some].tobytes()], [start[some].tobytes()], [size[some].astype(np.int32).tobytes()], [data[spot].tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), *(pa.array(r, pa.binary()) for r in row[1:])], ["shard", "ids", "starts", "sizes", "bytes"])

    return met.mapInArrow(tidy(run), "shard long, ids binary, starts binary, sizes binary, bytes binary")


def hot_windows(docs: DataFrame, hot: DataFrame, bits: int, length: int) -> DataFrame:
    """Rows of ``FOUND`` for the single windows of the segments ``hot`` (id, start, size): the anchor is a window's own hash."""
    lists = hot.groupBy("id").agg(F.collect_list(F.struct("start", "size")).alias("own"))
    met = docs.join(lists, "id").select("id", "text", "own.start", "own.size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down, letters = powers()
        others = mix64(letters)
        for batch in batches:
            n = batch.column(2).value_lengths().to_numpy()
            start, size = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            ids = np.repeat(batch.column(0).to_numpy(), n)
            texts = batch.column(1).cast(pa.large_binary())
            base = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts)]
            data = np.frombuffer(texts.buffers()[2], np.uint8)
            begin = np.repeat(base, n) + start
            step = BLOCK // (2 * length)
            for k in range(0, len(size), step):
                some = slice(k, k + step)
                sizes, first = size[some], np.cumsum(size[some]) - size[some]
                part = data[np.repeat(begin[some] - first, sizes) + np.arange(sizes.sum())]
                windows = sizes - length + 1
                inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                at = np.repeat(first, windows) + inner
                found = []
                for values in (letters, others):
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[part] * up[: len(part)], dtype=np.uint64)))
                    found.append(mix64((sums[at + length] - sums[at]) * down[at]))
                columns = {"anchor": found[0], "content": found[1] >> np.uint64(16), "id": np.repeat(ids[some], windows)}
                yield from rows_of([columns | {"start": np.repeat(start[some], windows) + inner, "size": np.full(len(at), length)}], bits)

    return met.mapInArrow(tidy(run), FOUND)


def repeated_windows(shard: pa.Table, length: int) -> pa.Table:
    """(id, start, size) of the runs of repeated windows in the segments of one shard."""
    blobs = {k: [b.as_buffer().to_pybytes() for b in shard[k]] for k in ("ids", "starts", "sizes", "bytes")}
    ids, starts = (np.frombuffer(b"".join(blobs[k]), np.int64) for k in ("ids", "starts"))
    sizes = np.frombuffer(b"".join(blobs["sizes"]), np.int32).astype(np.int64)
    ends = np.cumsum(sizes + 1)
    text = np.full(int(ends[-1]) + 1, SEPARATOR, np.uint16)
    inner = np.ones(len(text), bool)
    inner[ends - 1] = inner[-1] = False
    text[inner] = np.frombuffer(b"".join(blobs["bytes"]), np.uint8).astype(np.uint16) + FIRST
    text[-1] = SENTINEL
    found_id, found_start = [], []
    for pos, lcp in sorted_suffixes(text, length):
        deep = lcp >= length
        if not deep.any():
            continue
        member = deep | np.concatenate((deep[1:], [False]))
        segment = np.searchsorted(ends, pos, side="right")
        member &= pos + length < ends[segment]  # else it runs over a separator
        group, pos, segment = np.cumsum(~deep)[member], pos[member], segment[member]
        own, start = ids[segment], starts[segment] + pos - (ends[segment] - 1 - sizes[segment])
        order = np.lexsort((start, own, group))
        group, own, start = group[order], own[order], start[order]
        again = np.zeros(len(order), bool)
        again[1:] = group[1:] == group[:-1]
        # the same window of rows of one id is one window
        leader = np.maximum.accumulate(np.where(~again, np.arange(len(order)), 0))
        again &= (own != own[leader]) | (start != start[leader])
        found_id.append(own[again])
        found_start.append(start[again])
    own, start = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_id, found_start))
    own, start, size = joined_runs(own, start, np.full(len(own), length))
    return pa.table({"id": own, "start": start, "size": size})


ADDED = "n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def take_out(rows: pa.StructArray) -> list[pa.Array]:
    """Of rows (text, start, size): bytes, bytes removed, the runs of removed bytes, and what is left."""
    starts, sizes = rows.field("start"), rows.field("size")
    counts = starts.value_lengths().fill_null(0).to_numpy()
    cut = np.cumsum(counts) - counts
    starts, sizes = starts.flatten().to_numpy(), sizes.flatten().to_numpy()
    n_bytes, n_removed, spans, kept = [], [], [], []
    for first, last, data, at in text_slices(rows.field("text")):
        own = slice(cut[first], cut[last - 1] + counts[last - 1])
        begin = np.repeat(at[:-1], counts[first:last]) + starts[own]
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + sizes[own], -1)
        gone = np.cumsum(change)[:-1] > 0
        left = data[~gone].tobytes()
        lost = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))[at]
        for k in range(last - first):
            a, b = at[k], at[k + 1]
            n_bytes.append(int(b - a))
            n_removed.append(int(lost[k + 1] - lost[k]))
            kept.append(left[a - lost[k] : b - lost[k + 1]])
            edge = np.flatnonzero(np.diff(gone[a:b].view(np.int8), prepend=0, append=0)).tolist() if n_removed[-1] else []
            spans.append([{"start": x, "end": y} for x, y in zip(edge[::2], edge[1::2])])
    return [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.binary())]


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Each row of ``docs`` as ``doc``, with n_bytes, n_removed, ``spans`` (runs of removed bytes) and ``kept`` (the bytes left)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / bucket_bytes))))
    found = find_segments(texts, bits, length, gram, chunk_bytes)
    judged = staged(found.groupBy("bucket").applyInArrow(tidy_group(judge), OPENED), "judged-segments")
    asked = judged.where("anchor IS NOT NULL")
    # an anchor with more than a shard's bytes is not sorted in one task: its windows are dealt by their own hashes
    own = asked.groupBy("anchor").agg(F.sum("size").alias("bytes"), F.sum(F.col("size") - (length - 1)).alias("windows"))
    hot = staged(own.where(F.col("bytes") > shard_bytes), "hot-anchors")
    n_windows = hot.agg(F.sum("windows")).first()[0] or 0
    whole = judged.where("anchor IS NULL").select("id", "start", "size")
    if n_windows:
        more = max(0, math.ceil(math.log2(max(1, n_windows * sum(WIDTHS.values()) / bucket_bytes))))
        split = hot_windows(texts, asked.join(hot, "anchor", "left_semi"), more, length)
        whole = whole.union(split.groupBy("bucket").applyInArrow(tidy_group(judge), OPENED).where("anchor IS NULL").select("id", "start", "size"))
        asked = asked.join(hot, "anchor", "left_anti").select(*asked.columns)
    volume = asked.agg(F.sum("size")).first()[0] or 0
    shards = max(1, math.ceil(volume / shard_bytes))

    def windows(shard: pa.Table) -> pa.Table:
        return repeated_windows(shard, length)

    partly = cut_out(texts, asked, shards).groupBy("shard").applyInArrow(tidy_group(windows), "id long, start long, size long")
    spans = whole.union(partly).groupBy("id").agg(F.collect_list(F.struct("start", "size")).alias("own"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(spans, "id", "left").select("row", "text", F.col("own.start").alias("start"), F.col("own.size").alias("size"))

    def run(batches: Iterator[pa.StructArray]) -> Iterator[tuple[pa.StructArray, list[pa.Array]]]:
        for batch in batches:
            yield batch, take_out(batch)

    done = mapped(rows, ADDED, run)
    return done.select(F.col("doc.row").alias("doc"), "n_bytes", "n_removed", "spans", "kept")
