"""MinHash near-dedup: a chosen-path set similarity join.

A document's set holds the hashes of its distinct word shingles.  Equal sets are
one class from the start (hashed by their sum and xor, collapsed by aggregation).
Every class has a signature of ``COORDINATES`` minwise hashes.  In each of several
trees (``Threshold.trees``) a document follows, from the root, the coordinates that a node
selects (``BRANCHING`` on average, drawn from the node's own path), into the child named by
its minwise value there.  Documents of equal path share a node; similar ones
share a node of some tree with a probability that grows with every tree.  All trees draw
from the same coordinates, so a pair that agrees in few of them is missed by many trees at
once; the number of trees counts that in.

1. Stars: in the nodes two levels down, every class is paired with one drawn for the node;
   pairs that are similar by signature are confirmed on full sets.  Confirmed links
   make components, so a large group of near copies is joined with one pair a member.
2. Nodes that still mix components are followed.  Small ones (``SMALL``) are compared
   exhaustively across components, and so are those with few rows outside their
   largest component, whose rows are dealt into blocks; other nodes branch again.
   What is still large at ``DEPTH`` is compared in pairs of blocks, none left out.
3. Pairs found are confirmed on full sets, in blocks of classes: a class that has many likely
   partners meets a whole block at once, so pairs are never rows.  Components are joined once more.

Links are confirmed by ``100 * intersection >= percent * union`` on the sets of all
shingles.  Links and components are DataFrames from end to end.

Defined cases: a text that is null or has no words has an empty set and is linked with
nothing; one of fewer words than a shingle is one shingle of all its words; rows with
a null id are never linked and kept; rows of one id are one document; an empty
table gives no rows; input columns stay in ``doc``, so names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import discard, drop_shuffles, mix64, staged, text_slices, tidy, tidy_cogroup, word_hashes, words_in

COORDINATES = 128
#: Greatest share of pairs at the threshold that share no node at ``DEPTH`` in any tree; decides how many trees there are.
MISSED = 3e-4
#: More trees than these are refused: the threshold is too low for ``BRANCHING``.
MOST_TREES = 1024
#: Trees whose nodes make stars.
STAR_TREES = 5
#: Coordinates that a node selects on average; at least one.
BRANCHING = 1.3
SMALL, DEPTH = 1024, 14
#: Standard errors below the threshold at which a pair's signatures rule it out.
ERRORS = 4.0
#: Ids that are broadcast to pick the documents whose sets are needed; more are joined by a shuffle.
BROADCAST_IDS = 300_000
#: Classes whose full sets a task holds together.
BLOCK_IDS = 4000
#: Pairs that a task holds before it passes them on.
HELD_PAIRS = 800_000

IS_WORD = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
MULTIPLIERS = np.random.default_rng(11).integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets: texts + 1): the sorted distinct shingles of each text."""
    data = LOWERED[data]
    starts, ends, row = words_in(data, IS_WORD[data], at)
    hashes = word_hashes(data, starts, ends)
    n_words = np.bincount(row, minlength=len(at) - 1)
    first = np.cumsum(n_words) - n_words
    n_shingles = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    spot = np.arange(n_shingles.sum()) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + np.repeat(first, n_shingles)
    words_here = np.repeat(np.minimum(n_words, size), n_shingles)
    value = words_here.astype(np.uint64)
    for k in range(size):
        inside = words_here > k
        value[inside] = mix64(value[inside] * np.uint64(0x9E3779B97F4A7C15) + hashes[spot[inside] + k])
    bounds = np.concatenate(([0], np.cumsum(n_shingles)))
    sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return (np.concatenate(sets) if sets else value), np.concatenate(([0], np.cumsum([len(s) for s in sets], dtype=np.int64)))


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minwise hashes (texts x coordinates, 32 bits); of an empty set all ones."""
    out = np.full((len(offsets) - 1, COORDINATES), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        for k, multiplier in enumerate(MULTIPLIERS):
            out[filled, k] = np.minimum.reduceat((sets * multiplier) >> np.uint64(32), offsets[filled])
    return out


def nibbles(signature: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, two coordinates a byte."""
    low = (mix64(signature) & np.uint64(15)).astype(np.uint8)
    return low[:, ::2] | low[:, 1::2] << 4


def as_rows(values: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(values)], pa.binary())


def as_matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 1), dtype)


def describe(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, n, a, b, signature) of every row: size of its set, the set's hashes, its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, _, data, at in text_slices(batch.column(1)):
                sets, offsets = shingle_sets(data, at, size)
                filled = np.flatnonzero(np.diff(offsets))
                a, b = np.zeros(len(at) - 1, np.uint64), np.zeros(len(at) - 1, np.uint64)
                if len(filled):
                    a[filled] = np.add.reduceat(sets, offsets[filled])
                    b[filled] = np.bitwise_xor.reduceat(mix64(sets + np.uint64(1)), offsets[filled])
                parts.append((np.diff(offsets), a.view(np.int64), b.view(np.int64), signatures(sets, offsets)))
            n, a, b, signature = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3 + (np.zeros((0, 1), np.uint32),)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b), as_rows(signature)], ["id", "n", "a", "b", "signature"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), "id long, n long, a long, b long, signature binary"
    )


def draw(node: np.ndarray, what: int) -> np.ndarray:
    return mix64(node ^ mix64(np.array([what], np.uint64)))


def children(node: np.ndarray, signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their child nodes): a node's path decides the coordinates, the row's minwise values the children."""
    first = (draw(node, 1) % np.uint64(COORDINATES)).astype(np.int64)
    step = (draw(node, 2) % np.uint64(COORDINATES - 1)).astype(np.int64) + 1
    more = np.flatnonzero(draw(node, 3) < np.uint64(int((BRANCHING - 1) * 2**64)))
    row = np.concatenate((np.arange(len(node)), more))
    chosen = np.concatenate((first, (first[more] + step[more]) % COORDINATES))
    value = signature[row, chosen].astype(np.uint64) | chosen.astype(np.uint64) << np.uint64(32)
    return row, mix64(node[row] * np.uint64(0x9E3779B97F4A7C15) + mix64(value))


def branch(rows: DataFrame, trees: int | None = None) -> DataFrame:
    """(node, id) one level below ``rows`` (node, id, signature), or two below the roots of ``trees`` for (id, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, signature = batch.column(0).to_numpy(), as_matrix(batch.column(1), "<u4")
            for tree in range(trees or 1):
                node = draw(np.full(len(ids), tree, np.uint64), 0) if trees else batch.column(2).to_numpy().view(np.uint64)
                row, child = children(node, signature)
                if trees:  # one coordinate says little: a passage that many share decides it often
                    below, child = children(child, signature[row])
                    row = row[below]
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[row])], ["node", "id"])

    columns = ["id", "signature"] if trees else ["id", "signature", "node"]
    return rows.select(*columns).mapInArrow(tidy(run), "node long, id long")


@dataclass(frozen=True)
class Threshold:
    percent: int

    def least_same(self) -> float:
        """Equal nibbles, of all coordinates, that a pair at the threshold almost surely reaches."""
        p = self.percent / 100 + (1 - self.percent / 100) / 16
        return COORDINATES * p - ERRORS * math.sqrt(COORDINATES * p * (1 - p))

    def missed(self, trees: int, depth: int = DEPTH) -> float:
        """Share of pairs at the threshold without a common node at ``depth``: given the coordinates they agree in, trees are independent."""
        share, total = self.percent / 100, 0.0
        for same in range(COORDINATES + 1):
            met = 1.0  # chance of a common node so many levels down
            for _ in range(depth):
                below = same / COORDINATES * met
                met = (2 - BRANCHING) * below + (BRANCHING - 1) * (1 - (1 - below) ** 2)
            total += math.comb(COORDINATES, same) * share**same * (1 - share) ** (COORDINATES - same) * (1 - met) ** trees
        return total

    def trees(self, depth: int = DEPTH) -> int:
        """The fewest trees that miss at most ``MISSED`` of the pairs at the threshold."""
        if self.missed(MOST_TREES, depth) > MISSED:
            raise ValueError(f"{self.percent} percent needs more than {MOST_TREES} trees")
        return next(n for n in range(1, MOST_TREES + 1) if self.missed(n, depth) <= MISSED)


def alike(x: np.ndarray, y: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Whether rows of 64-bit words of ``nibbles`` agree in enough of them."""
    other = x ^ y
    other |= other >> np.uint64(1)
    other |= other >> np.uint64(2)  # a nibble's lowest bit now tells whether it has any
    other &= np.uint64(0x1111111111111111)
    return COORDINATES - np.bitwise_count(other).sum(axis=1, dtype=np.int64) >= threshold.least_same()


def likely(pairs: DataFrame, lite: DataFrame, threshold: Threshold) -> DataFrame:
    """``pairs`` (x, y) whose signatures don't rule them out."""
    both = pairs.join(lite.select(F.col("id").alias("x"), F.col("lite").alias("lx")), "x").join(
        lite.select(F.col("id").alias("y"), F.col("lite").alias("ly")), "y"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = alike(as_matrix(batch.column(2), "<u8"), as_matrix(batch.column(3), "<u8"), threshold)
            yield batch.select([0, 1]).filter(pa.array(good))

    return both.select("x", "y", "lx", "ly").mapInArrow(tidy(run), "x long, y long")


#: A class, a block of classes, and those of the block that it may be linked to, with their components.
ASKED = "x long, block long, others array<struct<y: long, comp: long>>"
OTHERS = pa.list_(pa.struct([("y", pa.int64()), ("comp", pa.int64())]))


def asked_rows(x: np.ndarray, y: np.ndarray, comp: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    """Rows of ``ASKED`` for pairs (x, y), ``comp`` and ``block`` being y's."""
    order = np.lexsort((y, block, x))
    x, y, comp, block = x[order], y[order], comp[order], block[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    others = pa.StructArray.from_arrays([pa.array(y), pa.array(comp)], ["y", "comp"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(x)).astype(np.int32)), others)
    return pa.RecordBatch.from_arrays([pa.array(x[first]), pa.array(block[first]), lists.cast(OTHERS)], ["x", "block", "others"])


def ask_pairs(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """``ASKED`` for pairs (x, y) of classes that have no components yet."""
    placed = pairs.join(places.select(F.col("id").alias("y"), "block"), "y")
    return placed.groupBy("x", "block").agg(F.collect_list(F.struct("y", F.col("y").alias("comp"))).alias("others"))


def in_places(classes: DataFrame, blocks: int) -> DataFrame:
    """(id, comp, block) of (id, comp): a component's members share a block, a large component has several."""
    sizes = classes.groupBy("comp").agg(F.count("*").alias("size")).where("size > 1")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("size", F.lit(1)) / BLOCK_IDS))
    return classes.join(sizes, "comp", "left").select("id", "comp", F.pmod(F.xxhash64("comp", part), F.lit(blocks)).alias("block"))


def compare_nodes(rows: DataFrame, threshold: Threshold) -> DataFrame:
    """``ASKED`` for the likely pairs across components inside each node of ``rows`` (node, id, comp, block, lite).

    Rows come sorted by node; a node cut by the end of a batch waits for the next.
    """

    def asked(i: list[np.ndarray], j: list[np.ndarray], ids: np.ndarray, comp: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
        i, j = np.concatenate(i), np.concatenate(j)
        # the one of the smaller component asks, so that few rows hold the pairs with a large one
        _, kind, members = np.unique(comp, return_inverse=True, return_counts=True)
        partners = np.bincount(np.concatenate((i, j)), minlength=len(ids))
        mine, other = members[kind[i]], members[kind[j]]
        swap = (mine > other) | ((mine == other) & (partners[i] < partners[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return asked_rows(ids[i], ids[j], comp[j], block[j])

    def pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, ids, comp, block = (table.column(k).to_numpy() for k in range(4))
        lite = as_matrix(table.column(4).combine_chunks(), "<u8")
        one, two, held = [], [], 0
        left = np.arange(len(node))
        for gap in range(1, len(node)):
            left = left[left + gap < len(node)]
            left = left[node[left] == node[left + gap]]
            if not len(left):
                break
            i = left[comp[left] != comp[left + gap]]
            for first in range(0, len(i), 1 << 15):
                part = i[first : first + (1 << 15)]
                part = part[alike(lite[part], lite[part + gap], threshold)]
                one.append(part)
                two.append(part + gap)
                held += len(part)
            if held > HELD_PAIRS:
                yield asked(one, two, ids, comp, block)
                one, two, held = [], [], 0
        if held:
            yield asked(one, two, ids, comp, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            node = batch.column(0).to_numpy()
            last = np.flatnonzero(node != node[-1]) if len(node) else []
            if len(last):
                cut = int(last[-1]) + 1
                yield from pairs_of(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = [batch.slice(cut)]
            elif len(node):
                if waiting and waiting[0].column(0)[0].as_py() != node[0]:
                    yield from pairs_of(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(batch)
        if waiting:
            yield from pairs_of(pa.Table.from_batches(waiting))

    dealt = rows.select("node", "id", "comp", "block", "lite").repartition("node").sortWithinPartitions("node")
    found = dealt.mapInArrow(tidy(run), ASKED).groupBy("x", "block")
    return found.agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))


def ids_asked(asked: DataFrame) -> DataFrame:
    """(id) of all classes in ``asked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.concatenate((batch.column(0).to_numpy(), batch.column(1).flatten().field("y").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(both))], ["id"])

    return asked.select("x", "others").mapInArrow(tidy(run), "id long").distinct()


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, block, shingles) of the documents in ``ids`` (id, block): 48 bits of each hash, sorted."""
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for _, _, data, at in text_slices(batch.column(2)):
                sets, offsets = shingle_sets(data, at, size)
                tops = sets.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
                values += [tops[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.binary())], ["id", "block", "shingles"])

    met = texts.join(F.broadcast(ids) if few else ids, "id").select("id", "block", "text")
    return met.mapInArrow(tidy(run), "id long, block long, shingles binary")


def unpack(shingles: pa.Scalar) -> np.ndarray:
    data = shingles.as_buffer()
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def confirm_block(sets: pa.Table, asked: pa.Table, percent: int) -> pa.Table:
    """Links (x, y) of one block: each x of ``asked`` against its likely partners, one link for each of their components."""
    own = sets["shingles"].combine_chunks()
    places: dict[int, list[int]] = {}
    for place, id_ in enumerate(sets["id"].to_pylist()):
        places.setdefault(id_, []).append(place)
    links: set[tuple[int, int]] = set()
    for x, others, shingles in zip(asked["x"].to_pylist(), asked["others"], asked["mine"]):
        ys, comps = (others.values.field(k).to_pylist() for k in ("y", "comp"))
        rows = [(y, c, place) for y, c in zip(ys, comps) for place in places.get(y, ())]
        if not rows:
            continue
        mine, them = unpack(shingles), [unpack(own[place]) for _, _, place in rows]
        sizes = np.array([len(t) for t in them])
        every = np.concatenate(them)
        same = mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every
        common = np.add.reduceat(same.astype(np.int64), np.cumsum(sizes) - sizes)
        linked: set[int] = set()
        for k in np.flatnonzero(100 * common >= percent * (len(mine) + sizes - common)):
            y, comp, _ = rows[k]
            if comp not in linked:
                linked.add(comp)
                links.add((x, y))
    x, y = zip(*links) if links else ((), ())
    return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})


def confirmed(asked: DataFrame, docs: DataFrame, places: DataFrame, id_col: str, text_col: str, size: int, threshold: Threshold) -> DataFrame:
    """Links (x, y) that full sets confirm: all that connect an x of ``asked`` with a component of its partners in a block.

    A block's askers carry their own sets, so they are dealt into shares of at most about ``BLOCK_IDS``, each of which
    meets the block's sets.
    """
    ids = ids_asked(asked).join(places.select("id", "block"), "id")
    sets = staged(full_sets(docs, ids, id_col, text_col, size), "shingle-sets")
    shares = asked.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_IDS).cast("int").alias("shares")).where("shares > 1")
    share = F.pmod(F.xxhash64("x"), F.coalesce("shares", F.lit(1)).cast("long")).cast("int")
    askers = asked.join(sets.select(F.col("id").alias("x"), F.col("shingles").alias("mine")), "x").join(shares, "block", "left")
    askers = askers.select("x", F.col("block").alias("of_block"), share.alias("of_share"), "others", "mine")
    every = F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)
    met = sets.join(shares, "block", "left").select("id", "block", F.explode(every).alias("share"), "shingles")

    def confirm(own: pa.Table, asking: pa.Table) -> pa.Table:
        return confirm_block(own, asking, threshold.percent)

    found = met.groupBy("block", "share").cogroup(askers.groupBy("of_block", "of_share")).applyInArrow(tidy_cogroup(confirm), "x long, y long")
    links = staged(found, "confirmed")
    discard(sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id that each linked id reaches, by spreading least labels and jumping to labels' labels."""
    links = staged(links.select(F.col("x").alias("u"), F.col("y").alias("v")).union(links.select("y", "x")).distinct(), "links")
    labels = staged(links.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).withColumnRenamed("u", "id"), "labels")
    while True:
        near = links.join(labels, links.v == labels.id).groupBy("u").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.id == near.u).select("id", F.least("label", "near").alias("next"), "label")
        roots = labels.select(F.col("id").alias("root"), F.col("label").alias("root_label"))
        new = lower.join(roots, lower.next == roots.root).select("id", F.least("next", "root_label").alias("label"), F.col("label").alias("before"))
        new = staged(new, "labels")
        changed = not new.where("label <> before").isEmpty()
        discard(labels)
        labels = new.select("id", "label")
        if not changed:
            discard(links)
            return labels.withColumnRenamed("label", "comp")


def near_components(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    trees: int | None = None,
    small: int = SMALL,
    depth: int = DEPTH,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; ``trees`` are as many as the threshold needs."""
    threshold = Threshold(percent)
    trees = trees or threshold.trees(max(depth, DEPTH))
    described = staged(describe(docs, id_col, text_col, size), "described")
    classes = described.where("n > 0 AND id IS NOT NULL").groupBy("a", "b").agg(F.min("id").alias("rep"))
    classes = staged(classes, "classes")
    reps = described.join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").where("n > 0")

    def add_lite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, as_rows(nibbles(as_matrix(batch.column(1), "<u4")))], ["id", "signature", "lite"])

    reps = staged(reps.select("id", "signature").mapInArrow(tidy(add_lite), "id long, signature binary, lite binary"), "signatures")
    lite = reps.select("id", "lite")
    signed, described = described, staged(described.select("id", "n", "a", "b"), "sizes")
    discard(signed)  # signatures are needed once a class only
    blocks = max(1, math.ceil(reps.count() / BLOCK_IDS))

    # 1. stars
    nodes = branch(reps, min(trees, STAR_TREES))
    drawn = F.min(F.struct(F.xxhash64("node", "id"), "id")).getField("id")  # another one in each node
    leaders = nodes.groupBy("node").agg(drawn.alias("leader"), F.count("*").alias("n")).where("n > 1").select("node", "leader")
    leaders = staged(leaders, "leaders")  # read back, so that a hot node's rows can be split in the join
    stars = nodes.join(leaders, "node").where("id <> leader")
    stars = stars.select(F.col("leader").alias("x"), F.col("id").alias("y")).distinct()
    places = in_places(lite.select("id", F.col("id").alias("comp")), blocks)
    stars = staged(ask_pairs(likely(stars, lite, threshold), places), "stars")
    discard(leaders)
    links = confirmed(stars, docs, places, id_col, text_col, size, threshold)
    comp = components(links)
    for done in (stars, links):
        discard(done)
    drop_shuffles(docs.sparkSession)

    # 2. nodes that mix components
    classes_comp = lite.select("id").join(comp, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))
    places = staged(in_places(classes_comp, blocks), "places")
    reps_comp = places.select("id", "comp")
    nodes = branch(reps, trees)
    frontier, compared, level, before = nodes.join(reps_comp, "id"), [], 2, None
    while True:
        mixed = staged(mixed_nodes(frontier), "mixed-nodes")
        frontier = staged(frontier.join(mixed, "node"), "frontier")
        for done in (before, mixed):
            if done is not None:
                discard(done)
        near = frontier.where(F.col("n") <= small).select("node", "id", "comp")
        near = near.union(against_most(frontier.where((F.col("n") > small) & (F.col("n") - F.col("n_most") <= small)), small))
        compared.append(staged(near, "compared"))
        large = frontier.where(F.col("n") - F.col("n_most") > small)
        if large.isEmpty():
            discard(frontier)
            break
        if level == depth:
            compared.append(staged(in_blocks(large, small), "compared"))
            discard(frontier)
            break
        below = branch(large.join(reps.select("id", "signature"), "id"))
        before, frontier, level = frontier, below.join(reps_comp, "id"), level + 1
    drop_shuffles(docs.sparkSession)
    rows = reduce(DataFrame.union, compared).join(lite.join(places.select("id", "block"), "id"), "id")
    asked = staged(compare_nodes(rows, threshold), "asked")
    for done in (*compared, reps):
        discard(done)
    drop_shuffles(docs.sparkSession)

    # 3. all links
    more = confirmed(asked, docs, places, id_col, text_col, size, threshold)
    comp = components(comp.select(F.col("comp").alias("x"), F.col("id").alias("y")).union(more))
    for done in (asked, more, places):
        discard(done)

    member = described.select("id", "n", "a", "b").join(classes, ["a", "b"], "left")
    member = member.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("comp", "rep", "id"))
    return member.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def mixed_nodes(frontier: DataFrame) -> DataFrame:
    """(node, n, most, n_most) of the nodes with more than one component: rows, the largest component and its rows."""
    parts = frontier.groupBy("node", "comp").agg(F.count("*").alias("own"))
    nodes = parts.groupBy("node").agg(F.sum("own").alias("n"), F.max(F.struct("own", "comp")).alias("top"))
    return nodes.select("node", "n", F.col("top.comp").alias("most"), F.col("top.own").alias("n_most")).where("n > n_most")


def against_most(wide: DataFrame, small: int) -> DataFrame:
    """(node, id, comp) with the rows of a node's largest component dealt into blocks, and all others in every block."""
    blocks = F.ceil(F.col("n") / small)
    own = F.sequence(F.lit(0).cast("long"), F.when(F.col("comp") == F.col("most"), F.lit(0).cast("long")).otherwise(blocks - 1))
    dealt = wide.withColumn("k", F.explode(own))
    block = F.when(F.col("comp") == F.col("most"), F.pmod(F.xxhash64("id"), blocks)).otherwise(F.col("k"))
    return dealt.select(F.xxhash64("node", block).alias("node"), "id", "comp")


def in_blocks(large: DataFrame, small: int) -> DataFrame:
    """(node, id, comp) with each node's rows dealt into blocks and a new node for every pair of blocks."""
    blocks = F.ceil(F.col("n") / small)
    dealt = large.withColumn("own", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    node = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(node.alias("node"), "id", "comp")


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document, of the smallest id, of each component."""
    judged = near_components(docs, size, percent, id_col, text_col)
    gone = judged.where(~F.col("kept")).select(F.col("id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
