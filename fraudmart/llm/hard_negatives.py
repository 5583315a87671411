"""Hard-negative mining with an inverted multi-index.

Components become integers ``floor(256 * x)`` and a score is an exact integer inner product.
Each half of a vector has its own codebook (k-means of a bounded sample); a pair of codes is a
cell, and every row is posted in its cell.  No row of cell (i, j) can have a greater score with
anchor ``a`` than

    a1 . C1[i] + |a1| * radius1[i]  +  a2 . C2[j] + |a2| * radius2[j],

where a radius is the largest distance of any row (of the whole table) from its code's centre.
An anchor visits cells in falling order of that bound: its two lists of half bounds are sorted and a
heap walks their sums.  A window asks for the best ``k`` rows whose score lies in [low, high]
and is certified when the next bound is below its ``k``-th score (or below ``low``); an anchor stops
when all its windows are.  So results are exact, and the index decides only how much is read.

The same search runs twice: positives have one window over all scores among rows of the
anchor's label, negatives have one window for each positive among rows of other labels.

Rows are dealt by cell into blocks of about ``BLOCK_ROWS`` (a large cell over several blocks by hash
of the id, small ones together) and anchors into chunks; a task holds one block and one
chunk and answers with at most ``k`` rows a window.  An anchor first asks the block of its
best bound; other blocks are asked only if their bound reaches what that block returned.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no
part, nor do vectors whose length is not the most frequent one (then smaller); of rows that
share an id the least label stands, then the least vector; zero vectors take part and score 0; equal
scores go to the smaller id; with fewer than ``k`` rows all are returned; an anchor without a
positive and an empty table give no rows; further columns are ignored; components so large
that a score might exceed a long are an error.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import staged, tidy, tidy_cogroup

#: Centres of one half's codebook, and rows they are learned from.
CODES, SAMPLE = 16, 8192
BLOCK_ROWS, CHUNK_ROWS = 20_000, 4_000
#: Rows an anchor takes from its heap at once, at first and at most.
FIRST_ROWS, MOST_ROWS = 1024, 8192
ANY = 1 << 62
ROUTED = "anchor long, label int, v array<long>, low array<long>, high array<long>, block int, bound double, home boolean"
FOUND = "anchor long, window int, vec_id long, score long"


def quantized(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, one an id; ``v`` holds longs."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("int").alias("label"), v.alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(finite)
    whole = rows.select("vec_id", F.struct("label", F.transform("v", lambda x: F.floor(x * 256)).alias("v")).alias("row"))
    return whole.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def arithmetic(largest: float) -> type:
    """A type in which inner products of vectors no longer than ``largest`` (norm) are exact."""
    product = largest * largest * (1 + 1e-9)
    if product < 2**24:
        return np.float32
    if product < 2**53:
        return np.float64
    if product < 2**62:
        return np.int64
    raise ValueError(f"vectors of norm {largest:g} in 256ths: their inner products might not fit a long")


def k_means(points: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """At most ``codes`` centres of ``points``."""
    distinct = np.unique(points, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(codes, len(distinct))).astype(int)]
    for _ in range(rounds):
        nearest = nearest_centre(points, centres)[0]
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of every point."""
    code = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
    return code, np.sqrt(((points - centres[code]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Index:
    """Codebooks and radii of both halves, and the blocks of every cell: at most ``CODES`` ** 2 cells."""

    cut: int
    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    first_block: np.ndarray  # by cell; a cell without rows has no blocks
    blocks: np.ndarray
    dtype: type

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.cut], vectors[:, self.cut :]

    def half_bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For both halves, the most that a row of each code can add to each vector's score."""
        bounds = []
        for half, centres, radii in zip(self.halves(vectors), self.centres, self.radii):
            most = half @ centres.T + np.linalg.norm(half, axis=1)[:, None] * radii
            bounds.append(most + 1e-9 * np.abs(most) + 1e-6)  # rounding
        return bounds[0], bounds[1]


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values, dtype).reshape(len(column), -1)


def build(rows: DataFrame, codes: int, sample: int, block_rows: int) -> tuple[DataFrame, Index] | None:
    """(rows with their cell, the index); None without rows."""
    measured = rows.select(F.size("v").alias("n"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x).alias("square"))
    length = measured.groupBy("n").agg(F.count("*").alias("rows"), F.max("square").alias("square")).orderBy(F.desc("rows"), "n").first()
    if length is None:
        return None
    rows = rows.where(F.size("v") == length.n)
    cut = length.n // 2
    some = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    points = np.array([r.v for r in some], np.float64).reshape(len(some), length.n)
    centres = (k_means(points[:, :cut], codes), k_means(points[:, cut:], codes))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(2), np.float64)
            code1, far1 = nearest_centre(vectors[:, :cut], centres[0])
            code2, far2 = nearest_centre(vectors[:, cut:], centres[1])
            made = [pa.array(x, t) for x, t in ((code1, pa.int32()), (code2, pa.int32()), (far1, pa.float64()), (far2, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], ["vec_id", "label", "v", "code1", "code2", "far1", "far2"])

    schema = "vec_id long, label int, v array<long>, code1 int, code2 int, far1 double, far2 double"
    coded = staged(rows.mapInArrow(tidy(encode), schema), "negatives-rows")
    cells = coded.groupBy("code1", "code2").agg(F.count("*").alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2")).collect()
    radii = (np.zeros(len(centres[0])), np.zeros(len(centres[1])))
    first_block = np.zeros(len(centres[0]) * len(centres[1]), np.int32)
    blocks = np.zeros_like(first_block)
    at = held = 0
    for cell in sorted(cells):
        radii[0][cell.code1] = max(radii[0][cell.code1], cell.far1)
        radii[1][cell.code2] = max(radii[1][cell.code2], cell.far2)
        if held and held + cell.n > block_rows:
            at, held = at + 1, 0
        k = cell.code1 * len(centres[1]) + cell.code2
        first_block[k], blocks[k] = at, math.ceil(cell.n / block_rows)
        at, held = (at, held + cell.n) if blocks[k] == 1 else (at + blocks[k], 0)
    return coded, Index(cut, centres, radii, first_block, blocks, arithmetic(math.sqrt(length.square or 0.0)))


def in_blocks(coded: DataFrame, index: Index) -> DataFrame:
    """The coded rows with their block."""
    spark, codes2 = coded.sparkSession, len(index.centres[1])
    cells = [(k // codes2, k % codes2, int(index.first_block[k]), int(n)) for k, n in enumerate(index.blocks) if n]
    known = spark.createDataFrame(cells, "code1 int, code2 int, first_block int, blocks int")
    block = F.col("first_block") + F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long")).cast("int")
    return coded.join(F.broadcast(known), ["code1", "code2"]).select("vec_id", "label", "v", "code1", "code2", block.alias("block"))


# -- routing -------------------------------------------------------------


def route(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
    """Each anchor (anchor, label, v, low, high) once for every block that its lowest window may need."""
    vectors = matrix(batch.column("v"), np.float64)
    one, two = index.half_bounds(vectors)
    cells = np.flatnonzero(index.blocks)
    bounds = (one[:, :, None] + two[:, None, :]).reshape(len(vectors), -1)[:, cells]
    # bound of a block: the largest of its cells'; cells of one block stand together
    starts = np.flatnonzero(np.diff(index.first_block[cells], prepend=-1))
    runs = np.maximum.reduceat(bounds, starts, axis=1)
    first, n = index.first_block[cells][starts], index.blocks[cells][starts]
    run = np.repeat(np.arange(len(starts)), n)
    block = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    home = block[np.searchsorted(run, runs.argmax(axis=1))]
    least = np.array([min(low) for low in batch.column("low").to_pylist()], np.float64)
    who, at = np.nonzero(runs[:, run] >= least[:, None])
    asked = batch.take(pa.array(who))
    made = [pa.array(block[at], pa.int32()), pa.array(runs[who, run[at]]), pa.array(block[at] == home[who])]
    return pa.RecordBatch.from_arrays([*asked.columns, *made], [*asked.schema.names, "block", "bound", "home"])


# -- one block, one chunk of anchors -----------------------------------------


class Walk:
    """One anchor's way through the cells of a block, in falling order of bounds."""

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.rows, self.columns = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        self.one, self.two = one[self.rows].tolist(), two[self.columns].tolist()
        self.heap = [(-(self.one[0] + self.two[0]), 0, 0)]

    def bound(self) -> float:
        """What no cell still to come exceeds."""
        return -self.heap[0][0] if self.heap else -math.inf

    def step(self) -> tuple[int, int]:
        """The next cell: places of its codes."""
        _, i, j = heapq.heappop(self.heap)
        if j + 1 < len(self.two):
            heapq.heappush(self.heap, (-(self.one[i] + self.two[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(self.one):
            heapq.heappush(self.heap, (-(self.one[i + 1] + self.two[0]), i + 1, 0))
        return self.rows[i], self.columns[j]


class Windows:
    """The best ``k`` of an anchor's windows so far: (-score, id) each."""

    def __init__(self, low: list[int], high: list[int], k: int):
        self.low, self.high, self.k = low, high, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in low]

    def need(self) -> int:
        """The least score that could still change a window."""
        return min(max(low, -best[-1][0]) if len(best) == self.k else low for low, best in zip(self.low, self.best))

    def offer(self, scores: list[int], ids: list[int]) -> None:
        rows = sorted((-s, i) for s, i in zip(scores, ids))
        for w, (low, high) in enumerate(zip(self.low, self.high)):
            fresh = [r for r in rows if low <= -r[0] <= high][: self.k]
            if fresh:
                self.best[w] = sorted(self.best[w] + fresh)[: self.k]


def search_block(rows: pa.Table, asks: pa.Table, index: Index, same: bool, k: int) -> pa.Table:
    """The best ``k`` rows of one block for every window of its asking anchors."""
    out: list[tuple[int, int, int, int]] = []
    if len(rows) and len(asks):
        codes = rows["code1"].to_numpy().astype(np.int64) * len(index.centres[1]) + rows["code2"].to_numpy()
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        ids, labels = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order]
        vectors = matrix(rows["v"], index.dtype)[order]
        cells, starts = np.unique(codes, return_index=True)
        ends = np.append(starts[1:], len(codes))
        some1, some2 = np.unique(cells // len(index.centres[1])), np.unique(cells % len(index.centres[1]))
        posted = np.full((len(some1), len(some2)), -1)
        posted[np.searchsorted(some1, cells // len(index.centres[1])), np.searchsorted(some2, cells % len(index.centres[1]))] = np.arange(len(cells))

        own, own_label = asks["anchor"].to_numpy(), asks["label"].to_numpy()
        asked = matrix(asks["v"], index.dtype)
        one, two = index.half_bounds(asked.astype(np.float64))
        walks = [Walk(a[some1], b[some2]) for a, b in zip(one, two)]
        windows = [Windows(low, high, k) for low, high in zip(asks["low"].to_pylist(), asks["high"].to_pylist())]
        most = np.array([max(w.high) for w in windows])
        need = np.array([w.need() for w in windows])
        live, share = list(range(len(own))), FIRST_ROWS
        while live:
            visits: dict[int, list[int]] = defaultdict(list)
            going = []
            for a in live:
                walk, taken = walks[a], 0
                while taken < share and walk.bound() >= need[a]:
                    cell = posted[walk.step()]
                    if cell >= 0:
                        visits[cell].append(a)
                        taken += ends[cell] - starts[cell]
                if taken:
                    going.append(a)
            met: dict[int, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
            for cell, who in visits.items():
                part = slice(starts[cell], ends[cell])
                scores = vectors[part] @ asked[who].T
                wanted = ((labels[part, None] == own_label[who]) == same) & (ids[part, None] != own[who])
                wanted &= (scores >= need[who]) & (scores <= most[who])
                row, column = np.nonzero(wanted)
                for a, score, i in zip(column.tolist(), scores[row, column].tolist(), ids[part][row].tolist()):
                    met[who[a]][0].append(int(score))
                    met[who[a]][1].append(i)
            for a, (scores_met, ids_met) in met.items():
                windows[a].offer(scores_met, ids_met)
                need[a] = windows[a].need()
            live, share = going, min(2 * share, MOST_ROWS)
        for a, held in enumerate(windows):
            out += [(int(own[a]), w, i, -minus) for w, best in enumerate(held.best) for minus, i in best]
    columns = list(zip(*out)) if out else [[], [], [], []]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "window", "vec_id", "score"])


# -- the search ------------------------------------------------------------


def search(blocks: DataFrame, asks: DataFrame, shared: Broadcast, same: bool, k: int, chunk_rows: int) -> DataFrame:
    """(anchor, window, vec_id, score, rank): the best ``k`` rows of every window of ``asks`` (anchor, label, v, low, high)."""

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield route(batch, shared.value)

    def answer(rows: pa.Table, asked: pa.Table) -> pa.Table:
        return search_block(rows, asked, shared.value, same, k)

    routed = staged(asks.select("anchor", "label", "v", "low", "high").mapInArrow(tidy(routes), ROUTED), "negatives-asks")

    def wave(some: DataFrame) -> DataFrame:
        # a block is asked by chunks of bounded size, and read once for each that asks
        asked = some.groupBy("block").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
        dealt = some.join(asked, "block").withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.col("chunks").cast("long")).cast("int"))
        read = blocks.join(asked, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        keys = ("block", "chunk")
        return read.groupBy(*keys).cogroup(dealt.drop("chunks").groupBy(*keys)).applyInArrow(tidy_cogroup(answer), FOUND)

    first = staged(wave(routed.where("home")), "negatives-home")
    reached = first.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == k)
    raised = reached.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    others = routed.where("NOT home").join(raised, "anchor", "left")
    low = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.element_at("reached", w), x)))
    others = others.withColumn("low", low).drop("reached").where(F.col("bound") >= F.array_min("low"))
    found = first.unionByName(wave(others)) if shared.value.blocks.sum() > 1 else first
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    codes: int = CODES,
    sample: int = SAMPLE,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where ``is_anchor`` (of vec_id) holds.  A negative of a positive has
    a score of ``low_percent`` to ``high_percent`` of the positive's.
    """
    spark = vectors.sparkSession
    built = build(quantized(vectors, id_col, vector_col, label), codes, sample, block_rows)
    if built is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    coded, index = built
    shared = spark.sparkContext.broadcast(index)  # codes ** 2 cells and 2 * codes centres
    blocks = in_blocks(coded, index)
    anchors = coded.where(is_anchor).select(F.col("vec_id").alias("anchor"), "label", "v")

    any_score = F.array(F.lit(-ANY)).alias("low"), F.array(F.lit(ANY)).alias("high")
    near = staged(search(blocks, anchors.select("*", *any_score), shared, True, positives, chunk_rows), "negatives-positives")
    score = F.col("score").cast("long")
    limits = near.select(
        "anchor",
        (F.col("rank") - 1).alias("window"),
        (-F.expr(f"(-{low_percent} * score - pmod(-{low_percent} * score, 100L)) div 100L")).alias("low"),
        F.expr(f"({high_percent} * score - pmod({high_percent} * score, 100L)) div 100L").alias("high"),
        F.col("vec_id").alias("positive_id"),
        score.alias("positive_score"),
    )
    by_rank = F.array_sort(F.collect_list(F.struct("window", "low", "high")))
    asked = limits.groupBy("anchor").agg(by_rank.alias("w"))  # at most ``positives`` an anchor
    asks = anchors.join(asked, "anchor").select("anchor", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    found = search(blocks, asks, shared, False, negatives, chunk_rows)
    return found.join(limits.drop("low", "high"), ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
