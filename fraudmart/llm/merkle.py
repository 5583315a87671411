"""Merkle manifest of a table: leaf coordinates by bitmap ranks, levels by keyed slot arrays.

Every row is a leaf.  The leaves of a group ascend by id and form a binary tree whose top is the
group's subroot; the subroots, by group name, form the tree of the root.

*Ranks.*  A group's ids are a bitmap of 64-bit words, of which only those in use exist: tasks
build partial words, which merge by ``bit_or`` into one row (group, word).  A popcount
directory says how many leaves stand before each word; it is summed up in a trie of 20 bits of
the word's number a level, so each sum runs over at most 2^20 rows, whatever the ids look like.
A leaf's place is its word's entry plus the ones before its own bit.  Leaves are not sorted.  Where an id is
there more than once, its word is looked at again: its leaves rank by bit and hash.

*Levels.*  Place ``p`` belongs to slot ``p mod 4096`` of block ``p div 4096`` (2^12).  A block's array is
filled by slot and reduced by 12 levels in one go, and its top is a leaf of the next round; a group's
number of leaves says how many levels are left.  Proofs come from the same arrays on the way down.

Defined cases: a null field is hashed as ``-``; a null group comes first, the others bytewise; a null
id stands where the least long would; repeated ids go by leaf hash and equal rows are equal leaves
that each have their own place; a lone leaf is its group's subroot and a lone subroot the root;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import staged, tidy, tidy_group

#: Levels a block is reduced by at once; its array has 2 ** LEVELS slots.
LEVELS = 12
#: Bits of a word's number in one level of the directory.
TRIE_BITS = 20
#: Nodes a task reduces together.
PART_NODES = 1 << 16
STEPS = "array<struct<left: boolean, hash: string>>"
BLOCKS = "tree string, block long, n int, top binary, nodes binary, ids array<long>, claims binary, claimed array<boolean>"


def field(column: Column) -> Column:
    """``-`` of a null, else its number of bytes, ``:`` and the value as text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    """Hex SHA-256 of the columns' fields."""
    return F.sha2(F.concat(*(field(c) for c in columns)).cast("binary"), 256)


# -- ranks -----------------------------------------------------------------


def directory(words: DataFrame, bits: int = 58) -> DataFrame:
    """``words`` (tree, word of so many bits, rows) with ``before``: the rows of smaller words of the tree."""
    if bits <= TRIE_BITS:
        inner = Window.partitionBy("tree").orderBy("word").rowsBetween(Window.unboundedPreceding, 0)
        return words.withColumn("before", F.sum("rows").over(inner) - F.col("rows"))
    branch = F.shiftright("word", TRIE_BITS)
    branches = words.groupBy("tree", branch.alias("branch")).agg(F.sum("rows").alias("rows"))
    above = directory(branches.withColumnRenamed("branch", "word"), bits - TRIE_BITS)
    above = above.select("tree", F.col("word").alias("branch"), F.col("before").alias("above"))
    inner = Window.partitionBy("tree", "branch").orderBy("word").rowsBetween(Window.unboundedPreceding, 0)
    local = words.withColumn("branch", branch).withColumn("within", F.sum("rows").over(inner) - F.col("rows"))
    return local.join(above, ["tree", "branch"]).withColumn("before", F.col("above") + F.col("within")).drop("branch", "above", "within")


def bitmap(leaves: DataFrame, tree: Column, id_: Column) -> DataFrame:
    """(tree, word, bits, rows): merged words of the ids, and how many leaves they stand for."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), id_.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return leaves.groupBy(tree.alias("tree"), F.shiftright(id_, 6).alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.sum("copies").alias("rows")
    )


def places(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, id, leaf, copies, ...) with ``place``: that of the first copy in its tree."""
    words = directory(bitmap(leaves, F.col("tree"), F.col("id")))
    word, bit = F.shiftright("id", 6), F.col("id").bitwiseAND(F.lit(63).cast("long")).cast("int")
    met = leaves.withColumn("word", word).join(words, ["tree", "word"])
    smaller = F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, CAST(id & 63 AS INT))"))
    plain = F.col("rows") == F.bit_count("bits")
    met = staged(met.withColumn("plain", plain).withColumn("ones", F.bit_count(smaller).cast("long")), "merkle-ranks")
    kept = [*leaves.columns, "place"]
    alone = met.where("plain").withColumn("place", F.col("before") + F.col("ones")).select(*kept)
    # words with a repeated id: rank the leaves of one word by bit, then by the hash's first 56 bits
    fine = F.shiftleft(bit.cast("long"), 56).bitwiseOR(F.conv(F.hex(F.substring("leaf", 1, 7)), 16, 10).cast("long"))
    crowded = met.where("NOT plain").withColumn("fine", fine).withColumn("crowd", F.concat("tree", F.lit("\x00"), F.col("word").cast("string")))
    crowd_words = directory(bitmap(crowded, F.col("crowd"), F.col("fine"))).select(
        F.col("tree").alias("crowd"), F.col("word").alias("fine_word"), F.col("before").alias("fine_before")
    )
    again = crowded.withColumn("fine_word", F.shiftright("fine", 6)).join(crowd_words, ["crowd", "fine_word"])
    # rows of one such word agree in 50 bits of a SHA-256: hardly ever more than one
    close = Window.partitionBy("crowd", "fine_word").orderBy("fine", "leaf").rowsBetween(Window.unboundedPreceding, 0)
    own = F.sum("copies").over(close) - F.col("copies")
    return alone.unionByName(again.withColumn("place", F.col("before") + F.col("fine_before") + own).select(*kept))


# -- levels ----------------------------------------------------------------


def node_hash(*children: bytes) -> bytes:
    """Hex digest of hex digests."""
    return hashlib.sha256(b"".join(children)).hexdigest().encode()


def levels_of(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """``nodes`` and the ``levels`` rows above them; one left alone is hashed on its own."""
    made = [nodes]
    for _ in range(levels):
        made.append([node_hash(*made[-1][k : k + 2]) for k in range(0, len(made[-1]), 2)])
    return made


def levels_left(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one remains."""
    return max(0, nodes - 1).bit_length()


def hexes(blob: bytes) -> list[bytes]:
    text = blob.hex().encode()
    return [text[k : k + 64] for k in range(0, len(text), 64)]


def fill(part: pa.Table, levels: int) -> pa.Table:
    """Blocks of one part of the nodes (tree, block, at, many, total, id, node, claim): arrays filled by slot, and their tops."""
    trees, blocks = part["tree"].to_pylist(), part["block"].to_pylist()
    at, many = part["at"].to_numpy(), part["many"].to_numpy()
    total, ids = part["total"].to_pylist(), part["id"].to_pylist()
    nodes, claims = part["node"].to_pylist(), part["claim"].to_pylist()
    arrays: dict[tuple[str, int], list] = {}
    for k, key in enumerate(zip(trees, blocks)):
        n = min(1 << levels, total[k] - (key[1] << levels))
        slots = arrays.setdefault(key, [None] * n)
        slots[at[k] : at[k] + many[k]] = [k] * many[k]
    out: list[tuple] = []
    for (tree, block), slots in arrays.items():
        if None in slots:
            raise ValueError(f"tree {tree!r}, block {block}: a slot without a leaf")
        blob = b"".join(nodes[k] for k in slots)
        top = levels_of(hexes(blob), min(levels, levels_left(total[slots[0]])))[-1][0]
        claimed = [claims[k] is not None for k in slots]
        out.append((tree, block, len(slots), bytes.fromhex(top.decode()), blob, [ids[k] for k in slots], b"".join(claims[k] for k in slots if claims[k]), claimed))
    types = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.bool_()))
    columns = list(zip(*out)) if out else [[]] * len(types)
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def blocks_of(nodes: DataFrame, n_nodes: int, levels: int, name: str) -> DataFrame:
    """Blocks (``BLOCKS``) of ``nodes`` (tree, place, copies, total, id, node, claim), each node there ``copies`` times."""
    size = 1 << levels
    first, last = F.shiftright("place", levels), F.shiftright(F.col("place") + F.col("copies") - 1, levels)
    # copies that reach into further blocks are one row in each
    cut = nodes.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("place"), F.col("block") * size)
    end = F.least(F.col("place") + F.col("copies"), (F.col("block") + 1) * size)
    parts = max(1, -(-n_nodes // PART_NODES))
    dealt = cut.select(
        F.pmod(F.xxhash64("tree", "block"), F.lit(parts)).alias("part"),
        "tree",
        "block",
        (start - F.col("block") * size).cast("int").alias("at"),
        (end - start).cast("int").alias("many"),
        "total",
        "id",
        "node",
        "claim",
    )

    def filled(part: pa.Table) -> pa.Table:
        return fill(part, levels)

    return staged(dealt.groupBy("part").applyInArrow(tidy_group(filled), BLOCKS), name)


def climb(nodes: DataFrame, most: int, n_nodes: int, levels: int, name: str) -> list[DataFrame]:
    """Blocks of every round, from the nodes up to one block a tree; ``most``: nodes of the largest tree, ``n_nodes``: of all."""
    rounds = []
    while True:
        blocks = blocks_of(nodes, n_nodes, levels, f"{name}-{len(rounds)}")
        rounds.append(blocks)
        if most <= 1 << levels:
            return rounds
        most, n_nodes = -(-most // (1 << levels)), blocks.count()
        trees = nodes.groupBy("tree").agg(F.max("total").alias("total"))
        above = F.ceil(F.col("total") / (1 << levels)).cast("long").alias("total")
        none = F.lit(None)
        nodes = blocks.join(trees, "tree").select(
            "tree",
            F.col("block").alias("place"),
            F.lit(1).cast("long").alias("copies"),
            above,
            none.cast("long").alias("id"),
            F.col("top").alias("node"),
            none.cast("binary").alias("claim"),
        )


def proofs_in(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    """Nodes of blocks (with ``total``, ``upper``, subroot and root) with the steps to the root, bottom up."""
    for batch in batches:
        for row in batch.to_pylist():
            nodes = hexes(row["nodes"])
            n = len(nodes)
            levels = min(at_once, levels_left(row["total"]))
            place = np.arange(n)
            upper = [(s["left"], s["hash"]) for s in row["upper"]]
            width = levels + len(upper)
            hashes, left = np.zeros((n, width), "S64"), np.zeros((n, width), bool)
            for k, level in enumerate(levels_of(nodes, levels)[:-1]):
                other = (place >> k) ^ 1
                known = np.array([*level, b""], "S64")
                hashes[:, k] = known[np.minimum(other, len(level))]
                left[:, k] = (place >> k) & 1
            for k, (is_left, other) in enumerate(upper, levels):
                hashes[:, k], left[:, k] = (other or "").encode(), bool(is_left)
            alone = (hashes == b"").ravel()
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
            text = pa.StringArray.from_buffers(
                n * width, pa.py_buffer(np.arange(n * width + 1, dtype=np.int32) * 64), pa.py_buffer(hashes.tobytes()), pa.py_buffer(np.packbits(~alone, bitorder="little").tobytes())
            )
            steps = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(left.ravel()), text], ["left", "hash"]))
            claims = iter(hexes(row["claims"]))
            made = {
                "tree": pa.array([row["tree"]] * n, pa.string()),
                "place": pa.array((row["block"] << at_once) + place),
                "id": pa.array(row["ids"], pa.int64()),
                "node": pa.array([x.decode() for x in nodes], pa.string()),
                "claim": pa.array([next(claims).decode() if c else None for c in row["claimed"]], pa.string()),
                "steps": steps,
                "subroot": pa.array([row["subroot"]] * n, pa.string()),
                "root": pa.array([row["root"]] * n, pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


PROOFS = f"tree string, place long, id long, node string, claim string, steps {STEPS}, subroot string, root string"


def descend(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Nodes of the lowest round with the steps up to the root; ``tops``: (tree, total, steps, subroot, root) of every tree."""

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return proofs_in(batches, levels)

    totals = tops.select("tree", "total")
    upper = tops.select("tree", F.lit(0).cast("long").alias("place"), "steps", "subroot", "root")
    for k in reversed(range(len(rounds))):
        here = F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(1 << levels * k))).cast("long").alias("total")
        joined = rounds[k].join(totals.select("tree", here), "tree").join(
            upper.select("tree", F.col("place").alias("block"), F.col("steps").alias("upper"), "subroot", "root"), ["tree", "block"]
        )
        upper = joined.mapInArrow(tidy(proofs), PROOFS)
    return upper


def numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """``rows`` with ``place`` in the order of a column: sorted by ranges, then counted by partition."""
    sorted_rows = staged(rows.orderBy(order).withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}), name)
    sizes = sorted_rows.groupBy("_part").agg(F.count("*").alias("n"))  # one row a partition
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("before"))
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return sorted_rows.join(F.broadcast(before), "_part").withColumn("place", F.col("before") + local).drop("_part", "_id", "before")


def manifest(docs: DataFrame, columns: Sequence[str], id_col: str, group_col: str, claim: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """id, group, place, leaf, claim, steps, subroot, root of every row of ``docs``.

    ``columns`` are hashed into the leaf in that order.  ``steps`` lead from the leaf to the root:
    the hash next to it (null if there is none) and whether that stands left.  ``claim`` is a
    leaf (hex) that someone else has for the row, or null; it is only carried along, to be checked by :func:`fold`.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # "-" sorts before "="
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    made = docs.select(
        tree.alias("tree"),
        own.alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.unhex(leaf_hash(*(F.col(c) for c in columns))).alias("leaf"),
        F.unhex(F.lit(None).cast("string") if claim is None else claim).alias("claim"),
    )
    # equal rows are counted before they meet
    leaves = staged(made.groupBy(*made.columns).agg(F.count("*").alias("copies")), "merkle-leaves")
    totals = staged(leaves.groupBy("tree").agg(F.sum("copies").alias("total")), "merkle-totals")  # one row a group
    size = totals.agg(F.max("total").alias("most"), F.sum("total").alias("all")).first()
    shown = F.when(F.col("no_id"), F.lit(None)).otherwise(F.col("id")).alias("id")
    nodes = places(leaves).join(totals, "tree").select("tree", "place", "copies", "total", shown, F.col("leaf").alias("node"), "claim")
    rounds = climb(nodes, size.most or 0, size.all or 0, levels, "merkle-blocks")

    subroots = numbered(rounds[-1].select("tree", "top"), "tree", "merkle-subroots")
    n_groups = subroots.count()
    over = subroots.select(
        F.lit("").alias("tree"),
        "place",
        F.lit(1).cast("long").alias("copies"),
        F.lit(n_groups).cast("long").alias("total"),
        F.lit(None).cast("long").alias("id"),
        F.col("top").alias("node"),
        F.lit(None).cast("binary").alias("claim"),
    )
    over_rounds = climb(over, n_groups, n_groups, levels, "merkle-root")
    root = F.lower(F.hex("top"))
    top = over_rounds[-1].select(
        "tree", F.lit(n_groups).cast("long").alias("total"), F.array().cast(STEPS).alias("steps"), root.alias("subroot"), root.alias("root")
    )
    to_root = descend(over_rounds, top, levels).select("place", "steps", "root")
    tops = subroots.join(to_root, "place").join(totals, "tree").select("tree", "total", "steps", F.lower(F.hex("top")).alias("subroot"), "root")
    group = F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).alias("group")
    return descend(rounds, tops, levels).select("id", group, "place", F.col("node").alias("leaf"), "claim", "steps", "subroot", "root")


def fold(leaf: str, steps: str) -> Column:
    """The root that a leaf (hex) and its steps lead to."""
    return F.expr(
        f"""aggregate({steps}, {leaf}, (h, s) -> sha2(CAST(CASE
              WHEN s.hash IS NULL THEN h
              WHEN s.left THEN concat(s.hash, h)
              ELSE concat(h, s.hash) END AS BINARY), 256))"""
    )
