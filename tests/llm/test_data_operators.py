"""Merkle manifest, hard negatives and sharding against brute force, and their odd cases."""

import hashlib
import uuid
import zlib

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from fraudmart.llm import hard_negatives, merkle, queries, sharding
from fraudmart.session import scratch_path


# --- Merkle manifest


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """(top, steps of every node)."""
    steps, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            steps[k].append((bool(i & 1), level[other] if other < len(level) else None))
            at[k] = i // 2
        level = [sha(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], steps


def plain_manifest(rows):
    """Sorted (id, group, place, leaf, steps, subroot, root) of (id, group, text)."""
    groups: dict = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, plain_leaf(i, g, t), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: x[:3]),) for g in names}
    trees = {g: (leaves, *plain_tree([x[2] for x in leaves])) for g, (leaves,) in trees.items()}
    root, up = plain_tree([trees[g][1] for g in names])
    return [
        (x[3], g, place, x[2], steps + above, top, root)
        for (g, (leaves, top, ways)), above in zip(trees.items(), up)
        for place, (x, steps) in enumerate(zip(leaves, ways))
    ]


def manifest_rows(df):
    return [(r.id, r.group, r.place, r.leaf, [(s.left if s.hash else False, s.hash) for s in r.steps], r.subroot, r.root) for r in df.collect()]


def keyed(rows):
    fixed = [(*r[:4], [(left if other else False, other) for left, other in r[4]], *r[5:]) for r in rows]
    return sorted(fixed, key=lambda r: (r[1] or "", r[1] is not None, r[2]))


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_manifest(spark, levels):
    """Sparse, dense, negative and repeated ids, equal rows, odd groups; several rounds of blocks."""
    rng = np.random.default_rng(3)
    ids = [*range(-70, 70), *(int(x) for x in rng.integers(-(2**62), 2**62, 40)), 2**63 - 1, -(2**63) + 1, 1 << 40, (1 << 40) + 63]
    rows = [(i, ("a", "b", None, "é", "")[k % 5], f"t{k}") for k, i in enumerate(ids)]
    rows += [(5, "a", f"twin {k}") for k in range(9)] + [(6, "b", "equal")] * 20 + [(None, "a", "x"), (None, "a", "y"), (None, "a", "y"), (None, None, None)]
    rows += [(1, "alone", None)]
    df = spark.createDataFrame([(*r, "clash", 1, b"z") for r in rows], "doc_id long, lang string, text string, tree string, place int, node binary").repartition(3)
    made = merkle.manifest(df, ("doc_id", "lang", "text"), "doc_id", "lang", levels=levels)
    assert keyed(manifest_rows(made)) == keyed(plain_manifest(rows))
    checked = made.select((merkle.fold("leaf", "steps") == F.col("root")).alias("ok"), (merkle.fold("root", "steps") == F.col("root")).alias("bad")).collect()
    assert all(r.ok for r in checked) and not any(r.bad for r in checked)


def test_manifest_small(spark):
    one = spark.createDataFrame([(1, "a", "x")], "doc_id long, lang string, text string")
    row = merkle.manifest(one, ("doc_id", "text"), "doc_id", "lang").collect()[0]
    assert row.leaf == row.subroot == row.root == plain_leaf(1, "x") and row.steps == [] and row.claim is None
    assert merkle.manifest(one.limit(0), ("doc_id", "text"), "doc_id", "lang").collect() == []


def test_manifest_odd(odd, odd_rows):
    fields = ("doc_id", "text")
    claim = F.when(F.col("doc_id") == 3, merkle.leaf_hash(F.col("doc_id"), F.lit("other")))
    got = merkle.manifest(odd, fields, "doc_id", "lang", claim, levels=2).withColumn("ok", merkle.fold("coalesce(claim, leaf)", "steps") == F.col("root")).collect()
    assert sorted(r.leaf for r in got) == sorted(plain_leaf(r[0], r[1]) for r in odd_rows)
    assert [r.id for r in got if not r.ok] == [3]


def test_tampered(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_merkle_manifest(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and docs[r.doc_id].n_chars is not None
        assert r.verified != changed and r.verified == (r.folded_root == r.root)


# --- hard negatives


def plain_negatives(rows, every, positives=5, negatives=3):
    ids = np.array([r[0] for r in rows])
    vectors = [[int(np.floor(256 * float(x))) for x in r[1]] for r in rows]
    out = []
    for k in np.flatnonzero(ids % every == 0):
        scores = [sum(a * b for a, b in zip(vectors[k], v)) for v in vectors]
        order = sorted((j for j in range(len(rows)) if j != k), key=lambda j: (-scores[j], ids[j]))
        others = [j for j in order if rows[j][2] != rows[k][2]]
        for p in [j for j in order if rows[j][2] == rows[k][2]][:positives]:
            fit = [j for j in others if 50 * scores[p] <= 100 * scores[j] <= 95 * scores[p]][:negatives]
            out += [(int(ids[k]), int(ids[p]), n, int(ids[j]), scores[p], scores[j]) for n, j in enumerate(fit, 1)]
    return sorted(out)


def mined(df, every, **options):
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "chunk_rows": 5, "codes": 4, "sample": 50}])
def test_hard_negatives(spark, options):
    """Clustered vectors, a large group of copies with both labels, ties, zero and unusable rows."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 7))
    rows = []
    for i in range(400):
        v = centres[0] if i % 3 == 0 else centres[rng.integers(6)] + 0.3 * rng.normal(size=7)
        rows.append((i, np.zeros(7).tolist() if i in (10, 11) else [float(np.float32(x)) for x in v], i % 4))
    rows += [(1000, [1.0] * 7, 77)]  # nobody else has the label
    bad = [(1020, None, 1), (1040, [float("nan")] * 7, 1), (1060, [float("inf")] + [0.0] * 6, 1), (1080, [None] + [0.0] * 6, 1), (1100, [1.0, 2.0], 1), (1120, [0.5] * 7, None), (None, [0.5] * 7, 1)]
    repeated = [(20, [9.0] * 7, 3), rows[20]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad + repeated], "vec_id long, embedding array<float>, label int, v string, score int").repartition(4)
    want = plain_negatives(rows, 20)
    assert len(want) > 100 and mined(df, 20, **options) == want
    assert mined(df.where("vec_id < 3"), 20, **options) == plain_negatives(rows[:3], 20)
    assert mined(df.limit(0), 20, **options) == []


def test_huge_components(spark):
    df = spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1), (2, [0.7e9], 2)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="fit a long"):
        mined(df, 1)
    rows = [(i, [1e6 + i, -1e5 * i], i % 2) for i in range(9)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(wide, 2) == plain_negatives(rows, 2)
    assert hard_negatives.arithmetic(256.0) is np.float32 and hard_negatives.arithmetic(1e6) is np.float64 and hard_negatives.arithmetic(1e9) is np.int64


def test_walk_falls():
    """Cells come once each, by falling sums of their half bounds."""
    rng = np.random.default_rng(5)
    one, two = rng.normal(size=7), rng.normal(size=5)
    walk, seen, last = hard_negatives.Walk(one, two), [], np.inf
    while walk.heap:
        bound = walk.bound()
        i, j = walk.step()
        assert bound <= last and bound == pytest.approx(one[i] + two[j])
        last = bound
        seen.append((int(i), int(j)))
    assert sorted(seen) == [(i, j) for i in range(7) for j in range(5)]


def test_certified_stop():
    """On separated clusters an anchor reads few of the cells, and the bounds hold."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(16, 8)) * 100
    points = np.floor(centres[rng.integers(16, size=2000)] + rng.normal(size=(2000, 8)))
    books = tuple(hard_negatives.k_means(half, 16) for half in (points[:, :4], points[:, 4:]))
    codes, far = zip(*(hard_negatives.nearest_centre(half, book) for half, book in zip((points[:, :4], points[:, 4:]), books)))
    radii = tuple(np.array([f[c == k].max(initial=0) for k in range(len(b))]) for c, f, b in zip(codes, far, books))
    index = hard_negatives.Index(4, books, radii, np.zeros(0), np.zeros(0), np.float64)
    one, two = index.half_bounds(points[:50])
    assert (points[:50] @ points.T <= one[:, codes[0]] + two[:, codes[1]]).all()
    walk, need, read = hard_negatives.Walk(one[0], two[0]), np.sort(points @ points[0])[-5], 0
    while walk.bound() >= need:
        i, j = walk.step()
        read += ((codes[0] == i) & (codes[1] == j)).sum()
    assert 5 <= read < 1000


# --- sharding


def placements(spark, docs, shards, **options):
    path = scratch_path(spark, f"map-{uuid.uuid4().hex}")
    return sharding.shard_documents(docs, shards, path, **options).collect(), path


def assert_law(rows, docs, shards, slack):
    want = sorted((i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((r.id is None, r.id or 0, r.size, r.text_crc32) for r in rows) == want
    held = [sorted(r.slot for r in rows if r.shard == s) for s in range(shards)]
    assert all(h == list(range(len(h))) for h in held) and sum(map(len, held)) == len(rows)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(shards)]
    assert max(sizes) - min(sizes) <= slack, sizes


def test_sharding(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows, path = placements(spark, documents, 5)
    assert_law(rows, docs, 5, 200)
    assert {r.map_version for r in rows} == {2}
    assert sharding.read_map(spark, path, 1).count() == sharding.read_map(spark, path).count() == sharding.SLOTS


def test_sharding_query(spark):
    got = queries.op13_sharding(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(docs) and {(r.law, r.grown_shard) for r in got} == {("bytes", None)} and {r.shard for r in got} <= set(range(24))
    plan = queries.op13_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_hot_rows_are_split(spark):
    """A third of all rows are one row, another third has no id: shards stay equal, every row is there."""
    copy = (7, "the same text " * 3)
    docs = [copy] * 5000 + [(None, f"text {k}") for k in range(5000)] + [(k, "w" * (k % 90)) for k in range(5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows, path = placements(spark, df, 6, slots=64)
    assert_law(rows, docs, 6, 8000)  # about one of the 64 slots
    hot = [r for r in rows if r.id == 7 and r.size == len(copy[1]) + 8]
    assert len(hot) >= 5000 and len({r.shard for r in hot}) > 2
    # one shard more: only what the new shard takes moves
    sizes = sharding.slot_sizes(sharding.records(df, slots=64))
    sharding.store_map(sharding.rebalanced(sharding.read_map(spark, path), sizes, 7), path)
    old = {r.slot: r.shards for r in sharding.read_map(spark, path, 2).collect()}
    new = {r.slot: r.shards for r in sharding.read_map(spark, path, 3).collect()}
    assert old.keys() == new.keys() == set(range(64))
    moved = [s for s in old if old[s] != new[s] and len(old[s]) == len(new[s])]
    assert 0 < len(moved) < 32 and any(6 in s for s in new.values())
    kept = sharding.rebalanced(sharding.read_map(spark, path, 3), sizes, 7).collect()
    assert sum(r.shards != new[r.slot] for r in kept) <= 8  # a balanced map is hardly edited


def test_sharding_odd(spark, odd, odd_rows, empty):
    rows, _ = placements(spark, odd, 3)
    assert_law(rows, [r[:2] for r in odd_rows], 3, 10**7)
    rows, path = placements(spark, empty, 4)
    assert rows == [] and sharding.read_map(spark, path).count() == sharding.SLOTS


def test_write_shards(spark, odd, odd_rows):
    path, out = scratch_path(spark, f"map-{uuid.uuid4().hex}"), scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    rows = sharding.records(odd)
    sharding.write_shards(rows, sharding.latest_map(spark, path, 3), out)
    back = spark.read.parquet(out)
    assert sorted(map(str, back.drop("_shard").collect())) == sorted(map(str, odd.collect()))
    assert {r._shard for r in back.select("_shard").distinct().collect()} <= {0, 1, 2}


def test_copies(spark):
    counted = spark.createDataFrame([(1, 9, 3), (2, 9, 10_000)], "id int, text_crc32 int, m long")
    got = sharding._copies(counted).collect()
    assert sorted(r.copy for r in got if r.id == 2) == list(range(10_000)) and sorted(r.copy for r in got if r.id == 1) == [0, 1, 2]
