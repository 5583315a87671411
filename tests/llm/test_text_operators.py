"""LM scoring, line dedup, packing, near-dedup, decontamination and suffix dedup against brute force, and their odd cases."""

import hashlib
import math
import zlib

import brute
import numpy as np
import pytest
from brute import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudmart.llm import decontamination, line_dedup, lm_scoring, near_dedup, packing, queries, suffix_dedup
from fraudmart.llm.induced_sort import FIRST, SENTINEL, SEPARATOR, sorted_suffixes


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# --- LM scoring


@pytest.mark.parametrize(("order", "chunk"), [(1, 5000), (2, 2_000_000), (3, 20_000)])
def test_lm_scores(spark, documents, order, chunk):
    held = F.col("doc_id") % 5 == 2
    got = lm_scoring.score_texts(documents, held, order=order, prior=7.0, chunk_tokens=chunk, bucket_bytes=50_000).collect()
    rows = pairs(documents)
    want, n_tokens = brute.lm_scores([(t, i % 5 == 2) for i, t in rows], order, 7.0)
    expected = {i: w for (i, _), w in zip(rows, want)}
    assert len(got) == len(rows)
    for r in got:
        n, known, base, score = expected[r.id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, n_tokens, r.id % 5 == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_lm_query_is_of_order_three(spark, documents):
    got = {r.doc_id: r for r in queries.op1_lm_scoring(spark, SF).collect()}
    rows = pairs(documents)
    want, _ = brute.lm_scores([(t, got[i].held_out) for i, t in rows], 3, lm_scoring.PRIOR)
    assert all(math.isclose(got[i].score, w[3], rel_tol=1e-9) for (i, _), w in zip(rows, want))


def test_lm_is_a_distribution(spark):
    """Over all words and the unknown one, a context's probabilities add up to one."""
    docs = spark.createDataFrame([(0, "a b a c"), (1, "b a b")], "doc_id long, text string")
    tries = spark.createDataFrame([(10 + k, f"a {w}") for k, w in enumerate(("a", "b", "c", "unknown"))] + [(20, "a")], "doc_id long, text string")
    got = lm_scoring.score_texts(docs.union(tries), F.col("doc_id") >= 10, prior=2.0)
    scores = {r.id: r.score for r in got.collect()}
    brute_scores, _ = brute.lm_scores([("a b a c", False), ("b a b", False), ("a", True)], 2, 2.0)
    # p(a | start) p(end | a) is the text "a"; the other texts end after a second word
    starts = brute.lm_scores([("a b a c", False), ("b a b", False)] + [(f"a {w}", True) for w in ("a", "b", "c", "unknown")], 2, 2.0)[0][2:]
    assert math.isclose(scores[20], brute_scores[2][3])
    for k, want in enumerate(starts):
        assert math.isclose(scores[10 + k], want[3])


def test_lm_odd(odd, odd_rows, empty):
    got = lm_scoring.score_texts(odd, F.col("doc_id") == 3, chunk_tokens=1000).collect()
    want, _ = brute.lm_scores([(r[1], r[0] == 3) for r in odd_rows], lm_scoring.ORDER, lm_scoring.PRIOR)
    key = lambda t: (str(t[0]), t[1], round(t[2], 6))
    assert sorted(((r.id, r.n_tokens, r.score) for r in got), key=key) == [
        (i, n, pytest.approx(s)) for i, n, s in sorted(((r[0], w[0], w[3]) for r, w in zip(odd_rows, want)), key=key)
    ]
    assert lm_scoring.score_texts(empty, F.lit(False)).collect() == []


# --- line dedup


@pytest.mark.parametrize("log_registers", [10, 4])
def test_line_dedup(documents, log_registers):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    for min_sites in (2, 6):
        want = brute.without_boilerplate(rows, min_sites)
        got = line_dedup.remove_boilerplate(documents, min_sites).select("doc.doc_id", "cleaned").collect()
        assert {r.doc_id: r.cleaned for r in got} == want and len(got) == len(rows)


def test_line_dedup_odd(spark, odd, empty):
    got = line_dedup.remove_boilerplate(odd, 2).collect()
    assert len(got) == 15
    by_id = {r.doc.doc_id: r for r in got}
    assert by_id[0].cleaned is None and by_id[0].n_lines == 0
    assert by_id[1].cleaned == "" and by_id[1].n_lines == 1 and not by_id[1].emptied
    assert by_id[6].n_removed == 0 and by_id[7].emptied  # the copies are on s1 and s2
    assert by_id[None].n_removed == 0
    assert line_dedup.remove_boilerplate(empty).collect() == []


# --- packing


def tokens_of(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for t in texts]


def check_pieces(rows, texts, length):
    """Pieces give every document's ids back and stand without gaps in sequences; returns the padding."""
    want = tokens_of(texts)
    found, sequences = {}, {}
    for r in rows:
        found.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    sizes = []
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and len(r.ids) == 4 * r.length > 0
            at += r.length
        assert at <= length
        sizes.append(at)
    for doc, ids in enumerate(want):
        parts = sorted(found[doc], key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist()
        assert np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist() == ids
        assert {r.doc_tokens for r in parts} == {len(ids)}
    return packing.padding(sizes, length)


def test_packing_round_trip(spark, documents):
    texts = [t for _, t in sorted(pairs(documents))]
    for group in (packing.GROUP_TOKENS, 5000):
        rows = packing.pack_documents(documents.repartition(3), queries.tokenizer_path(), group_tokens=group).collect()
        assert check_pieces(rows, texts, packing.LENGTH) == 0


def test_packing_odd(spark, odd_rows, empty):
    texts = [r[1] for r in odd_rows] + ["it's I'LL 3.5 <|endoftext|> <|ENDOFTEXT|> don't.Stop É.é x\x0by\x0cz\x1cq\x85r ΑΣ İ é"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, sequence_id string")
    assert check_pieces(packing.pack_documents(docs, queries.tokenizer_path(), length=64).collect(), texts, 64) == 0
    assert packing.pack_documents(empty, queries.tokenizer_path()).collect() == []


@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([1, 7, 16, 100]))
@settings(max_examples=200, deadline=None)
def test_pack(lengths, length):
    sequences = packing.pack(lengths, length)
    parts = sorted(p for s in sequences for p in s)
    for doc, n in enumerate(lengths):
        at = 0
        for _, start, size in (p for p in parts if p[0] == doc):
            assert start == at
            at += size
        assert at == n
    sizes = [sum(p[2] for p in s) for s in sequences]
    assert all(0 < s <= length for s in sizes) and packing.padding(sizes, length) == 0


def test_best_fit_takes_the_tightest():
    windows = packing.best_fit([(0, 0, 60), (1, 0, 70), (2, 0, 30), (3, 0, 40)], 100)
    assert sorted(sorted(p[0] for p in w) for w in windows) == [[0, 3], [1, 2]]


# --- near-dedup


def check_components(docs, size, percent, **options):
    got = near_dedup.near_components(docs, size, percent, **options).collect()
    want = brute.near_components(pairs(docs), size, percent)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.id == r.component_id) for r in got)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_dedup(documents, size, percent):
    check_components(documents, size, percent)


@pytest.mark.parametrize(("small", "depth"), [(1024, 14), (6, 4), (4, 1)])
def test_near_dedup_families(spark, small, depth):
    """Families of near copies around the threshold, through branching and blocks as well."""
    rng = np.random.default_rng(3)
    texts = []
    for family in range(4):
        base = [f"w{family}x{k}" for k in range(40)] + [f"common{k}" for k in range(20)]
        for _ in range(30):
            own = list(base)
            for k in rng.choice(60, rng.integers(0, 5), replace=False):
                own[k] = f"n{rng.integers(1e9)}"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check_components(docs, 3, 85, small=small, depth=depth)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_dedup_trees_reach_threshold_pairs(percent):
    """Signatures that agree by chance as a pair at the threshold does, followed through the real branching to full depth."""
    rng, n = np.random.default_rng(4), 40_000
    one, two = rng.integers(0, 2**32, (2, n, near_dedup.COORDINATES), dtype=np.uint32)
    two = np.where(rng.random(one.shape) < percent / 100, one, two)
    alone = np.arange(n)
    for tree in range(near_dedup.Threshold(percent).trees()):
        pair, node = alone, near_dedup.draw(np.full(len(alone), tree, np.uint64), 0)
        for _ in range(near_dedup.DEPTH):
            row, child = near_dedup.children(node, one[pair])
            shared = child == near_dedup.children(node, two[pair])[1]
            pair, node = pair[row][shared], child[shared]
        alone = np.setdiff1d(alone, pair)
    assert len(alone) / n <= 2 * near_dedup.MISSED


def test_near_dedup_finds_threshold_pairs_at_full_depth(spark):
    """Pairs at the threshold in one large family, so that no node is small before the trees have branched often."""
    common, texts = [f"c{k}" for k in range(72)], []
    for pair in range(250):
        both = common + [f"p{pair}x{k}" for k in range(8)]
        texts += [" ".join(both + [f"o{pair}x{own}x{k}" for k in range(10)]) for own in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = near_dedup.near_components(docs, 1, 80, small=4).collect()
    assert {r.id: r.component_id for r in got} == {i: i - i % 2 for i in range(len(texts))}


def test_near_dedup_odd(spark, odd, empty):
    got = near_dedup.near_components(odd, 3, 85).collect()
    assert len(got) == 15
    by_id = {r.id: r for r in got}
    assert [by_id[i].component_id for i in range(13)] == [0, 1, 2, 3, 4, 5, 6, 6, 6, 9, 10, 11, 12]
    assert by_id[0].n_shingles == by_id[1].n_shingles == by_id[2].n_shingles == 0 and by_id[4].n_shingles == 1
    assert by_id[None].component_id is None and by_id[None].kept
    assert near_dedup.near_components(empty).collect() == []
    kept = near_dedup.keep_first(odd).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["None", "6", *(str(i) for i in range(13) if i not in (7, 8))])
    assert kept[0].asDict().keys() == odd.first().asDict().keys()


# --- decontamination


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 2000])
def test_decontamination(spark, documents, block_bytes):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    named = [(r.item_id, r.text) for r in items.collect()]
    got = decontamination.find_leaks(documents, items, block_bytes=block_bytes).collect()
    assert len(got) == documents.count() and any(r.n_hit for r in got)
    for r in got:
        n_words, n_hit, names, runs = brute.leaks(r.doc.text, named)
        assert (r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) == (n_words, n_hit, names, runs)


def test_decontamination_odd(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "The QUICK, brown fox! jumps-over the lazy dog and runs far"), (1, "ünïcode"), (2, "A"), (3, None), (4, "..."), (None, "a b")],
        "item_id long, text string",
    )
    named = [("1", "The QUICK, brown fox! jumps-over the lazy dog and runs far"), ("1", "ünïcode"), ("2", "A"), ("", "a b")]
    got = decontamination.find_leaks(odd, items).collect()
    assert len(got) == 15
    for r in got:
        if r.doc.doc_id != 12:
            n_words, n_hit, names, runs = brute.leaks(r.doc.text, named)
            assert (r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) == (n_words, n_hit, names, runs)
    assert decontamination.find_leaks(empty, items).collect() == []
    none = decontamination.find_leaks(odd, items.limit(0)).collect()
    assert len(none) == 15 and not any(r.n_hit for r in none)


# --- suffix dedup


@given(
    st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=25), min_size=1, max_size=6),
    st.sampled_from([2, 5, 100]),
    st.sampled_from([1, 4, 10**6]),
)
@settings(max_examples=300, deadline=None)
def test_induced_sorting(strings, cap, held):
    """Order and common prefixes up to ``cap``, also with queues on disk."""
    text = [c for s in strings for c in [*(x + FIRST for x in s), SEPARATOR]] + [SENTINEL]
    order, common = [], []
    for pos, lcp in sorted_suffixes(np.array(text, np.uint16), cap, held):
        order += pos.tolist()
        common += lcp.tolist()
    assert sorted(order) == list(range(len(text) - 1))
    for k in range(1, len(order)):
        a, b = (text[p : p + cap] for p in order[k - 1 : k + 1])
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert a <= b and common[k] == same


@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup(documents, small):
    options = {"chunk_bytes": 20_000, "bucket_bytes": 60_000, "shard_bytes": 20_000} if small else {}
    got = suffix_dedup.remove_repeats(documents.repartition(3), **options).collect()
    want = brute.repeats(pairs(documents), 100)
    assert len(got) == len(want)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) == want[r.doc.doc_id]


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60).map("".join), max_size=6), st.integers(0, 40))
@settings(max_examples=8, deadline=None)
def test_suffix_dedup_short_alphabet(spark, texts, run):
    """Periodic texts, where windows repeat inside their own document."""
    texts = [*texts, "a" * run, "ab" * run]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = suffix_dedup.remove_repeats(docs, length=10, gram=4).collect()
    want = brute.repeats(list(enumerate(texts)), 10)
    assert {r.doc.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == want


def test_suffix_dedup_splits_a_hot_anchor(spark, monkeypatch):
    """A line with different surroundings in every document: no shard gets more than it should hold."""
    rng, line = np.random.default_rng(6), "the very common line of this site and others"
    rows = []
    for i in range(400):
        left, right = ("".join(rng.choice(list("abcd"), 40)) for _ in range(2))
        rows.append((i, left + line + right))
    rows += [(400 + i, f"{i} " + rows[i][1][10:110] + f" {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut, asked_sizes = suffix_dedup.cut_out, []

    def seen(texts, asked, shards):
        asked_sizes.append(asked.groupBy("anchor").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] or 0)
        return cut(texts, asked, shards)

    monkeypatch.setattr(suffix_dedup, "cut_out", seen)
    got = {r.doc.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=60, gram=20, shard_bytes=3000).collect()}
    monkeypatch.undo()
    whole = {r.doc.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=60, gram=20).collect()}
    assert max(asked_sizes) <= 3000
    assert {i: (r.n_removed, r.spans, r.kept) for i, r in got.items()} == {i: (r.n_removed, r.spans, r.kept) for i, r in whole.items()}
    assert sum(r.n_removed for r in got.values()) >= 2000


def test_suffix_dedup_odd(odd, odd_rows, empty):
    got = suffix_dedup.remove_repeats(odd).collect()
    want = brute.repeats([r[:2] for r in odd_rows[:13]], 100)
    assert len(got) == 15
    for r in got:
        found = (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
        assert found == want[r.doc.doc_id] if r.doc.doc_id is not None else found[1] == 0
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_crc_matches_python(documents):
    got = documents.select("doc_id", queries.crc_remainder(F.col("doc_id"), 7).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.doc_id).encode()) % 7 for r in got)
