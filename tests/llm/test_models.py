"""Quality, language identification, nearest neighbours and URL filters against brute force and held-out labels."""

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from fraudmart.llm import ann, language_id, quality, queries, url_filter

# --- quality


def test_quality_held_out(spark, documents):
    got = queries.op6_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(got) == 1000 and len(held) > 100
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97


def test_passages():
    texts = ["one two three", "", "a " * 130, "x"]
    data = "".join(texts).encode()
    at = np.cumsum([0, *(len(t) for t in texts)])
    row, features = quality.passages(np.frombuffer(data, np.uint8), at)
    assert row.tolist() == [0, 1, 2, 2, 2, 3] and np.isfinite(features).all()
    assert (features[1] == 0).all()
    for k, text in enumerate(texts):  # a text's features don't depend on its neighbours
        alone, own = quality.passages(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert len(alone) == (row == k).sum() and np.allclose(own, features[row == k])


def test_attention_fits():
    rng = np.random.default_rng(0)
    row = np.repeat(np.arange(20), rng.integers(1, 5, 20))
    x = rng.normal(size=(len(row), quality.N_FEATURES)).astype(np.float32)
    labels = (rng.random(20) < 0.5).astype(float)
    model = quality.fit(row, x, labels, epochs=60)
    assert ((model.score(row, x) >= 0.5) == labels).mean() > 0.9


def test_attention_finds_the_bad_passage():
    """A document is bad if one of its passages is; only the document is labelled."""
    rng = np.random.default_rng(1)
    row = np.repeat(np.arange(600), 5)
    x = rng.normal(0, 0.3, size=(3000, quality.N_FEATURES)).astype(np.float32)
    bad = rng.random(600) < 0.5
    x[np.flatnonzero(bad) * 5 + rng.integers(0, 5, bad.sum()), 7] += 4
    model = quality.fit(row[:2000], x[:2000], (~bad[:400]).astype(float))
    got = model.score(row[2000:] - 400, x[2000:]) >= 0.5
    assert (got == ~bad[400:]).mean() > 0.95


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (9, 0), (9, 0), (12, 1), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    model = quality.learn(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == 15 and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc.doc_id: r.score for r in got}
    assert scores[0] == scores[1] and scores[6] == scores[7] == scores[None]
    assert quality.score(empty, model).collect() == []
    none = quality.learn(empty, labels.limit(0))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    one = quality.learn(odd, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in quality.score(odd, one).collect()} == {0.75}


def test_quality_repeated_ids(spark, documents):
    """Rows of one id count once, whatever their order; a plain forward pass gives the same scores."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = documents.withColumn("text", F.concat(F.lit("x "), "text"))
    models = [quality.learn(df, labels, sample=30) for df in (documents.union(other), other.union(documents).repartition(5))]
    first, second = (quality.score(documents, m).select("doc.doc_id", "score").collect() for m in models)
    assert {r.doc_id: round(r.score, 6) for r in first} == {r.doc_id: round(r.score, 6) for r in second}
    for r in documents.limit(20).collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        row, x = quality.passages(data, np.array([0, len(data)]))
        alone = models[0].score(row, x)[0]
        assert abs(alone - {f.doc_id: f.score for f in first}[r.doc_id]) < 1e-5


def test_quality_sample_is_bounded(documents, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(documents, labels, sample=20, sample_passages=2)
    assert len(quality.score(documents, model).collect()) == documents.count()


# --- language identification


def plain_bundle(text: str, dimensions: int, gram: int) -> np.ndarray:
    letters = [ord(c) if c.isalpha() else 0 for c in text.lower()] + [0]
    letters = [c for k, c in enumerate(letters) if c or not k or letters[k - 1]]
    total = np.zeros(dimensions)
    for k in range(len(letters) - gram + 1):
        bound = np.ones(dimensions)
        for j in range(gram):
            bound *= np.roll(language_id.letter_vector(letters[k + j], dimensions), gram - 1 - j)
        total += bound
    return total


@pytest.mark.parametrize("gram", [1, 2, 3, 4])
def test_bundles(documents, gram):
    texts = ["", "a", "Ab, c!", "中文 éé", "..", *(r.text[:300] for r in documents.limit(5).collect())]
    got, has = language_id.bundles(texts, 64, gram)
    assert has.tolist() == [any(c.isalpha() for c in t) for t in texts]
    for vector, text in zip(got, texts):
        assert np.array_equal(vector, plain_bundle(text, 64, gram))


def test_long_text_is_whole(monkeypatch):
    """A text over the slice gives the same vector as in one piece, wherever it is cut."""
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(list("abc dé.\n中"), 999))
    want, _ = language_id.bundles([text], 64, 3)
    for size in (7, 64, 500, 998):
        monkeypatch.setattr(language_id, "SLICE", size)
        got, has = language_id.bundled([text], 64, 3)
        assert np.array_equal(got, want) and has.tolist() == [True]
    got, has = language_id.bundled(["." * 999], 64, 3)
    assert not got.any() and has.tolist() == [False]


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_language_id(spark, sf).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd(odd, empty, documents):
    got = language_id.predict(odd, language_id.learn(documents)).collect()
    assert len(got) == 15
    by_id = {r.doc.doc_id: (r.lang_pred, r.score) for r in got}
    assert all(by_id[i] == ("und", 0.0) for i in (0, 1, 2, 11)) and by_id[6][0] == "en" == by_id[None][0]
    assert language_id.predict(empty, language_id.learn(empty)).collect() == []
    assert {r.lang_pred for r in language_id.predict(odd, language_id.learn(empty)).collect()} == {"und"}


# --- nearest neighbours


def exact(rows, queries_, k):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in queries_:
        own = vectors[np.flatnonzero(ids == q)[0]]
        scores = (vectors * own).sum(axis=1)
        keep = np.flatnonzero(ids != q)
        best = keep[np.lexsort((ids[keep], -scores[keep]))][:k]
        out[q] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = found(ann.nearest(vectors, F.col("vec_id") % 20 == 0, block_rows=700, chunk_rows=60))
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit / (20 * len(want)) >= 0.9
    scores = {q: dict(exact(rows, [q], len(rows))[q]) for q in list(want)[:5]}
    assert all(scores[q][i] == s for q in scores for i, s in got[q])


def test_nearest_copies_and_odd(spark):
    """Copies tie exactly and go by id; unusable vectors take no part; fewer candidates than k."""
    rng = np.random.default_rng(0)
    hot = rng.normal(size=8).astype(np.float32).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    bad = [(400, None), (420, []), (440, [0.0] * 8), (460, [float("nan")] * 8), (480, [float("inf")] + hot[1:]), (500, [None] + hot[1:]), (520, [1.0, 2.0]), (None, hot)]
    docs = spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int, score double").repartition(4)
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    for block in (10_000, 90):
        assert found(ann.nearest(docs, F.col("vec_id") % 20 == 0, block_rows=block)) == want
    few = found(ann.nearest(docs.where("vec_id < 5"), F.col("vec_id") % 20 == 0))
    assert few == exact(rows[:5], [0], 20) and len(few[0]) == 4
    assert ann.nearest(docs.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    twice = docs.where("vec_id < 50").union(docs.where("vec_id = 0"))
    assert [i for i, _ in found(ann.nearest(twice, F.col("vec_id") % 20 == 0))[0]] == [i for i, _ in exact(rows[:50], [0], 20)[0]]


def test_repeated_ids(spark):
    """Of rows that share an id the least vector stands, whatever their order."""
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.5, 2.0]), (1, [0.1, 1.0]), (2, [1.0, 0.1]), (2, [-9.0, 5.0])]
    want = exact([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.1, 1.0]), (2, [-9.0, 5.0])], [0, 20], 20)
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").coalesce(1)
        assert found(ann.nearest(df, F.col("vec_id") % 20 == 0)) == want


def test_footrule_ranks_candidates():
    """What is reranked is what the plain footrule distance puts first."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    vectors, pivots = rng.normal(size=(900, 6)), rng.normal(size=(20, 6))
    order = ann.prefixes(vectors, pivots, 8)
    place = np.full((900, 20), 8)
    np.put_along_axis(place, order, np.arange(8)[None, :], axis=1)
    table = pa.table({"vec_id": np.arange(900), "v": pa.array(vectors.tolist())})
    got = ann.search_block(table, table.slice(0, 5), pivots, 8, 0.3, 4).to_pylist()
    for q in range(5):
        distance = np.abs(place[:, order[q]] - np.arange(8)).sum(axis=1)
        best = np.lexsort((np.arange(900), distance))[: 270]
        near = [b for b in sorted(best, key=lambda b: (-(vectors[b] * vectors[q]).sum(), b)) if b != q][:4]
        assert [r["vec_id"] for r in got if r["query_id"] == q] == near


def test_footrule_order():
    """Candidates rank by the footrule distance over the query's pivots."""
    rng = np.random.default_rng(2)
    vectors, pivots = rng.normal(size=(200, 6)), rng.normal(size=(12, 6))
    order = ann.prefixes(vectors, pivots, 5)
    files = ann.inverted_files(order, 12)
    assert sum(len(rows) for rows, _ in files) == 200 * 5
    for pivot, (rows, places) in enumerate(files):
        assert all(order[r, p] == pivot for r, p in zip(rows, places))


# --- URL filters


def rank_hosts(seeds, edges, damping, rounds):
    out_n, in_n = {}, {}
    for s, d in edges:
        out_n[s], in_n[d] = out_n.get(s, 0) + 1, in_n.get(d, 0) + 1
    hosts = set(seeds) | {h for e in edges for h in e}
    trust = {h: (1 - damping) * seeds.get(h, (0, 0))[0] for h in hosts}
    distrust = {h: (1 - damping) * seeds.get(h, (0, 0))[1] for h in hosts}
    for _ in range(rounds):
        t = {h: (1 - damping) * seeds.get(h, (0, 0))[0] for h in hosts}
        b = {h: (1 - damping) * seeds.get(h, (0, 0))[1] for h in hosts}
        for s, d in edges:
            t[d] += damping * trust[s] / out_n[s]
            b[s] += damping * distrust[d] / in_n[d]
        trust, distrust = t, b
    return trust, distrust


def test_propagation(spark):
    pages = [
        (1, "http://good.com/x", '<a href="http://Friend.org/a">f</a> <a class=b href=//other.org>o</a>'),
        (2, "https://GOOD.com/y?http://z", "<A HREF='https://friend.org/q'>again</A> <a href='/here'>own</a>"),
        (3, "http://bad.net/fr/1", '<a href="http://friend.org">f</a>'),
        (4, "http://links.org/", '<a href="http://bad.net/fr/2"></a><a href="http://bad.net/es/"></a>'),
        (5, "http://friend.org/1", '<a href="http://links.org/"></a>'),
        (6, "http://alone.org", None),
        (6, "http://alone.org", None),
        (7, None, "<a href='http://bad.net/'>x</a>"),
        (8, "no scheme", ""),
        (None, "http://bad.net:8080/fr/", ""),
    ]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, host string, trust string").repartition(3)
    got = url_filter.judge_urls(df, damping=0.6, rounds=7, prior=0.05).collect()
    seeds = {"good.com": (1, 0), "bad.net": (0, 1), "links.org": (0, 0), "friend.org": (0, 0), "alone.org": (0, 0), "bad.net:8080": (0, 0)}
    edges = {("good.com", "friend.org"), ("good.com", "other.org"), ("bad.net", "friend.org"), ("links.org", "bad.net"), ("friend.org", "links.org")}
    trust, distrust = rank_hosts(seeds, edges, 0.6, 7)
    assert len(got) == len(pages)
    for r in got:
        assert r.trust == pytest.approx(trust.get(r.host, 0)) and r.distrust == pytest.approx(distrust.get(r.host, 0))
        risk = r.distrust / (r.trust + r.distrust + 0.05)
        want = {"com/": "allow", "net/fr/": "block"}.get(r.rule, "block" if risk >= 0.5 else "allow")
        assert r.verdict == want
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by_id[4] == ("links.org", "/", None, "block")  # who links to a blocked host
    assert by_id[2] == ("good.com", "/y", "com/", "allow") and by_id[7] == by_id[8] == ("", "", None, "allow")
    assert by_id[6] == ("alone.org", "", None, "allow") and by_id[None][2] is None
    assert url_filter.judge_urls(df.limit(0)).collect() == []


def test_rules(spark):
    urls = ["http://a.www.example.com/en/1", "http://x.example.com/en/", "http://notexample.com/en/", "http://example.com/de/", "http://com/", "http://a.NET/es/?q", "http://net.org/es/"]
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.rule for r in url_filter.judge_urls(df).collect()}
    assert [got[i] for i in range(7)] == ["www.example.com/en/", "example.com/en/", "com/", "com/", "com/", "net/es/", None]


def test_no_python_in_url_filters(spark):
    df = queries.op10_url_filters(spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
