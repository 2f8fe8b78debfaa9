"""Whitening, ranked lexical search and exact top-k search against brute force, and on odd rows."""

import collections
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from regfold.llm import lexical, queries, top_products, whitening

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int"


def rows(df):
    return [r.asDict() for r in df.collect()]


def clashing(df):
    """Extra columns with names that the operators make themselves."""
    for name in ("uid", "place", "dim", "length", "part", "shard", "block", "doc", "score", "rank", "n", "slot", "term", "df"):
        df = df.withColumn(name, F.lit("x"))
    return df


# ---- 11

def brute_whitening(data):
    """n, deviations, eigenvalues and covariance from fractions, per row of ``data`` ({row: vector})."""
    x = {k: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for k, v in data.items()}
    n, dim = len(x), len(next(iter(x.values())))
    total = [sum(v[i] for v in x.values()) for i in range(dim)]
    deviation = {k: sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for k, v in x.items()}
    cov = np.array([[float(Fraction(sum((n * v[i] - total[i]) * (n * v[j] - total[j]) for v in x.values()), n**3))
                     for j in range(dim)] for i in range(dim)])
    centred = {k: np.array([float(Fraction(n * c - s, n)) for c, s in zip(v, total, strict=True)]) for k, v in x.items()}
    return n, deviation, cov, centred


def check_whitening(got, data, components):
    n, deviation, cov, centred = brute_whitening(data)
    values = np.linalg.eigvalsh(cov)[::-1]
    white = {k: np.array(got[k]["whitened"], dtype=float) for k in data}
    for k in data:
        assert got[k]["n"] == n and int(got[k]["deviation"]) == deviation[k]
    k = min(components, len(values))
    live = [c for c in range(k) if values[c] > 1e-9 * values[0]]
    matrix = np.array([white[r] for r in data])
    assert matrix.shape[1] == k
    assert np.abs(np.cov(matrix[:, live].T, bias=True) - np.eye(len(live))).max() < 1e-4
    first = next(iter(data))
    assert np.allclose([got[first]["explained"][c] for c in live], values[live] / values.sum(), rtol=1e-9)
    assert got[first]["identity_error"] < 1e-4
    # each component is an eigenvector of the exact covariance: cov(x, w) / sqrt(e) is that vector
    for c in live:
        w = sum(centred[r] * white[r][c] for r in data) / n / math.sqrt(values[c])
        assert abs(np.linalg.norm(w) - 1) < 1e-9 and np.allclose(cov @ w, values[c] * w, atol=1e-9 * values[0])


def test_whitening_against_fractions(spark):
    rng = np.random.RandomState(3)
    mix = rng.randn(6, 6)
    data = {i: [float(np.float32(v)) for v in rng.randn(6) @ mix * 3 + 5] for i in range(400)}
    odd = [(900, None, 1), (901, [], 1), (902, [NAN] * 6, 1), (903, [1.0, None, 2.0, 3.0, 4.0, 5.0], 1), (904, [INF] * 6, 1)]
    df = clashing(spark.createDataFrame([(i, v, 1) for i, v in data.items()] + odd, VECTORS))
    for components in (4, 32):
        got = {r["vec_id"]: r for r in rows(whitening.whiten(df, components))}
        assert set(got) == set(data)
        check_whitening(got, data, components)


def test_whitening_of_each_length_repeats_and_ties(spark):
    rng = np.random.RandomState(4)
    wide = {i: [float(np.float32(v)) for v in rng.randn(5)] for i in range(60)}
    flat = {100 + i: [float(i % 7), 2.0, float(i % 7)] for i in range(40)}  # one direction has variance
    single = {500: [1.0, 2.0]}
    data = [(i, v, 0) for part in (wide, flat, single) for i, v in part.items()]
    got = {r["vec_id"]: r for r in rows(whitening.whiten(spark.createDataFrame(data, VECTORS)))}
    check_whitening(got, wide, 32)
    check_whitening(got, flat, 32)
    assert got[100]["whitened"][1:] == [None, None] and got[100]["dim"] == 3
    assert got[500]["whitened"] == [None, None] and got[500]["explained"] == [None, None] and got[500]["deviation"] == 0
    twice = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0, 1.0], 0)], VECTORS))
    assert sorted(str(r["vec_id"]) for r in rows(twice)) == ["1", "1", "None"]


def test_whitening_of_huge_entries_stays_exact(spark):
    data = {i: [1e12 * (i % 5), -3e9 * i, 0.25 * i] for i in range(50)}
    kept = {i: [max(-2**34, min(2**34, c)) for c in v] for i, v in data.items()}
    got = {r["vec_id"]: r for r in rows(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in data.items()],
                                                                              "vec_id long, embedding array<double>, l int")))}
    x = {k: [math.floor(64 * c) + 1000000 for c in v] for k, v in kept.items()}
    total = [sum(v[i] for v in x.values()) for i in range(3)]
    assert all(int(got[k]["deviation"]) == sum((50 * c - s) ** 2 for c, s in zip(v, total, strict=True)) for k, v in x.items())


def test_whitening_query(spark):
    got = rows(queries.op11_whitening(spark, SF_SMALL))
    source = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    n, deviation, cov, _ = brute_whitening(source)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == 32 * len(source) and {r["component"] for r in got} == set(range(1, 33))
    assert all(r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] < 1e-4
               and abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9 for r in got)


def test_whitening_of_nothing(spark):
    assert rows(whitening.whiten(spark.createDataFrame([], VECTORS))) == []
    assert rows(whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [NAN], 1)], VECTORS))) == []


# ---- 12

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute_search(items, docs, top=10):
    terms = [(d, collections.Counter(split(t))) for d, t in docs]
    sizes = [c.total() for _, c in terms]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in terms for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(split(t))
    out = {}
    for i, own in asked.items():
        found = []
        for (d, c), n in zip(terms, sizes, strict=True):
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:top]):
            out[i, k + 1] = (f[3], -f[0])
    return out


def search_rows(df):
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows(df)}
    assert len(got) == df.count()
    return got


ITEMS = [(1, "the cat sat"), (2, "Éa CAT, 42! cat"), (3, None), (4, ""), (None, "dog the"), (5, "a " * 3000 + "zebra the"), (1, "dog"),
         (6, "the"), (7, "nowhere")]
DOCS = [(10, "the cat the dog"), (11, "The CAT_sat on\x00the mat"), (12, None), (13, ""), (None, "dog dog dog"), (14, "éa Éa 42"),
        (10, "the cat the dog"), (15, "zebra " + "a " * 50000), (16, "the " * 20), (17, "a-b a.c"), (18, "-- !!"), (None, "the cat")]


@pytest.mark.parametrize("owners,block_items", [(1, 256), (4, 256), (3, 2)])
def test_search_against_brute_force(spark, owners, block_items):
    items = clashing(spark.createDataFrame(ITEMS, "item_id long, text string"))
    docs = clashing(spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3))
    got = search_rows(lexical.search(items, docs, owners=owners, block_items=block_items))
    want = brute_search(ITEMS, DOCS)
    assert got == want and len({k[0] for k in want}) == 5


@pytest.mark.parametrize("owners,top", [(4, 3), (6, 10)])
def test_search_drops_only_what_cannot_matter(spark, owners, top):
    rng = np.random.RandomState(5)
    words = [f"w{k}" for k in range(300)]
    chance = 1 / np.arange(1, 301)
    texts = [" ".join(rng.choice(words, rng.randint(0, 60), p=chance / chance.sum())) for _ in range(1500)]
    docs = list(enumerate(texts)) + [(5000 + k, texts[k % 7]) for k in range(200)]
    items = [(k, " ".join(rng.choice(words, 12, p=chance / chance.sum()))) for k in range(20)]
    got = search_rows(lexical.search(spark.createDataFrame(items, "item_id long, text string"),
                                     spark.createDataFrame(docs, "doc_id long, text string"), top=top, owners=owners))
    assert got == brute_search(items, docs, top)


def test_terms_of_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Wörd " * 1000 + "x" * 300 + " end. " + "y" * 40
    whole = lexical.count_terms(text.encode())
    for size in (7, 64, 1000):
        monkeypatch.setattr(lexical, "PORTION_BYTES", size)
        assert lexical.count_terms(text.encode()) == whole
    assert whole["wörd".encode()] == 1000 and whole[b"end"] == 1
    assert all(set(split(chr(c))) == {t.decode() for t in lexical.count_terms(chr(c).encode())} for c in range(300))


@pytest.mark.parametrize("items,docs", [([], DOCS), (ITEMS, []), (ITEMS, [(1, None)]), ([(1, "q")], DOCS), ([(1, "")], DOCS)])
def test_search_of_nothing(spark, items, docs):
    assert rows(lexical.search(spark.createDataFrame(items, "item_id long, text string"),
                               spark.createDataFrame(docs, "doc_id long, text string"))) == []


# ---- 13

def brute_products(data, every=100, top=10):
    """{query: [(score, id), ...]} over row positions; ids of a query's own row only are left out."""
    good = [(k, i, [math.floor(1024 * float(c)) for c in v]) for k, (i, v) in enumerate(data)
            if v and None not in v and np.isfinite(v).all()]
    out = collections.defaultdict(list)
    for k, i, q in good:
        if i is not None and i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j is None, j or 0, j)
                           for m, j, c in good if m != k and len(c) == len(q))
            out[i].append([(-f[0], f[3]) for f in found[:top]])
    return out


def check_products(df, data, every=100, top=10):
    got = collections.defaultdict(list)
    for r in rows(df):
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    want = brute_products(data, every, top)
    assert set(got) == {q for q, lists in want.items() if any(lists)}
    for q, lists in want.items():
        flat = sorted((k + 1, *hit) for own in lists for k, hit in enumerate(own))
        assert sorted(got[q], key=str) == sorted(flat, key=str)


@pytest.mark.parametrize("sizes", [{}, {"bucket": 16, "shelf": 64, "query_block": 4, "seeds": 5}, {"bucket": 7, "shelf": 1000, "seeds": 0}])
def test_top_products_against_brute_force(spark, sizes):
    rng = np.random.RandomState(6)
    centres = rng.randn(10, 8)
    data = [(k, [float(np.float32(c)) for c in (centres[k % 10] + 0.05 * rng.randn(8)) * 2.0 ** rng.randint(-6, 3)]) for k in range(700)]
    data += [(1000 + k, data[3][1]) for k in range(30)] + [(1100, None), (1200, []), (1300, [NAN] * 8), (1400, [None] * 8), (1500, [INF] * 8),
             (1600, [0.0] * 8), (1700, [1.0, 2.0]), (1701, [-1.0, -2.0]), (None, data[0][1]), (200, data[7][1]), (100, data[100][1]), (1800, [4.0])]
    df = clashing(spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3))
    check_products(top_products.search(df, **sizes), data)


def test_both_prunings_skip_and_verify(monkeypatch):
    rng = np.random.RandomState(7)
    x = (rng.randn(3000, 8) * 2000).astype(np.int32)
    x = x[np.argsort(-np.linalg.norm(x, axis=1))]

    def pack(v, first):
        n = len(v)
        length = np.linalg.norm(v, axis=1)
        return top_products.Pack({"dim": 8, "longest": float(length.max()), "places": np.arange(first, first + n).tobytes(),
                                  "uids": np.arange(first, first + n).tobytes(), "lengths": length.tobytes(), "vectors": v.tobytes()})

    q, b = pack((x[:40] * 1).astype(np.int32), 0), pack(x, 100)
    truth = q.x.astype(np.int64) @ b.x.astype(np.int64).T
    seen = []
    real = top_products._products
    monkeypatch.setattr(top_products, "_products", lambda *a: (lambda p: (seen.append(p.size), p)[1])(real(*a)))
    for share in (0.3, 0.6, 0.85, 0.97):
        least = (share * q.length * b.longest).astype(np.int64)
        seen.clear()
        i, j, score = top_products._visit(q, b, least)
        want = {(a, c): truth[a, c] for a, c in zip(*np.nonzero(truth >= least[:, None]), strict=True)}
        assert dict(zip(zip(i.tolist(), j.tolist(), strict=True), score.tolist(), strict=True)) == want
        assert sum(seen) < truth.size * (1 if share < 0.8 else 0.1)
    assert len(top_products._visit(q, b, (1.01 * q.length * b.longest).astype(np.int64))[0]) == 0


def test_products_beyond_doubles_are_exact(spark):
    data = [(k, [1e5 + k, -9e4 + 3 * k, 7.5]) for k in range(120)]
    check_products(top_products.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), every=10), data, every=10)


def test_top_products_of_nothing(spark):
    for data in ([], [(100, None)], [(101, [1.0])], [(100, [1.0])]):
        assert rows(top_products.search(spark.createDataFrame(data, "vec_id long, embedding array<float>"))) == []
