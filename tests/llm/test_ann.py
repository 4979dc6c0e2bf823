import numpy as np
import pytest
from pyspark.sql import functions as F

from cuecards.llm.ann import cosines, covered, nearest, perturbations

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, data string, key int, score double"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "", "", 0, 0.0) for i, v in vectors], SCHEMA)


def brute(vectors, is_query, k):
    ok = [(i, np.array(v, np.float64)) for i, v in vectors
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if is_query(q):
            best = {}
            for i, y in ok:
                if i != q and len(y) == len(x):
                    best[i] = max(best.get(i, -2), float(cosines(x[None], y[None])[0, 0]))
            out[q] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def answer(df, cond, **kw):
    out = {}
    for r in sorted(nearest(df, cond, **kw).collect(), key=lambda r: (r["query"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query"], [])) + 1
        out[r["query"]].append((r.vec, r.score))
    return out


def test_awkward_vectors_and_ties_are_exact_when_all_buckets_are_visited(spark):
    rng = np.random.default_rng(2)
    vs = [(i, rng.standard_normal(8).astype("f4").tolist()) for i in range(150)]
    vs += [(200 + i, [1.0] * 8) for i in range(40)]  # a hot bucket, many ties
    vs += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8),
           (305, [float("inf")] * 8), (None, [1.0] * 8), (306, [1.0, 2.0]), (307, [1.0, 2.1]), (310, [1.0] * 8), (310, [2.0] * 8)]
    cond = F.col("vec_id") % 5 == 0
    got, want = answer(table(spark, vs), cond, success=1.0, part=16), brute(vs, lambda i: i % 5 == 0, 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in got for a, b in zip(got[q], want[q], strict=True))


def test_recall_with_production_settings(spark):
    rng = np.random.default_rng(4)
    vs = [(i, rng.standard_normal(64).astype("f4").tolist()) for i in range(4000)]
    got = answer(table(spark, vs), F.col("vec_id") % 50 == 0)
    x = np.array([v for _, v in vs], np.float64)
    hit = 0
    for q in range(0, 4000, 50):
        s = cosines(x[q: q + 1], x)[0]
        s[q] = -2
        hit += len(set(np.argsort(-s)[:5].tolist()) & {i for i, _ in got[q]})
        assert len(got[q]) == 5
    assert hit / (80 * 5) >= 0.9


def recall(spark, vs, step, only=lambda q: True, **kw):
    got = answer(table(spark, vs), F.col("vec_id") % step == 0, **kw)
    x = np.array([v for _, v in vs], np.float64)
    hit = n = 0
    for q in filter(only, range(0, len(vs), step)):
        s = cosines(x[q: q + 1], x)[0]
        s[q] = -2
        hit += len(set(np.argsort(-s)[:5].tolist()) & {i for i, _ in got[q]})
        n += 5
    return hit / n


def test_isolated_vectors_beside_copies(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((40, 64))
    x = rng.standard_normal((4000, 64))
    copies = np.arange(4000) % 5 < 3  # 60 per cent, in groups of 60
    x[copies] = base[np.arange(copies.sum()) % 40] + 1e-3 * rng.standard_normal((copies.sum(), 64))
    vs = [(i, v.astype("f4").tolist()) for i, v in enumerate(x)]
    assert recall(spark, vs, 49, lambda q: not copies[q], rows_per_bucket=8) >= 0.9


def test_queries_whose_buckets_cannot_be_enumerated(spark):
    rng = np.random.default_rng(7)
    vs = [(i, rng.standard_normal(64).astype("f4").tolist()) for i in range(3000)]
    # so small buckets take as many projections as 10^8 rows with the default
    assert recall(spark, vs, 150, rows_per_bucket=0.03) >= 0.9


def test_covered_is_the_sum_of_the_visited_buckets():
    place = np.array([0.1, 2.5, -1.9])
    rng = np.random.default_rng(1)
    codes = perturbations(place, 0.6, 0.8)
    for spread in (0.05, 0.6, 1.5):
        moved = np.floor(place + spread * rng.standard_normal((100_000, 3))).astype(int)
        share = np.mean([m in {tuple(c) for c in codes} for m in map(tuple, moved[:5000])])
        assert abs(covered(place, codes, spread) - share) < 0.04


@pytest.mark.parametrize("vs", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0])]])
def test_tiny_tables(spark, vs):
    assert {q: [i for i, _ in v] for q, v in answer(table(spark, vs), F.col("vec_id") % 50 == 0).items()} == (
        {0: [1]} if len(vs) > 1 else {})


def test_buckets_come_in_order_of_estimated_success():
    place = np.array([0.1, 2.5, -1.9])
    codes = perturbations(place, 0.6, 0.95)
    assert (codes[0] == np.floor(place)).all() and len({tuple(c) for c in codes}) == len(codes)
    assert len(perturbations(place, 0.6, 0.5)) < len(codes)
