import numpy as np
import pytest

from cuecards.llm.mixing import mix, pivot
from tests.llm.helpers import corpus, frame, words_space


def wanted(sizes, weights=(5, 2, 1), top=3):
    """Targets by the stated rule, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > top * sizes[s] + 1e-9]
        if not over:
            return {s: capped.get(s, w[s] * level) for s in names}
        capped |= {s: top * sizes[s] for s in over}


def rows_of(sources):
    rows = [(r[0], r[1], "en", sources[i % len(sources)], 1) for i, r in enumerate(corpus())]
    return rows + [rows[3]] * 3 + [(5, "two words", "en", None, 1), (7000, "solo", "en", "tiny", 1)]


@pytest.mark.parametrize("kw", [{}, {"bucket": 4, "fan_in": 2}])
def test_targets_copies_and_reruns(spark, kw):
    rows = rows_of(["b", "a", "a", "a", "é", "Z"])
    got = mix(frame(spark, rows), **kw).collect()
    assert len(got) == len(rows)
    sizes, taken, largest, per_key = {}, {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        per_key.setdefault((r.doc, r.source, r.text_key), set()).add(r.copies)
    assert sorted(r.size for r in got) == sorted(len(words_space(r[1])) for r in rows)
    goal = wanted(sizes)
    for r in got:
        assert abs(r.target - goal[r.source]) < 1e-6 and r.source_size == sizes[r.source] and 0 <= r.copies <= 3
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 3 * largest[s]  # equal rows move together, three at most here
    assert all(len(v) == 1 for v in per_key.values())
    again = mix(frame(spark, rows).repartition(5), **kw).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_nothing_to_take(spark):
    assert mix(frame(spark, [])).collect() == []
    got = mix(frame(spark, [(1, None, None, "a", 1), (2, "", None, None, 1)])).collect()
    assert [(r.target, r.copies) for r in got] == [(0.0, 0), (0.0, 0)]


def test_pivot_keeps_the_mass_and_the_expectation():
    rng = np.random.default_rng(0)
    mass, p = rng.integers(1, 500, 40).astype(float), np.full(40, 0.3)
    mean = np.zeros(40)
    for seed in range(400):
        out = pivot(rng.integers(0, 1 << 62, 40).astype(np.uint64), mass, p, seed)
        assert ((out > 0) & (out < 1)).sum() <= 1 and abs((mass * out).sum() - (mass * p).sum()) < 1e-6
        mean += out / 400
    assert abs(mean - 0.3).max() < 0.12
