import itertools
import random

from cuecards.llm.components import connected_components
from cuecards.llm.minhash import near_duplicates
from tests.llm.helpers import corpus, frame, prose, words_space


def shingles(text, k):
    w = words_space(text)
    return {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent=80):
    """Component of each row: rows are nodes, linked by similarity or a shared id."""
    sets = [shingles(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if rows[i][0] is None or rows[j][0] is None:
            continue
        a, b = sets[i], sets[j]
        if rows[i][0] == rows[j][0] or a and b and 100 * len(a & b) >= percent * len(a | b):
            up[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted((r[0] is None, r[0] or 0, len(sets[i]), low.get(find(i))) for i, r in enumerate(rows))


def found(df, **kw):
    return sorted((r.doc is None, r.doc or 0, r.n_shingles, r.component) for r in near_duplicates(df, **kw).collect())


def test_components_against_all_pairs(spark):
    rows = corpus()
    assert found(frame(spark, rows), shingle=4) == brute(rows, 4)
    kept = near_duplicates(frame(spark, rows)).collect()
    assert all(r.kept == (r.doc is None or r.doc == r.component) for r in kept)


def test_group_of_near_copies_below_and_above_the_threshold(spark):
    # one base, 80 variants from 2 to 20 edits: chains, near misses and outsiders in the same buckets
    rng = random.Random(8)
    base = prose(rng, 80, vocab=5000).split()
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    assert found(frame(spark, rows), shingle=4, slots=1 << 10) == brute(rows, 4)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 299), (300, 299)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 299: 299, 300: 299}
