import random

import pytest

from cuecards.llm.decontam import decontaminate
from tests.llm.helpers import corpus, frame, prose, words_alnum


def brute(rows, items, n):
    windows = {}
    for i, t in items:
        w = words_alnum(t)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[s: s + n]), set()).add(i)
    out = []
    for d, t in (r[:2] for r in rows):
        w, hit, found = words_alnum(t), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if (x := tuple(w[s: s + size])) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[x]
        out.append((d is None, d or 0, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out)


def case(spark):
    rng = random.Random(6)
    rows = corpus()
    items = [(i, rows[i][1]) for i in range(0, 40, 3)] + [(900, "One, two"), (901, None), (902, "!!!"), (None, rows[1][1]),
             (903, prose(rng, 12)), (903, prose(rng, 15)), (3, rows[3][1]), (904, "漢字"), (905, "w1")]
    rows += [(500 + k, f"{prose(rng, 9)} {' '.join(words_alnum(rows[3 * (k % 9)][1])[:14])}. {prose(rng, 7)}") for k in range(20)]
    bench = spark.createDataFrame([(*x, "y", 1) for x in items], "item_id long, text string, doc string, terms int")
    return rows, items, bench


@pytest.mark.parametrize("kw", [{}, {"segment": 300}, {"max_phrases": 7}, {"max_terms": 0}, {"n": 3}])
def test_against_every_window(spark, kw):
    rows, items, bench = case(spark)
    got = decontaminate(frame(spark, rows), bench, **kw).collect()
    assert sorted((r.doc is None, r.doc or 0, r.n_words, r.n_hit, r["items"]) for r in got) == brute(rows, items, kw.get("n", 10))
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)


def test_empty_tables(spark):
    rows, _, bench = case(spark)
    assert decontaminate(frame(spark, []), bench).collect() == []
    clean = decontaminate(frame(spark, rows), bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated for r in clean)
