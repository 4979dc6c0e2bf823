import math
import random

import pytest

from cuecards.llm.decontam import decontaminate
from cuecards.llm.proximity import near_matches
from tests.llm.helpers import corpus, frame, prose, words_alnum


def brute(rows, items, n, slop, share):
    windows = {}
    for i, t in items:
        w = words_alnum(t)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(frozenset(w[s: s + n]), set()).add(i)
    out = []
    for d, t in (r[:2] for r in rows):
        w, near, found, places = words_alnum(t), set(), set(), {}
        for k, x in enumerate(w):
            places.setdefault(x, []).append(k)
        for terms, ids in windows.items():
            need = max(1, math.ceil(share * len(terms) - 1e-9))
            at = sorted(k for x in terms for k in places.get(x, ()))
            for j, s in enumerate(at):
                run = [k for k in at[j: j + n + slop] if k < s + n + slop]
                if len({w[k] for k in run}) >= need:
                    near |= set(range(s, run[-1] + 1))
                    found |= ids
        spans = [k for k in sorted(near) if k - 1 not in near], [k + 1 for k in sorted(near) if k + 1 not in near]
        out.append((d is None, d or 0, len(w), len(near), sorted(str(i) for i in found if i is not None), list(zip(*spans))))
    return sorted(out)


def case(spark):
    rng = random.Random(8)
    rows = corpus()
    items = [(i, rows[i][1]) for i in range(0, 30, 5)] + [(900, "One, two"), (901, None), (902, "!!!"), (None, rows[1][1]),
             (903, prose(rng, 12)), (903, prose(rng, 15)), (5, rows[5][1]), (904, "漢字"), (905, "a a a b b a a a a a c")]
    for k in range(12):  # passages with words inserted, replaced and moved
        w = words_alnum(rows[5 * (k % 6)][1])[:12]
        for _ in range(1 + k % 3):
            w.insert(rng.randrange(len(w) + 1), "added")
        if k % 2:
            w[rng.randrange(len(w))] = "changed"
        if k % 4 == 0:
            w[2], w[5 % len(w)] = w[5 % len(w)], w[2 % len(w)]
        rows.append((600 + k, f"{prose(rng, 8)} {' '.join(w)}. {prose(rng, 6)}"))
    rows.append((700, "c a b " * 40))
    bench = spark.createDataFrame([(*x, "y", 1) for x in items], "item_id long, text string, doc string, terms int")
    return rows, items, bench


@pytest.mark.parametrize("kw", [{}, {"segment": 300, "max_phrases": 7}, {"max_terms": 0, "slop": 0, "share": 1.0},
                                {"n": 4, "slop": 2, "share": 0.6}])
def test_against_every_run(spark, kw):
    rows, items, bench = case(spark)
    got = near_matches(frame(spark, rows), bench, **kw).collect()
    want = brute(rows, items, kw.get("n", 10), kw.get("slop", 4), kw.get("share", 0.8))
    assert sorted((r.doc is None, r.doc or 0, r.n_words, r.n_near, r.near_items, [(x.s, x.e) for x in r.near_spans])
                  for r in got) == want


def test_edited_passage_is_found_and_exact_hits_are_near(spark):
    rng = random.Random(3)
    passage = [f"term{i}" for i in range(40)]
    edited = [x for i, w in enumerate(passage) for x in ([w, "more"] if i % 7 == 3 else [w])]
    rows = [(1, " ".join(passage)), (2, " ".join(edited)), (3, prose(rng, 60)), (4, None), (5, "")]
    bench = spark.createDataFrame([(9, " ".join(passage))], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exact = {r.doc: r.n_hit for r in decontaminate(docs, bench).collect()}
    near = {r.doc: (r.n_near, r.near_items) for r in near_matches(docs, bench).collect()}
    assert exact == {1: 40, 2: 0, 3: 0, 4: 0, 5: 0}
    assert near == {1: (40, ["9"]), 2: (len(edited), ["9"]), 3: (0, []), 4: (0, []), 5: (0, [])}


def test_empty_tables(spark):
    rows, _, bench = case(spark)
    assert near_matches(frame(spark, []), bench).collect() == []
    clean = near_matches(frame(spark, rows), bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.n_near for r in clean)
