import math
import random
import zlib
from collections import Counter

import numpy as np

from cuecards.llm.langid import ORDER, Model, grams, identify, normalise
from tests.llm.helpers import frame

PARTS = {"aa": "the ing er on and re", "bb": "der sch ung ich ein zu", "cc": "que eau ment les oi tre"}


def text(rng, lang, n):
    parts = PARTS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def rows(n=240):
    rng = random.Random(1)
    langs = [rng.choice(list(PARTS)) for _ in range(n)]
    out = [(i, text(rng, g, rng.randrange(3, 60)), g if i % 11 else None, "s", 1) for i, g in enumerate(langs)]
    junk = [(9000 + i, "".join(rng.choices("xqzjwkvÿþжщ", k=400)), None, "s", 1) for i in range(3)]
    return out + junk + [(9100, None, "aa", "s", 1), (9101, "", None, "s", 1), (9102, "12 !? 漢"[:5], None, "s", 1), (9103, "12 !?", "bb", "s", 1),
                         (9104, text(rng, "aa", 20_000), None, "s", 1), (None, text(rng, "bb", 30), None, "s", 1), (5, out[5][1], out[5][2], "s", 1)], langs


def test_held_out_accuracy_rejection_and_awkward_rows(spark):
    data, langs = rows()
    got = identify(frame(spark, data)).collect()
    assert len(got) == len(data)
    by = {r.doc: r for r in got}
    tested = [i for i in range(240) if held_out(i)]
    assert sum(by[i].lang_pred == langs[i] for i in tested) / len(tested) > 0.97
    assert all(r.held_out == (r.doc is not None and held_out(r.doc)) for r in got) and all(0 <= r.score <= 1 for r in got)
    assert {by[i].lang_pred for i in (9100, 9101, 9103)} == {"und"} and all(by[i].rejected for i in (9100, 9101, 9103))
    assert by[9104].lang_pred == "aa" and by[None].lang_pred == "bb"
    assert all(by[9000 + i].rejected for i in range(3)) and not any(by[i].rejected for i in range(240))


def test_a_divided_model_gives_the_same_results(spark):
    data, _ = rows()
    rng = random.Random(8)
    rare = [(20_000 + i, " ".join("".join(rng.choices("łąkęśćżnoda", k=5)) for _ in range(40)), "dd", "s", 1) for i in range(8)]
    data = [*data, *rare, data[0], (data[1][0], data[2][1], "cc", "s", 1)]
    src = frame(spark, data)
    whole = sorted(map(tuple, identify(src).collect()), key=repr)
    for most in (600, 8000):  # within a language, and by language
        got = sorted(map(tuple, identify(src, max_cells=most).collect()), key=repr)
        assert len(got) == len(whole)
        for a, b in zip(whole, got, strict=True):
            assert a[:4] == b[:4] and a[6] == b[6]
            assert math.isclose(a[4], b[4], rel_tol=1e-6) and math.isclose(a[5] or 0, b[5] or 0, rel_tol=1e-6)
        assert {r[3] for r in got if r[0] in {x[0] for x in rare}} == {"dd"}


def test_no_training_text(spark):
    got = identify(frame(spark, [(1, "some text", None, "s", 1), (2, None, "aa", "s", 1)])).collect()
    assert {r.lang_pred for r in got} == {"und"}
    assert identify(frame(spark, [])).collect() == []


def test_probabilities_are_kneser_ney_and_sum_to_one():
    rng = random.Random(3)
    counts = {g: Counter() for g in (0, 1)}
    for g, lang in enumerate(("aa", "bb")):
        raw = text(rng, lang, 300).encode()
        units, begin, _ = normalise(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        counts[g].update(grams(units, begin)[0].tolist())
    flat = [(g, k, n) for g in counts for k, n in counts[g].items()]
    m = Model(["aa", "bb"], *(np.array(x) for x in zip(*flat, strict=True)))
    chars = sorted({k & 0xFFFF for _, k, _ in flat})

    def slow(g, key, order):
        """The recursive formula, from counts of distinct left extensions."""
        if order == 0:
            return 1 / m.size
        table = counts[g]
        for o in range(ORDER - 1, order - 1, -1):
            table = Counter(k & (1 << 16 * o) - 1 for k in table)
        one, two = (sum(n == x for n in table.values()) for x in (1, 2))
        d = min(0.9, max(0.1, one / (one + 2 * two)))
        same = {k: n for k, n in table.items() if k >> 16 == key >> 16}
        low = slow(g, key & (1 << 16 * (order - 1)) - 1, order - 1)
        if not same:
            return low
        return max(table.get(key, 0) - d, 0) / sum(same.values()) + d * len(same) / sum(same.values()) * low

    some = [k for _, k, _ in flat[::37]] + [(flat[0][1] >> 16 << 16) | 0x7A7A, 0x1234_5678_9ABC_DEF0]
    fast = m.log_prob(np.array(some, np.uint64), ORDER)
    for i, k in enumerate(some):
        for g in (0, 1):
            assert math.isclose(math.exp(fast[i, g]), slow(g, k, ORDER), rel_tol=1e-4)
    context = flat[5][1] >> 16 << 16
    total = np.exp(m.log_prob(np.array([context | c for c in chars], np.uint64), ORDER)).sum(axis=0)
    assert (total <= 1 + 1e-6).all() and (total > 0.9).all()
