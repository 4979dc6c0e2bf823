import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cuecards.llm.spelling import near_words, neighbours, spelling_variants, word_crcs
from tests.llm.helpers import LOW, corpus, frame


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by definition."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, chars=6, least=5, modulus=199):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if h % modulus == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= chars and c >= least}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def texts(seed=1, n=250):
    """Few letters, so that near words abound, and counts that form chains."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abÀéÿ", k=rng.randrange(5, 10))) for _ in range(25)]
    vocab = []
    for i, w in enumerate(base):
        vocab += [w] * (1 + 5 ** (i % 4))
        for _ in range(6):
            k = rng.randrange(len(w))
            vocab += [w[:k] + rng.choice(["", "a", "bé", "×"]) + w[k + rng.randrange(2):]] * (1 + i % 3)
    return [(i, rng.choice([" ", "-", "1", "\n", "漢"]).join(rng.choice([w, w.upper(), w.title()]) for w in rng.choices(vocab, k=60)))
            for i in range(n)]


def test_same_as_comparing_all_words(spark):
    rows = texts() + corpus() + [(None, "abcdefgh " * 9), (7000, "abcdefg " * 6 + "abcdefghi " * 300),
                                 (7001, "chainaa " * 5 + "chainab " * 40 + "chainbb " * 300)]
    assert any(w[1] and w[2] != w[1] for w in brute(rows))
    for modulus in (199, 3):
        want = brute(rows, modulus=modulus)
        assert len(want) > 100
        assert got(spelling_variants(frame(spark, rows), modulus=modulus)) == want


def test_crowded_halves_are_cut_into_blocks(spark):
    """A block far smaller than the number of words that share a half."""
    rng = random.Random(4)
    words = sorted({"aaaa" + "".join(rng.choices("abc", k=rng.randrange(2, 6))) for _ in range(300)} | {"b" * k for k in range(6, 40)})
    vocab = spark.createDataFrame([(w, 1 + i % 7) for i, w in enumerate(words)], "word string, n long")
    want = {w: sum(one_edit(w, x) for x in words) for w in words}
    for block in (5, 60, 10_000):
        assert {r.word: r.n_near for r in neighbours(vocab, block).collect()} == {w: c for w, c in want.items() if c}


@pytest.mark.parametrize("seed", range(3))
def test_search_schemes_split_the_pairs(seed):
    rng = random.Random(seed)
    words = list({"".join(rng.choices("ab\U0001F600", k=rng.randrange(6, 9))) for _ in range(150)})
    asked = list({"".join(rng.choices("abc\U0001F600", k=rng.randrange(6, 9))) for _ in range(100)})
    first, last = near_words(words, asked, True), near_words(words, asked, False)
    assert len(set(first + last)) == len(first) + len(last)
    assert set(first + last) == {(i, j) for i, q in enumerate(asked) for j, w in enumerate(words) if one_edit(q, w)}


def test_very_long_words():
    a = "ab" * 4000
    words = [a, a + "b", a[:4000] + "c" + a[4000:], a[:100] + a[101:], "b" + a[1:], "z" * 50]
    assert sorted(near_words(words, words, True) + near_words(words, words, False)) == sorted(
        (i, j) for i, q in enumerate(words) for j, w in enumerate(words) if one_edit(q, w))


def test_crc_of_words():
    words = ["a", "é", "abcdef", "x" * 64, "y" * 65, "z" * 1000, "ab"]
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    size = np.array([len(w.encode()) for w in words])
    begin = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(words))], np.uint32)
    assert word_crcs(raw, np.cumsum(size) - size, size, begin).tolist() == [zlib.crc32(f"{i}:{w}".encode()) for i, w in enumerate(words)]


def test_empty_tables(spark):
    assert got(spelling_variants(frame(spark, []))) == []
    assert got(spelling_variants(frame(spark, [(1, None), (2, ""), (3, "short words only")]))) == []
