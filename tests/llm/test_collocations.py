import random
import re
from collections import Counter

import numpy as np

from cuecards.llm.collocations import _bloom, _passes, collocations
from tests.llm.helpers import LOW, corpus, frame


def brute(rows, support, longest=5, top=2000):
    """Everything counted in one dictionary per language, by the contract's words."""
    f, n = {}, Counter()
    for r in rows:
        lang = r[2] if len(r) > 2 and r[2] is not None else "und"
        f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i: i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = [p for p, a in counts.items() if len(p) > 1 and a >= support]
        beaten = set()
        for q in cand:
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    if 100 * counts[q] >= 100 * counts[q[i: i + m]]:
                        beaten.add(q[i: i + m])
        rows_ = []
        for p in cand:
            a = counts[p]
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if p not in beaten:
                rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, lf, rf) in enumerate(sorted(rows_)[:top]):
            out.append((lang, i + 1, p.decode(), -a, lf, rf, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed=5, n=300):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["Ünit", "漢字", "A-b", "\U0001F600", "Word", "wORD"]
    rows = []
    for i in range(n):
        bits = []
        for _ in range(rng.randrange(0, 60)):
            bits.append(rng.choice(["the quick brown fox jumps over", "New York", "of the", *vocab, *vocab[:6], *vocab[:3]]))
            bits.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "; x ", "!?"]))
        rows.append((i, "".join(bits), rng.choice(["en", "en", "en", "de", None])))
    return rows


def test_same_as_counting_everything(spark):
    rows = texts() + [(900, None, "en"), (901, "", "fr"), (902, " .,. ", "fr"), (903, "x " * 3000, "fr"), (None, "of the of the", "en")]
    want = brute(rows, 12)
    assert len(want) > 30
    assert got(collocations(frame(spark, rows), support=12)) == want


def test_shards_of_files_and_small_bitmap(spark, tmp_path):
    """Many shards with uneven shares; a filter so small that false candidates pass."""
    rows = texts(6, 200)
    frame(spark, rows).repartition(9).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    want = brute(rows, 10)
    for bits in (8, 26):
        assert got(collocations(docs, support=10, bits=bits, shards=7)) == want
    assert got(collocations(docs, support=10, top=3)) == brute(rows, 10, top=3)
    assert got(collocations(docs, support=10, longest=2)) == brute(rows, 10, longest=2)


def test_awkward_rows_ties_and_copies(spark):
    rows = [(i, "same line here, same line here", "en") for i in range(50)] + corpus()
    assert got(collocations(frame(spark, rows), support=20)) == brute(rows, 20)


def test_empty_table(spark):
    assert got(collocations(frame(spark, []))) == []
    assert got(collocations(frame(spark, [(1, None), (2, "")]))) == []


def test_filter_holds_every_hash(spark):
    h = np.random.default_rng(1).integers(-2**63, 2**63, 500)
    m = _bloom(spark.createDataFrame([(int(x),) for x in h], "h long"), 12)
    assert len(m) == 64 and _passes(m, h.view(np.uint64)).all()
    assert 0 < _passes(m, np.random.default_rng(2).integers(0, 2**63, 4000).astype(np.uint64)).mean() < 0.15
