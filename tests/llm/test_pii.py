import math
import random
import re

from pyspark.sql import functions as F

from cuecards.llm.expressions import prefix_sums
from cuecards.llm.pii import find_personal, sanitise
from tests.llm.helpers import corpus, frame

KINDS = ["email", "ip", "card", "phone"]
RULES = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, v):
    digits = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, r in zip(KINDS, RULES, strict=True) for m in re.finditer(r, text or "") if valid(k, m[0])]


def spans(xs):
    return [(x.kind, x.start, x.end) for x in xs]


def noise(seed, n):
    rng = random.Random(seed)
    bits = ["bob@mail.example.com", "a.b+c@x-y.org", "@", "a@b", "x@y.zz@q.r", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "1.2.3.4.5", "99",
            "4111111111111111", "4111 1111-1111 1111", "4111 1111 1111 1112", "6011000990139424", "1" * 30, "+1 (555) 010-9999", "+44.20.7946.0958",
            "+1 2", "+12345678901234567", "é", "漢", "\U0001F600", " ", " ", ", ", "\n", "-", "+", "word", "Name"]
    return [(i, "".join(rng.choices(bits, k=rng.randrange(1, 30)))) for i in range(n)]


def test_base_spans_against_the_stated_patterns(spark):
    rows = noise(1, 500) + corpus() + [(9000, "1" * 20_000), (9001, "1 " * 9000 + "x"), (9002, "1.2.3.4 " * 900), (9003, "a" * 5000 + "@"),
                                       (9004, "a.b@" + "c." * 3000 + "d"), (9005, "+1" + "(" * 5000 + "2")]
    out = find_personal(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert spans(r.base) in [base(t) for i, t in rows if i == r.doc]
        assert (r.text_key is not None) == bool(r.base)
        assert not r.terms or r.base


def test_prefix_sums(spark):
    for n in (0, 1, 2, 3, 10, 99, 100, 101, 1000):
        df = spark.range(1).select(F.expr(f"transform(filter(sequence(0, {n}), x -> x < {n}), x -> x * 3 + 1)").alias("a"))
        want = [0]
        for x in range(n):
            want.append(want[-1] + 3 * x + 1)
        assert df.select(prefix_sums(F.col("a")).alias("s")).first().s == want


def brute_terms(rows, reach=60, support=3, bits=4.0, generalise=1.0):
    """Terms near entities, straight from the definitions (texts where tokens
    are separated by blanks, one entity kind at a time being near)."""
    seen, df_t, df_e = {}, {}, {}
    where = []
    for i, (_, t) in enumerate(rows):
        for w in set(re.findall(r"[^\W\d_][^\W_]{2,}", t.lower())):
            df_t[w] = df_t.get(w, 0) + 1
        own = set()
        for k, r in zip(KINDS, RULES, strict=True):
            ms = list(re.finditer(r, t))
            for n, m in enumerate(ms):
                if not valid(k, m[0]):
                    continue
                e = (k, m[0].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", m[0]))
                own.add(e)
                lo = max(ms[n - 1].end() if n else 0, m.start() - reach)
                hi = min(ms[n + 1].start() if n + 1 < len(ms) else len(t), m.end() + reach)
                for x in re.finditer(r"[^\W\d_][^\W_]{2,}", t):
                    token = next(y for y in re.finditer(r"\S+", t) if y.start() <= x.start() < y.end())
                    if "@" in token[0] or not (lo <= token.start() and token.end() <= hi):
                        continue
                    where.append((i, e, x[0].lower(), x.start(), x.end()))
                    seen.setdefault((e, x[0].lower()), set()).add(i)
        for e in own:
            df_e[e] = df_e.get(e, 0) + 1
    out = {i: set() for i in range(len(rows))}
    for i, e, w, s, end in where:
        at = seen[e, w]
        if len({rows[j][1] for j in at}) >= support:
            unknown = math.log2(df_t[w] / len(at))
            if math.log2(len(rows) / df_e[e]) - unknown >= bits and unknown <= generalise:
                out[i].add((s, end))
    return [sorted(out[i]) for i in range(len(rows))]


def people(n=400):
    """Some names stand beside one address again and again, common words beside many."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(60)}ord" for _ in range(rng.randrange(5, 40))]
        if i % 25 == 0:
            words.insert(rng.randrange(len(words)), "write to Marlowe at marlowe@mail.example.com please")
        if i % 40 == 1:
            words.insert(rng.randrange(len(words)), f"call Vesper {'Lind ' * (i % 80 == 1)}on +44 20 7946 0958 today")
        if i % 10 == 3:
            words.insert(0, f"user{i}@mail.example.com")
        if i % 50 == 7:
            words.append("Lind")
        rows.append((i, " ".join(words)))
    return rows + [(n + i, rows[0][1]) for i in range(5)]


def test_terms_by_definition(spark):
    rows = people()
    want = brute_terms(rows)
    assert 20 < sum(map(bool, want)) < 60
    got = {r.doc: [(t.start, t.end) for t in r.terms] for r in find_personal(frame(spark, rows)).collect()}
    assert got == {r[0]: w for r, w in zip(rows, want, strict=True)}
    named = [rows[i][1][s:e] for i, w in enumerate(want) for s, e in w]
    assert {"Marlowe", "Vesper"} <= set(named)


def test_sanitised_texts(spark):
    rows = people() + [(900, "0 4111111111111111 \U0001F600 a@b.cd, +1 555 010 9999"), (901, None), (902, ""), (903, "plain words")]
    out = {r.doc_id: r.text for r in sanitise(frame(spark, rows)).collect()}
    assert len(out) == len(rows) and out[901] is None and out[902] == "" and out[903] == "plain words"
    assert out[900] == "[CARD] \U0001F600 [EMAIL], [PHONE]"  # the 0 belongs to the card: 17 digits that pass
    for i, t in rows[:400]:
        assert "@" not in out[i] and "Marlowe" not in out[i] and "Vesper" not in out[i]
        if not base(t):
            assert out[i] == t
    assert sanitise(frame(spark, rows)).columns == frame(spark, rows).columns


def test_empty_table(spark):
    assert find_personal(frame(spark, [])).collect() == []
