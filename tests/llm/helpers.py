"""Fixtures of the operators' tests: small tables with every awkward row."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def words_alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def prose(rng, n, vocab=400, prefix="w"):
    return " ".join(f"{prefix}{rng.randrange(vocab)}" for _ in range(n))


def frame(spark, rows):
    """Rows (doc_id, text) or longer, with columns whose names clash with the operators' own."""
    full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in ("doc", "component", "kept", "key", "size", "h", "part"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def corpus(seed=3, n=60):
    """Distinct texts, exact and near copies, shared passages, awkward rows."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(5, 120))) for i in range(n)]
    base = prose(rng, 150)
    rows += [(100 + i, base) for i in range(5)]
    for i in range(12):
        w = base.split()
        for _ in range(i):
            w[rng.randrange(len(w))] = f"z{rng.randrange(1000)}"
        rows.append((200 + i, " ".join(w)))
    passage = prose(rng, 60, prefix="p")
    rows += [(300 + i, f"{prose(rng, 10)} {passage} {prose(rng, 10)}") for i in range(8)]
    rows += [(400, None), (401, ""), (402, "   \t\n"), (403, "One two"), (404, "ONE  two"), (405, "é ü 漢字 \U0001F600"),
             (406, "a" * 3000), (407, "ab" * 2000), (408, prose(rng, 20_000)), (None, base), (None, None),
             (101, base), (5, prose(rng, 40))]
    return rows
