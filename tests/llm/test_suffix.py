import pytest

from cuecards.llm.suffix import remove_repeats
from tests.llm.helpers import corpus, frame


def brute(rows, length):
    """(id, bytes, spans, kept) per row, by every string of the length."""
    seen, out, judged = set(), [], {}
    # different texts of one id: the library orders them by a hash, so the fixtures have no shared strings there
    for key in sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows}):
        b = key[2].encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s: s + length]
            if w in seen:
                gone[s: s + length] = b"\1" * length
            seen.add(w)
        judged[key] = (len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x),
                       bytes(x for x, g in zip(b, gone, strict=True) if not g))
    for r in rows:
        out.append((r[0] is None, r[0] or 0, *judged[(r[0] is None, r[0] or 0, r[1] or "")]))
    return sorted(out)


def found(df, **kw):
    return sorted((r.id is None, r.id or 0, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
                  for r in remove_repeats(df, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"batches": 1}, {"batches": 7}, {"hot": 1}, {"length": 40, "k": 8}, {"length": 40, "k": 40}])
def test_against_every_string(spark, kw):
    rows = corpus()
    assert found(frame(spark, rows), **kw) == brute(rows, kw.get("length", 100))


def test_unique_ids_and_common_passage(spark):
    rows = [(i, t) for i, (_, t) in enumerate(corpus(5))]
    rows += [(1000 + i, f"{i:03d}" * (i % 7) + "common passage " * 9 + f"{i * i}") for i in range(60)]
    assert found(frame(spark, rows)) == brute(rows, 100)
    assert found(frame(spark, rows), hot=3, batches=2) == brute(rows, 100)


def test_empty_table_and_bad_arguments(spark):
    assert remove_repeats(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, []), length=10, k=11)
