import itertools
import zlib

import pytest

from cuecards.llm.sharding import curve_places, shard
from tests.llm.helpers import corpus, frame


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    places, side = curve_places(dims, bits), 1 << bits
    cell_at = {p: c for c, p in enumerate(places)}
    assert sorted(places) == list(range(side ** dims))
    cells = [[cell_at[p] // side ** d % side for d in range(dims)] for p in range(side ** dims)]
    assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in itertools.pairwise(cells))


@pytest.mark.parametrize("n,subs", [(16, 256), (1, 4), (7, 1), (200, 256)])
def test_counts_slots_and_order(spark, n, subs):
    rows = [(r[0], r[1], ["en", "de", None][i % 3], f"s{i % 5}" if i % 4 else None, 1) for i, r in enumerate(corpus())]
    rows += [(5000 + i, "same", "en", "s1", 1) for i in range(80)]  # a cell with a third of all rows
    got = shard(frame(spark, rows), n_shards=n, sub_buckets=subs).collect()
    assert len(got) == len(rows)
    sizes = [sum(r.shard == s for r in got) for s in range(n)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(n):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.rank for r in ordered] == list(range(len(rows)))
    assert [r.place for r in ordered] == sorted(r.place for r in got)
    want = sorted((r[0] or -1, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc or -1, r.size, r.text_crc32) for r in got) == want


def test_empty_table(spark):
    assert shard(frame(spark, [])).collect() == []


def test_main_path_runs_no_python(spark):
    df = shard(frame(spark, [(1, "a", "en", "s", 1)]))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
