import random

import pytest

import corpus_pipeline as cp
from cuecards.llm import registry
from tests.llm.helpers import frame
from tests.llm.test_langid import text
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    rng = random.Random(9)
    base, leak = text(rng, "aa", 80), text(rng, "aa", 40)
    rows = [(i, text(rng, rng.choice(["aa", "bb"]), 40), None, f"s{i % 4}", 1) for i in range(60)]
    rows = [(i, t, "aa" if "the" in t or "ing" in t else "bb", s, n) for i, t, _, s, n in rows]
    rows += [(100 + i, base + (f" x{i}" if i % 2 else ""), "aa", "s1", 1) for i in range(6)]
    rows += [(200, f"{text(rng, 'bb', 30)} {leak}", "bb", "s2", 1), (300, None, "aa", "s1", 1), (301, "12 34", "bb", None, 1),
             (None, text(rng, "aa", 30), "aa", "s0", 1), (None, text(rng, "bb", 30), None, "s0", 1), (7, rows[7][1], "aa", "s3", 1),
             (400, "".join(rng.choices("xqzjwkvÿþжщ", k=500)), None, "s1", 1)]
    return rows, leak, frame(spark, rows)


def keys(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())


def all_keys(rows):
    return sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows)


def test_language_stage_drops_what_it_rejects_and_nothing_else(spark, docs):
    rows, _, df = docs
    out = cp.keep_known_languages(spark, df, SF)
    assert out.columns == df.columns
    assert keys(out) == all_keys([r for r in rows if r[0] not in (300, 301, 400)])


def test_dedup_stage_keeps_one_of_each_group(spark, docs):
    rows, _, df = docs
    comp = {d: c for n, d, _, c in brute(rows, 5) if not n}
    out = cp.drop_near_copies(spark, df, SF)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    assert sorted(d for d in got if d is not None) == sorted(set(comp.values())) and got.count(None) == 2


def test_dedup_stage_judges_ids_with_several_texts_and_rows_without_id(spark):
    rng = random.Random(3)
    a, b, c, e = (text(rng, "aa", 60) for _ in range(4))
    rows = [(5, a), (5, b), (9, c), (None, e), (None, e), (12, c + " x"), (None, a + " y"), (5, b), (13, None), (None, ""), (None, "")]
    out = cp.drop_near_copies(spark, frame(spark, rows), SF)
    assert keys(out) == all_keys([(5, a), (5, b), (9, c), (None, e), (13, None), (None, ""), (None, "")])


def test_decontamination_stage(spark, docs, tmp_path):
    rows, leak, df = docs
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = cp.drop_contaminated(spark, df, str(tmp_path))
    assert out.columns == df.columns and keys(out) == all_keys([r for r in rows if r[0] != 200])


def test_mixing_stage_repeats_rows_as_decided(spark, docs):
    from cuecards.llm.mixing import mix

    _, _, df = docs
    out = cp.mix_sources(spark, df, SF)
    want = sum(r.copies for r in mix(df).collect())
    assert out.columns == df.columns and out.count() == want
    assert cp.mix_sources(spark, df.limit(0), SF).count() == 0


def test_stages_on_an_empty_table(spark, docs, tmp_path):
    _, leak, df = docs
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, step in cp.STAGES:
        assert step(spark, df.limit(0), str(tmp_path)).collect() == []


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "minhash_dedup", "decontaminate", "mix_sources", "hilbert_shards"]
    got = cp.run(spark, SF).collect()
    sizes = [sum(r.shard == s for r in got) for s in range(16)]
    assert got and max(sizes) - min(sizes) <= 1
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(16) for i in range(sizes[s])]


def test_every_operator_is_registered_once():
    numbers = sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLE) <= set(registry.QUERIES)
