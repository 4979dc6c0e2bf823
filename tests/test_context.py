import pytest
from pyspark.sql import functions as F

from cuecards.functions import parse_line_id, render_labels, parse_labels
from cuecards.functions.text import fill_nulls
from cuecards.operators import context
from cuecards.operators.context import attach_context, attach_context_labelled, position_in_scene


def brute(rows, threshold, k=3):
    rows = sorted(rows, key=lambda r: (r["jb_id"], r["cc_id"], r["ids"], r["id"]))
    out = {}
    for i, r in enumerate(rows):
        c = r["content"]
        if i >= k and len(c) < threshold:
            c = c + "".join(rows[i - j]["content"] for j in range(1, k + 1))
        out[r["id"]] = c
    return out


@pytest.mark.parametrize("n_ranges", [1, 2, 3, 7])
def test_context_matches_global_walk(spark, lines_df, n_ranges):
    p = parse_line_id(lines_df)
    exp = brute([r.asDict() for r in p.collect()], threshold=10)
    got = {r.id: r.content for r in attach_context(p, threshold=10, n_ranges=n_ranges).collect()}
    assert got == exp
    # rows 1-3 of the whole table never change; a two-line script reaches back
    assert got["100_0001_A_2"] == "hi"
    assert got["101_0001_A_2"] == "y" + "x" + "ok" + "hi"
    # length exactly at the threshold is unchanged
    assert got["102_0001_A_2"] == "exactly10!"


def test_context_on_conversations(spark):
    from cuecards.sources.adapters import lines_from_conversations

    p = parse_line_id(lines_from_conversations(spark, "/root/testdata/sf0.001"))
    exp = brute([r.asDict() for r in p.collect()], threshold=200)
    for n in (1, 5, 16):
        got = {r.id: r.content for r in attach_context(p, threshold=200, n_ranges=n).collect()}
        assert got == exp


def test_context_does_not_depend_on_exchange_reuse(spark):
    from cuecards.sources.adapters import lines_from_conversations

    p = parse_line_id(lines_from_conversations(spark, "/root/testdata/sf0.001"))
    exp = brute([r.asDict() for r in p.collect()], threshold=200)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for n in (None, 6):
            out = attach_context(p, threshold=200, n_ranges=n)
            assert {r.id: r.content for r in out.collect()} == exp
            assert "ReusedExchange" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_context_plan_shuffles_the_lines_once(spark):
    from cuecards.sources.adapters import lines_from_conversations

    p = parse_line_id(lines_from_conversations(spark, "/root/testdata/sf0.001"))
    out = attach_context(p, threshold=200)
    out.collect()  # the final adaptive plan is attached to this DataFrame
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    shuffles = [i for i, ln in enumerate(plan) if "Exchange " in ln and "hashpartitioning(_part" in ln]
    # the whole lines once; the other branch sends the last rows of each range and task
    whole = [i for i in shuffles if "REPARTITION_BY_NUM" in plan[i]]
    assert len(whole) == 1 and not any("rangepartitioning" in ln for ln in plan)
    limited = [i for i in shuffles if "WindowGroupLimit" in plan[i + 1] and "Partial" in plan[i + 1]]
    assert len(limited) == 1


def test_ranges_of_null_tied_and_empty_keys(spark):
    rows = [(None, None, None, None), (None, 2, 1, "a"), (1, None, 5, "\u00e9\"x"), (1, 1, 1, "b"), (1, 1, 1, "b"),
            (1, 1, 2, None), (2, 1, 1, "z"), (2, 1, 1, "zz"), (3, 0, 0, "q"), (3, 0, 0, "q")]
    df = spark.createDataFrame(rows, "jb_id int, cc_id int, ids int, id string")
    for n in (1, 3, 6, 50):
        bounds = context.range_bounds(df, n)
        assert len(bounds) <= n - 1 and len(set(bounds)) == len(bounds)
        at = context.range_of(bounds, F.struct(*context.ORDER), df.schema)
        got = df.select(*context.ORDER, at.alias("part")).orderBy(*context.ORDER).collect()
        parts = [r.part for r in got]
        assert parts == sorted(parts) and len(set(parts)) == len(bounds) + 1
        same = {}
        assert all(same.setdefault(tuple(r)[:4], r.part) == r.part for r in got)
    assert context.range_bounds(df.limit(0), 5) == []


def test_tied_rows_take_the_same_neighbours_in_every_cut(spark):
    # 40 rows under four keys, differing in their texts only: any cut gives the same contexts
    rows = [(1, 1, i % 4, "k", f"t{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "jb_id int, cc_id int, ids int, id string, content string")
    seen = {tuple(sorted(r.content for r in attach_context(df.repartition(p), threshold=10, n_ranges=n).collect()))
            for n in (1, 3, 4) for p in (1, 5)}
    assert len(seen) == 1
    assert attach_context(df.limit(0), threshold=10).count() == 0


def test_labelled_context(spark, lines_df):
    d = parse_line_id(lines_df)
    d = fill_nulls(d, "99", "99").withColumn("labels", parse_labels("emotions"))
    d = d.withColumn("labels_text", render_labels("labels"))
    got = {r.id: r.content for r in attach_context_labelled(d, threshold=10, n_ranges=3).collect()}
    # previous line (y) has no label -> plain form; "x" row is 4th with label
    assert got["101_0001_A_1"] == "x" + "ok" + "hi" + "first line is long enough"
    assert got["101_0001_A_2"] == "y"  # unlabelled rows never change
    # z: previous line y unlabelled -> plain; 102_..._2 is 10 long -> unchanged
    assert got["102_0001_A_1"] == "z" + "y" + "x" + "ok"


def test_position_in_scene(spark, lines_df):
    got = {r.id: (r.pos, r.scene_rows) for r in position_in_scene(parse_line_id(lines_df), block=1).collect()}
    assert got["100_0001_A_2"] == (2, 2) and got["100_0002_A_3"] == (1, 1)


def test_encode_combos_dense_text_order(spark):
    # valid, junk (level 7, seven entries) and null label vectors
    labels = [[0, 1, 0, 0, 0, 0], [3, 0, 0, 0, 0, 0], [0, 1, 0, 0, 0, 0], [7, 0, 0, 0, 0, 0],
              [0, 0, 0, 0, 0, 0, 1], None, [0, 0, 0, 0, 0, 0]]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(labels)], "id string, labels array<int>")
    got = {r.id: r.combo for r in context.encode_combos(df).collect()}
    texts = sorted({"[" + ", ".join(map(str, v)) + "]" for v in labels if v is not None})
    want = {str(i): (texts.index("[" + ", ".join(map(str, v)) + "]") if v is not None else None)
            for i, v in enumerate(labels)}
    assert got == want


def brute_scoped(rows, threshold, group, k=3):
    rows = sorted(rows, key=lambda r: (r["jb_id"], r["cc_id"], r["ids"], r["id"]))
    out = {}
    for i, r in enumerate(rows):
        c = r["content"]
        same = [rows[i - j] for j in range(1, k + 1)
                if i - j >= 0 and all(rows[i - j][g] == r[g] for g in group)]
        if len(same) == k and len(c) < threshold:
            c = c + "".join(p["content"] for p in same)
        out[r["id"]] = c
    return out


@pytest.mark.parametrize("scope,group", [("script", ["jb_id"]), ("scene", ["jb_id", "cc_id"])])
def test_scoped_context_restarts_per_group(spark, scope, group):
    from cuecards.sources.adapters import lines_from_conversations

    p = parse_line_id(lines_from_conversations(spark, "/root/testdata/sf0.001"))
    exp = brute_scoped([r.asDict() for r in p.collect()], 200, group)
    for n in (1, 5):
        got = {r.id: r.content for r in attach_context(p, threshold=200, scope=scope, n_ranges=n).collect()}
        assert got == exp
