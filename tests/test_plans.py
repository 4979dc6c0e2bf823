"""Plan shape of every registered query.

A ``SinglePartition`` exchange moves its input into one task.  It is allowed
only directly above an aggregate (a global total, or a table already reduced
to one row per group / sub-bucket) or a limit; never above a full-size input.
Nested-loop and cartesian joins are never allowed.
"""

from __future__ import annotations

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
MODEL_FITS = {"train_regressor", "train_classifier", "cv_ensemble", "stack", "stack_oof"}
REDUCED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "LocalLimit", "GlobalLimit",
           "TakeOrderedAndProject", "CollectLimit")


def _unwrap(node):
    while node.nodeName().startswith(("WholeStageCodegen", "InputAdapter")):
        node = node.children().apply(0)
    return node


def _walk(node):
    yield node
    kids = node.children()
    for i in range(kids.size()):
        yield from _walk(kids.apply(i))


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield {name: fn(spark, SF)._jdf.queryExecution().executedPlan()
               for name, fn in queries().items() if name not in MODEL_FITS}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_single_partition_only_above_reduced_input(static_plans):
    bad, seen = [], set()
    for name, plan in static_plans.items():
        for node in _walk(plan):
            if node.nodeName() == "Exchange" and node.outputPartitioning().toString().startswith("SinglePartition"):
                seen.add(name)
                child = _unwrap(node.children().apply(0)).nodeName()
                if child not in REDUCED:
                    bad.append((name, child))
    assert not bad, bad
    # global totals and the split offset tables do use them: the walk sees them
    assert {"cut_share", "template_report"} <= seen, seen


def test_no_nested_loop_or_cartesian_join(static_plans):
    bad = [(name, node.nodeName()) for name, plan in static_plans.items() for node in _walk(plan)
           if node.nodeName() in ("BroadcastNestedLoopJoin", "CartesianProduct")]
    assert not bad, bad


PARTITION_INVARIANT = ["prepare_lines", "attach_context_labelled", "split_random", "fold_stratified", "build_vocab",
                       "encode_chars", "char_features", "weighted_vote", "rank_vote", "model_corr", "label_pairs"]


@pytest.mark.parametrize("name", PARTITION_INVARIANT)
def test_same_rows_at_1_and_16_shuffle_partitions(spark, name):
    # hash orders, sorted collections and rounded totals: the result does not
    # depend on how rows are spread over tasks (so a recomputed task after an
    # executor loss gives the same rows)
    fn = queries()[name]
    got = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, fn(spark, SF).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1]


def test_lookup_tables_have_one_row_per_code_point(spark):
    from cuecards.operators.encode import one_per_code_point

    t = spark.createDataFrame([("a", 2), ("a", 1), ("bc", 3), ("", 4), ("\U0001F600", 5)], "token string, v int")
    assert sorted(map(tuple, one_per_code_point(t, "v").collect())) == [("a", 1), ("\U0001F600", 5)]


@pytest.mark.parametrize("name", ["encode_chars", "pack_pair", "char_features"])
def test_encoding_shuffles_nothing(static_plans, name):
    # characters are looked up in one array (a scalar subquery): no row of the
    # texts crosses an exchange, and no character becomes a row
    nodes = [n.nodeName() for n in _walk(static_plans[name])]
    assert not {"Exchange", "BroadcastExchange", "Generate"} & set(nodes), nodes
