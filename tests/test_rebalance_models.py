import numpy as np
from pyspark.sql import functions as F

from cuecards.functions import parse_labels
from cuecards.operators import models, rebalance, splits
from cuecards.sources.files import write_table


def labelled(lines_df):
    return lines_df.where("emotions is not null").withColumn("labels", parse_labels("emotions"))


def test_rebalance_doubles_listed_buckets(spark, lines_df):
    d = labelled(lines_df)
    out = rebalance.rebalance(d, rewrite=lambda c: F.upper(c))
    got = sorted((r.id, r.bucket, r.copy_no, r.content) for r in out.collect())
    # 100_0001_A_2 = [1,0,0,0,0,3]: A1 (doubled, copy 2 rewritten) and F3 (once)
    assert ("100_0001_A_2", "A1", 2, "HI") in got and ("100_0001_A_2", "A1", 1, "hi") in got
    assert [g for g in got if g[0] == "100_0001_A_2" and g[1] == "F3"] == [("100_0001_A_2", "F3", 1, "hi")]
    assert ("100_0001_A_1", "none", 1, "first line is long enough") in got


def test_rewrite_copies_with_pandas(spark, lines_df):
    base = rebalance.rebalance(labelled(lines_df))

    def shout(pdf):
        pdf["content"] = pdf["content"] + "!"
        return pdf

    out = rebalance.rewrite_copies(base, shout)
    assert out.count() == base.count()
    assert {r.content for r in out.where("copy_no = 2").collect()} == {"hi!", "x!", "z!"}  # A1, B2, C3


def test_sample_unlabelled_is_reproducible(spark):
    rows = [(str(i), [0] * 6) for i in range(50)] + [("x", [1, 0, 0, 0, 0, 0])]
    df = spark.createDataFrame(rows, "id string, labels array<int>")
    a = [r.id for r in rebalance.sample_unlabelled(df, 7, seed=3).collect()]
    b = [r.id for r in rebalance.sample_unlabelled(df.repartition(5), 7, seed=3).collect()]
    assert a == b and len(a) == 7 and "x" not in a


def test_write_table_orders_at_sink(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", [1.5]), (0, "a", [0.25]), (1, "c", [3.0])],
                               "ordinal int, id string, s array<double>")
    write_table(df, str(tmp_path / "out"), order_by=["ordinal"], digits=2)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    body = [ln for ln in text.splitlines() if not ln.startswith("ordinal")]
    assert body == ["0\ta\t0.25", "1\tc\t3.00", "2\tb\t1.50"]


def test_score_table_batches(spark):
    df = spark.createDataFrame([(i, [float(i)] * 8) for i in range(300)], "id long, x array<float>")

    def make():
        def predict(x):
            return np.repeat(x[:, :1].astype(np.float64) * 2, 6, axis=1)
        return predict

    got = {r.id: r.scores for r in models.score_table(df, make, ["x"], batch_size=64, input_shapes=[[8]]).collect()}
    assert got[7] == [14.0] * 6 and len(got) == 300


def test_model_jobs_smoke(spark):
    rows = [(f"1_{i % 7:04d}_A_{i}", 1, i % 7, ("good " if i % 2 else "bad ") * (1 + i % 3), [i % 2 * 2, 0, 1, 0, 0, i % 4 // 3])
            for i in range(80)]
    df = spark.createDataFrame(rows, "id string, jb_id int, cc_id int, text string, labels array<int>")
    d = splits.split_random(df, 0.25, 1)
    train, dev = d.where("not is_dev"), d.where("is_dev")
    m = models.train_regressor(train, num_features=256, max_iter=3)
    p = m.predict(dev, lo=0.0, hi=3.0).collect()
    assert len(p) == dev.count() and all(len(r.scores) == 6 and 0 <= min(r.scores) for r in p)
    c = models.train_classifier(train, num_features=256, max_iter=3).predict(dev).collect()
    assert all(0.0 <= s <= 1.0 for r in c for s in r.scores)
    ens = models.cv_ensemble(train, dev, k=2, num_features=256, max_iter=2).collect()
    assert len(ens) == dev.count() and all(r.n_files == 2 for r in ens)


def test_drop_sentinel_keeps_null_labels(spark):
    from cuecards.operators import labelops

    d = spark.createDataFrame([("a", "x", "99"), ("b", "y", None), ("c", "z", "0")], "id string, content string, emotions string")
    assert sorted(r.id for r in labelops.drop_sentinel(d).collect()) == ["b", "c"]


def test_template_rejects_a_repeated_prediction(spark):
    import pytest

    from cuecards.sources import template

    t = spark.createDataFrame([(1,), (2,)], "id int")
    p = spark.createDataFrame([(1, [0.0]), (1, [1.0])], "id int, scores array<double>")
    with pytest.raises(Exception, match="repeated prediction for id 1"):
        template.fill_template(t, p).collect()
    assert template.template_report(t, p).first().duplicated == 1


def test_cv_ensemble_keeps_24_outputs(spark):
    from cuecards.operators import models

    rows = [(f"i{i}", 1, i % 2, "ab cd"[: 1 + i % 5], [i % 2] * 24) for i in range(24)]
    d = spark.createDataFrame(rows, "id string, jb_id int, cc_id int, text string, labels array<int>")
    out = models.cv_ensemble(d, d.limit(3), k=2, n=24, num_features=64, max_iter=2)
    assert [len(r.scores) for r in out.collect()] == [24] * 3
