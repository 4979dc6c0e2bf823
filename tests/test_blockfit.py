import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cuecards.operators import blockfit, models, splits

W = 16


def table(spark, n=240, seed=3):
    """Random texts, two labels, folds (some rows have none)."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        text = "".join(rng.choice(list("abcdeéX \U0001F600"), rng.integers(0, 30)))
        rows.append((i, text if i % 17 else None, [float(text.count("a")) + rng.normal(), float(rng.random() < 0.3)],
                     None if i % 11 == 0 else i % 3))
    return spark.createDataFrame(rows, "id long, text string, y array<double>, fold int")


def dense(df):
    rows = sorted(blockfit.hashed_ngrams(df, ["id", "y", "fold"], "text", W).collect(), key=lambda r: r.id)
    x = np.zeros((len(rows), 2 * W))
    for i, r in enumerate(rows):
        x[i, r.idx] = r.cnt
    return x, np.array([r.y for r in rows]), np.array([-1 if r.fold is None else r.fold for r in rows])


def closed_form(x, y, reg):
    mu, var = x.mean(0), x.var(0)
    use = var > 0
    xc = (x - mu)[:, use]
    w = np.zeros((x.shape[1], y.shape[1]))
    w[use] = np.linalg.solve(xc.T @ xc / len(x) + reg * np.diag(var[use]), xc.T @ (y - y.mean(0)) / len(x))
    return w, y.mean(0) - mu @ w


def full(fit, k=0):
    w = np.zeros((fit.width, fit.n))
    cols = slice(k * fit.n, (k + 1) * fit.n)
    w[fit.active] = fit.weights[:, cols]
    return w, fit.intercept[cols]


def test_hashed_counts(spark):
    df = spark.createDataFrame([("aab",), ("",), (None,), ("é\U0001F600",)], "text string")
    got = [dict(zip(r.idx, r.cnt)) for r in blockfit.hashed_ngrams(df, [], "text", 100).collect()]

    def want(t):
        out = {}
        codes = [ord(c) for c in t or ""]
        for b in [c % 100 for c in codes] + [100 + (p * 7919 + q) % 100 for p, q in zip(codes, codes[1:])]:
            out[b] = out.get(b, 0) + 1
        return out

    assert got == [want(t) for t in ("aab", "", None, "é\U0001F600")]


def test_counting_holds_no_batch_of_single_characters(spark, monkeypatch):
    df = spark.range(1000, numPartitions=1).select("id", F.repeat(F.concat(F.lit("abcdefgh"), "id"), 400).alias("text"))
    seen = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: seen.append((self, run)))
    blockfit.hashed_ngrams(df, ["id"], "text", W)
    monkeypatch.undo()
    src, run = seen[0]
    batch = src.toArrow().combine_chunks().to_batches()
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter(batch)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 60 << 20


def test_long_texts_are_counted_piece_by_piece_alike(monkeypatch):
    texts = pa.array(["aab" * 9, None, "", "é\U0001F600" * 5, "x"])
    whole = blockfit._count(texts, 10)
    monkeypatch.setattr(blockfit, "TEXT", 4)
    for a, b in zip(whole, blockfit._count(texts, 10)):
        np.testing.assert_array_equal(a, b)
    cut = list(blockfit._cut(pa.RecordBatch.from_arrays([texts], ["t"])))
    assert [b.num_rows for b in cut] == [1, 2, 1, 1]


def test_rows_are_taken_in_small_pieces_alike(spark, monkeypatch):
    df = table(spark)
    x, y, _ = dense(df)
    rows = blockfit.hashed_ngrams(df, ["id", "y", "fold"], "text", W)
    monkeypatch.setattr(blockfit, "WORK", 50)
    parts = [r for b in rows.toArrow().to_batches() for r in blockfit._rows(b, np.arange(2 * W), 2, 3, 6)]
    assert len(parts) > 20
    v = np.random.default_rng(1).normal(size=(2 * W, 2))
    grad = np.zeros((2 * W, 2))
    for r in parts:
        r.transposed_times(r.y, grad)
    ids = [r.id for r in rows.select("id").collect()]
    np.testing.assert_allclose(np.concatenate([r.times(v) for r in parts]), x[ids] @ v)
    np.testing.assert_allclose(grad, x.T @ y)


def test_ridge_is_the_closed_form_for_every_fold(spark):
    df = table(spark).repartition(5)
    x, y, fold = dense(df)
    rows = blockfit.hashed_ngrams(df, ["id", "y", "fold"], "text", W)
    together = blockfit.fit_ridge(rows, 2 * W, 2, 3, 0.05, 200, 1e-12)
    alone = blockfit.fit_ridge(rows, 2 * W, 2, 0, 0.05, 200, 1e-12)
    np.testing.assert_allclose(full(alone)[0], closed_form(x, y, 0.05)[0], atol=1e-9)
    for k in range(3):
        w, b = closed_form(x[fold != k], y[fold != k], 0.05)
        np.testing.assert_allclose(full(together, k)[0], w, atol=1e-9)
        np.testing.assert_allclose(full(together, k)[1], b, atol=1e-9)
    # the block's column is the separate fit without that fold
    one = blockfit.fit_ridge(rows.where("fold is null or fold <> 1"), 2 * W, 2, 0, 0.05, 200, 1e-12)
    np.testing.assert_allclose(full(one)[0], full(together, 1)[0], atol=1e-9)
    # a pass serves all columns: no more passes than the slowest of the separate fits needs
    assert together.passes <= alone.passes + 5
    scores = {r.id: r.scores for r in blockfit.predict(rows.select("id", "idx", "cnt"), together, "id").collect()}
    for k in range(3):
        w, b = full(together, k)
        np.testing.assert_allclose(np.array([scores[i][k] for i in range(len(x))]), x @ w + b, atol=1e-9)


def test_sums_by_slices_and_by_the_driver_agree(spark, monkeypatch):
    rows = blockfit.hashed_ngrams(table(spark).repartition(5), ["id", "y", "fold"], "text", W)
    a = blockfit.fit_ridge(rows, 2 * W, 2, 3, 1.0, 4)
    monkeypatch.setattr(blockfit, "DIRECT", 0)
    monkeypatch.setattr(blockfit, "SLICE", 7)
    b = blockfit.fit_ridge(rows, 2 * W, 2, 3, 1.0, 4)
    np.testing.assert_allclose(a.weights, b.weights, atol=1e-12)


def test_same_minimum_as_mllib(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import LinearRegression

    df = table(spark)
    x, y, _ = dense(df)
    rows = blockfit.hashed_ngrams(df, ["id", "y"], "text", W)
    data = spark.createDataFrame([(r.tolist(), float(a), float(b)) for r, (a, b) in zip(x, y)], "x array<double>, a double, b double")
    data = data.withColumn("features", array_to_vector("x"))
    # MLlib divides by sample deviations, and by the label's: the same objective up to those factors
    n = len(x)
    reg = 0.05 * y[:, 0].std(ddof=1) * (n - 1) / n
    lin = LinearRegression(labelCol="a", regParam=reg, elasticNetParam=0.0, solver="normal", tol=1e-12).fit(data)
    fit = blockfit.fit_ridge(rows, 2 * W, 2, 0, 0.05 * (n - 1) / n * n / (n - 1), 200, 1e-12)
    np.testing.assert_allclose(full(fit)[0][:, 0], lin.coefficients.toArray(), atol=2e-3)
    log = LogisticRegression(labelCol="b", regParam=0.05, maxIter=500, tol=1e-12).fit(data)
    # labels that are not 0 or 1 have no logistic fit: keep the binary one
    rows = rows.withColumn("y", F.slice("y", 2, 1))
    fit = blockfit.fit_logistic(rows, 2 * W, 1, 0, 0.05, 150, 1e-9)
    np.testing.assert_allclose(full(fit)[0][:, 0], log.coefficients.toArray(), atol=2e-3)
    p = 1 / (1 + np.exp(-(x @ full(fit)[0] + full(fit)[1])))
    used, g = x.std(0) > 0, x.T @ (p - y[:, 1:]) / n + 0.05 * x.var(0)[:, None] * full(fit)[0]
    assert np.abs(g[used]).max() < 1e-7 and abs((p - y[:, 1:]).mean()) < 1e-8


def test_logistic_of_one_class_and_separable_labels(spark):
    df = table(spark).withColumn("y", F.array(F.lit(0.0), F.lit(1.0), F.col("text").contains("a").cast("double")))
    df = df.where("text is not null")
    fit = blockfit.fit_logistic(blockfit.hashed_ngrams(df, ["id", "y"], "text", W), 2 * W, 3, 0, 1e-2, 150, 1e-4)
    got = blockfit.predict(blockfit.hashed_ngrams(df, ["id"], "text", W), fit, "id").join(df, "id").collect()
    for r in got:
        assert r.scores[0][0] < 1e-9 and r.scores[0][1] > 1 - 1e-9
    assert np.mean([(r.scores[0][2] > 0.5) == ("a" in r.text) for r in got]) > 0.95


def test_planted_signal_is_learned(spark):
    """A label set by a character is predicted on rows the model has not seen."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        t = "".join(rng.choice(list("abcdefgh "), 12))
        rows.append((f"1_{i % 20:04d}_A_{i}", 1, i % 20, t, [min(3, t.count("a")), int("b" in t) * 3, 0, 0, 0, 0]))
    d = splits.split_random(spark.createDataFrame(rows, "id string, jb_id int, cc_id int, text string, labels array<int>"), 0.25, 1)
    train, dev = d.where("not is_dev"), d.where("is_dev")
    got = models.train_regressor(train, num_features=64, reg=1e-3).predict(dev, lo=0.0, hi=3.0).join(dev, "id").collect()
    assert all(abs(r.scores[0] - r.labels[0]) < 0.5 for r in got if r.labels[0] < 3)
    right = models.train_classifier(train, num_features=64, reg=1e-3).predict(dev).join(dev, "id").collect()
    assert np.mean([(r.scores[1] > 0.5) == (r.labels[1] > 0) for r in right]) > 0.9
    ens = models.cv_ensemble(train, dev, k=4, num_features=64, reg=1e-3).join(dev, "id").collect()
    assert all(abs(r.scores[0] - r.labels[0]) < 0.6 for r in ens if r.labels[0] < 3) and all(r.n_files == 4 for r in ens)


def test_leave_one_out_is_least_squares(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 4)) + 5
    x[:, 3] = x[:, 0] + x[:, 1]  # collinear
    y = x @ [1, 2, 3, 0] + rng.normal(size=90)
    df = spark.createDataFrame([(*map(float, r), float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))],
                               "a double, b double, c double, d double, label double, fold int").repartition(4)
    for k, (b, w) in enumerate(blockfit.leave_one_out(df, ["a", "b", "c", "d"], "label", "fold", 3)):
        keep = np.arange(90) % 3 != k
        want = np.linalg.lstsq(np.column_stack([np.ones(keep.sum()), x[keep]]), y[keep], rcond=1e-12)[0]
        np.testing.assert_allclose(x @ w + b, np.column_stack([np.ones(90), x]) @ want, atol=1e-6)


def test_empty_training_table(spark):
    df = table(spark).where("false")
    fit = blockfit.fit_ridge(blockfit.hashed_ngrams(df, ["id", "y"], "text", W), 2 * W, 2)
    got = blockfit.predict(blockfit.hashed_ngrams(table(spark), ["id"], "text", W), fit, "id").collect()
    assert len(got) == 240 and all(r.scores == [[0.0, 0.0]] for r in got)
