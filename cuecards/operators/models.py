"""Model-facing jobs (M1-M5) on Arrow batches and MLlib.

The reference fine-tunes Transformers; here the user brings a model for
batched scoring (M1), and training is re-aimed at linear models over hashed
character n-grams (see ``blockfit``), all folds and labels of a job in shared
passes, so that the same fold / ensemble / stacking plumbing runs distributed.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import predict_batch_udf
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuecards.functions.labels import clamp
from cuecards.operators import blockfit
from cuecards.operators.ensemble import fold_mean
from cuecards.operators.splits import fold_plain, fold_scene, fold_view
from cuecards.session import cut_lineage

N_LABELS = 6


def score_table(df: DataFrame, make_predict_fn, input_cols: list[str], batch_size: int = 128,
                input_shapes=None, n_out: int = N_LABELS, out: str = "scores") -> DataFrame:
    """M1: batched inference; Arrow batches of ``batch_size`` rows go to the
    user's predict function (numpy in, ``(batch, n_out)`` out).  Scores stay
    on their row, so nothing is matched by position."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size,
                            input_tensor_shapes=input_shapes)
    return df.withColumn(out, udf(*input_cols))


class TextModel:
    """Hashed character n-grams and one linear model per label."""

    def __init__(self, fit: blockfit.BlockFit, text_col: str, width: int, n: int):
        self.fit, self.text_col, self.width, self.n = fit, text_col, width, n

    def predict(self, df: DataFrame, key: str = "id", lo: float | None = None, hi: float | None = None) -> DataFrame:
        rows = blockfit.hashed_ngrams(df, [key], self.text_col, self.width)
        out = blockfit.predict(rows, self.fit, key).select(key, F.get("scores", 0).alias("scores"))
        if lo is not None and hi is not None:
            out = out.withColumn("scores", clamp("scores", lo, hi))
        return out


def _table(train: DataFrame, text_col: str, label_col: str, n: int, width: int, fold: bool = False) -> DataFrame:
    y = F.transform(F.slice(label_col, 1, n), lambda v: v.cast("double"))
    cols = ["_y", "_fold"]
    d = train.withColumn("_y", y).withColumn("_fold", F.col("fold").cast("int") if fold else F.lit(None).cast("int"))
    # every pass reads it: written once to the shared checkpoint folder
    return cut_lineage(blockfit.hashed_ngrams(d, cols, text_col, width).select(
        F.col("_y").alias("y"), F.col("_fold").alias("fold"), "idx", "cnt"))


def train_regressor(train: DataFrame, text_col: str = "text", label_col: str = "labels", n: int = N_LABELS,
                    num_features: int = 1 << 14, max_iter: int = 100, reg: float = 0.01, tol: float = 1e-8) -> TextModel:
    """M2: multi-output regressor (MSE objective): ridge on standardised
    features, all labels in the same passes."""
    table = _table(train, text_col, label_col, n, num_features)
    return TextModel(blockfit.fit_ridge(table, 2 * num_features, n, 0, reg, max_iter, tol), text_col, num_features, n)


def train_classifier(train: DataFrame, text_col: str = "text", label_col: str = "labels", n: int = N_LABELS,
                     num_features: int = 1 << 14, max_iter: int = 100, reg: float = 0.01, tol: float = 1e-6) -> TextModel:
    """M3: multi-label classifier (label >= 1 is positive), one logistic model
    per label (6 labels, or the 24 slots of ``one_hot_levels``), all in the
    same passes.  ``max_iter`` bounds the passes over the data."""
    table = _table(train, text_col, label_col, n, num_features)
    table = table.withColumn("y", F.transform("y", lambda v: (v >= 1).cast("double")))
    return TextModel(blockfit.fit_logistic(table, 2 * num_features, n, 0, reg, max_iter, tol), text_col, num_features, n)


def cv_ensemble(train: DataFrame, test: DataFrame, k: int = 5, seed: int = 2021, text_col: str = "text",
                label_col: str = "labels", lo: float = 0.0, hi: float = 3.0, n: int = N_LABELS, num_features: int = 1 << 14,
                max_iter: int = 100, reg: float = 0.01, tol: float = 1e-8) -> DataFrame:
    """M4: per-scene k-fold training (D3) and a fold ensemble on ``test``:
    every fold's scores are clamped, then averaged (A15).  The k x n models are
    columns of one block: a pass over the data serves them all, each row masked
    out of its own fold's columns, and ``test`` is read once."""
    table = _table(fold_scene(train, k, seed), text_col, label_col, n, num_features, fold=True)
    fit = blockfit.fit_ridge(table, 2 * num_features, n, k, reg, max_iter, tol)
    rows = blockfit.predict(blockfit.hashed_ngrams(test, ["id"], text_col, num_features), fit, "id")
    preds = rows.select("id", F.posexplode("scores").alias("_k", "scores")).select(
        F.concat(F.lit("fold"), F.col("_k")).alias("model"), "id", "scores")
    return fold_mean(preds, lo, hi, n)


def _linear(features: list[str], intercept: float, weights) -> F.Column:
    out = F.lit(float(intercept))
    for c, w in zip(features, weights, strict=True):
        out = out + F.col(c).cast("double") * F.lit(float(w))
    return out


def _linear_level(tr: DataFrame, te: DataFrame | None, features: list[str], key: str, k: int):
    """Least squares of every fold from one pass: per-fold sufficient
    statistics, leave-one-fold-out by subtraction.  Out-of-fold predictions are
    expressions; ``te`` gets the mean of the fold models' predictions, which is
    the prediction of their mean."""
    models = blockfit.leave_one_out(tr, features, "label", "fold", k)
    oof = F.lit(None).cast("double")
    for i, (b, w) in enumerate(models):
        oof = F.when(F.col("fold") == i, _linear(features, b, w)).otherwise(oof)
    mean_b, mean_w = sum(b for b, _ in models) / k, sum(w for _, w in models) / k
    return (tr.select(key, oof.alias("lr")),
            None if te is None else te.select(key, _linear(features, mean_b, mean_w).alias("lr")))


def _forest_level(tr: DataFrame, te: DataFrame | None, key: str, k: int, seed: int, num_trees: int):
    parts_tr, parts_te = None, None
    for i in range(k):
        fit_on, held = fold_view(tr, i)
        m = RandomForestRegressor(numTrees=num_trees, seed=seed).fit(fit_on)
        a = m.transform(held).select(key, F.col("prediction").alias("rf"))
        parts_tr = a if parts_tr is None else parts_tr.unionByName(a)
        if te is not None:
            b = m.transform(te).select(key, F.col("prediction").alias("rf"))
            parts_te = b if parts_te is None else parts_te.unionByName(b)
    return parts_tr, None if te is None else parts_te.groupBy(key).agg(F.avg("rf").alias("rf"))


def _folded(train: DataFrame, features: list[str], label: str, key: str, k: int, seed: int) -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol="features")
    cols = [F.col(c).cast("double").alias(c) for c in features]
    return cut_lineage(fold_plain(va.transform(train.select(key, *cols, F.col(label).cast("double").alias("label"))), k, seed))


def out_of_fold(train: DataFrame, features: list[str], label: str = "label", key: str = "id", k: int = 5,
                seed: int = 42, num_trees: int = 20) -> DataFrame:
    """M5 level 1 alone: ``(key, lr, rf)``, each row of ``train`` predicted by
    the fold models that did not see it (D6 folds)."""
    tr = _folded(train, features, label, key, k, seed)
    return _linear_level(tr, None, features, key, k)[0].join(_forest_level(tr, None, key, k, seed, num_trees)[0], key)


def stack(train: DataFrame, test: DataFrame, features: list[str], label: str = "label", key: str = "id",
          k: int = 5, seed: int = 42, num_trees: int = 20) -> DataFrame:
    """M5: out-of-fold stacking.  Level 1: linear and random-forest regressors;
    each row of ``train`` gets the prediction of the model that did not see
    it (D6 folds), ``test`` gets the mean over fold models; level 2: a random
    forest on the two level-1 columns.  Everything is keyed by ``key``."""
    tr = _folded(train, features, label, key, k, seed)
    cols = [F.col(c).cast("double").alias(c) for c in features]
    te = cut_lineage(VectorAssembler(inputCols=features, outputCol="features").transform(test.select(key, *cols)))
    names = ["lr", "rf"]
    lr, lr_test = _linear_level(tr, te, features, key, k)
    rf, rf_test = _forest_level(tr, te, key, k, seed, num_trees)
    va2 = VectorAssembler(inputCols=names, outputCol="features")
    level2_train = va2.transform(lr.join(rf, key).join(tr.select(key, "label"), key))
    top = RandomForestRegressor(numTrees=num_trees, seed=seed).fit(level2_train)
    return top.transform(va2.transform(lr_test.join(rf_test, key))).select(key, *names, F.col("prediction"))
