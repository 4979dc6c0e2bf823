"""Evaluation (A4, A6-A8, M6): one global aggregate each, partial sums map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.functions.labels import binarize, clamp
from cuecards.operators.ensemble import checked

N_LABELS = 6


def pair_up(preds: DataFrame, truth: DataFrame) -> DataFrame:
    """``(id, scores)`` ⨝ ``(id, labels)`` by id -> ``(id, scores, labels)``.
    The metrics read ``n`` positions: pass the width that the arrays have."""
    return preds.select("id", "scores").join(truth.select("id", "labels"), "id", "inner")


def _sq(i: int):
    return F.pow(F.get("scores", i) - F.get("labels", i), 2)


def rmse_expr(mode: str = "flat", n: int = N_LABELS):
    """A6 aggregate: ``flat`` = one root over every cell; ``per_label`` = the
    mean of per-label roots (newer scikit-learn's multi-output default)."""
    if mode == "flat":
        return F.sqrt(sum(F.sum(_sq(i)) for i in range(n)) / (F.count(F.lit(1)) * n))
    if mode == "per_label":
        return sum(F.sqrt(F.avg(_sq(i))) for i in range(n)) / n
    raise ValueError(mode)


def rmse_score(pairs: DataFrame, mode: str = "flat", n: int = N_LABELS) -> DataFrame:
    """RMSE and the competition score ``1/(1+RMSE)``."""
    return pairs.agg(rmse_expr(mode, n).alias("rmse")).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.col("rmse")))


def exact_match_expr(truth_threshold: float = 1.0, pred_threshold: float = 0.5):
    same = binarize(F.col("labels").cast("array<double>"), truth_threshold) == binarize("scores", pred_threshold)
    return F.avg(same.cast("double"))


def exact_match(pairs: DataFrame, truth_threshold: float = 1.0, pred_threshold: float = 0.5) -> DataFrame:
    """Share of rows whose binarised prediction equals the binarised truth."""
    return pairs.agg(exact_match_expr(truth_threshold, pred_threshold).alias("exact_match"))


def mse_expr(n: int = N_LABELS):
    return sum(F.sum(_sq(i)) for i in range(n)) / (F.count(F.lit(1)) * n)


def bce_expr(target_threshold: float = 1.0, n: int = N_LABELS):
    """Mean BCE-with-logits in the stable form ``max(x,0) - x*y + log1p(exp(-|x|))``."""
    def bce(i):
        x = F.get("scores", i)
        y = (F.get("labels", i) >= target_threshold).cast("double")
        return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))

    return sum(F.sum(bce(i)) for i in range(n)) / (F.count(F.lit(1)) * n)


def losses(pairs: DataFrame, target_threshold: float = 1.0, n: int = N_LABELS) -> DataFrame:
    """Row-mean MSE of scores vs labels and BCE-with-logits of scores vs
    binarised labels (the reference averages batch means instead)."""
    return pairs.agg(mse_expr(n).alias("mse"), bce_expr(target_threshold, n).alias("bce"))


def evaluate(preds: DataFrame, truth: DataFrame, lo: float = 0.0, hi: float = 3.0, n: int = N_LABELS,
             by: list[str] | None = None) -> DataFrame:
    """M6: clamp, pair by id, then every metric in one aggregate pass (per
    ``by`` group, e.g. per model file, when given)."""
    by = list(by or [])
    clamped = preds.withColumn("scores", clamp(checked("scores", n), lo, hi))
    pairs = clamped.select(*by, "id", "scores").join(truth.select("id", "labels"), "id", "inner")
    flat = rmse_expr("flat", n)
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        flat.alias("rmse_flat"),
        rmse_expr("per_label", n).alias("rmse_per_label"),
        (F.lit(1.0) / (F.lit(1.0) + flat)).alias("score"),
        exact_match_expr().alias("exact_match"),
        mse_expr(n).alias("mse"),
    )


def length_histogram(df: DataFrame, col: str = "text", width: int = 50) -> DataFrame:
    """A4: rows per length bucket ``[b*width, (b+1)*width)``."""
    b = F.floor(F.char_length(col) / width).cast("long")
    return df.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def cut_share(df: DataFrame, col: str = "text", cuts=(100, 110, 120, 128)) -> DataFrame:
    """A4: share of rows longer than each maximum length (rows that get cut)."""
    ln = F.char_length(col)
    return df.agg(*[F.avg((ln > c).cast("double")).alias(f"cut_{c}") for c in cuts],
                  F.avg(ln.cast("double")).alias("mean_len"), F.max(ln).alias("max_len"))
