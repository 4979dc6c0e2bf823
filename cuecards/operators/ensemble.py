"""Combining prediction tables.

Predictions are long ``(model, id, scores array<double>)`` and are always
matched by id.  Nothing is collected per id or key: means, votes and
rankings are partial aggregates, so an id repeated in many rows is combined
map-side.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuecards.constants import RANK_WEIGHT_BASE
from cuecards.functions.labels import clamp as clamp_scores
from cuecards.session import cut_lineage

N_LABELS = 6


def _weights(spark: SparkSession, weights, key: str) -> DataFrame:
    """``{name: weight}`` (or ``[(name, weight), ...]`` in file order) -> small table
    ``(key, _w, _order)``; ``_order`` is the position in the given order."""
    items = list(weights.items()) if isinstance(weights, dict) else list(weights)
    rows = [(str(k), float(w), i) for i, (k, w) in enumerate(items)]
    return spark.createDataFrame(rows, f"{key} string, _w double, _order int")


def checked(scores, n: int):
    """The score array, or an error where it is not ``n`` wide: a wider array
    is never cut and a narrower one never padded.  A null array stays null."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return F.when(s.isNull() | (F.size(s) == n), s).otherwise(F.raise_error(F.concat(
        F.lit(f"expected {n} scores, found "), F.size(s).cast("string"))))


def align(preds: DataFrame, models: list[str], n: int = N_LABELS) -> DataFrame:
    """One row per id present in *every* listed file, one score array per
    file.  An id that a file holds twice is an error (which of its rows is meant
    is the caller's to say); ``duplicate_ids`` lists them."""
    g = preds.where(F.col("model").isin(models)).groupBy("id").agg(
        *[F.max(F.when(F.col("model") == m, checked("scores", n))).alias(m) for m in models],
        *[F.count(F.when(F.col("model") == m, 1)).alias(f"_n_{i}") for i, m in enumerate(models)],
    )
    g = g.select("id", *[
        F.when(F.col(f"_n_{i}") > 1, F.raise_error(F.concat(F.lit(f"{m}: repeated id "), F.col("id").cast("string"))))
        .otherwise(F.col(m)).alias(m) for i, m in enumerate(models)])
    return g.where(F.greatest(*[F.col(m).isNull() for m in models]) == F.lit(False))


def duplicate_ids(preds: DataFrame) -> DataFrame:
    """``(model, id, n)`` of ids that one file holds more than once."""
    return preds.groupBy("model", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def mean_ensemble(preds: DataFrame, n: int = N_LABELS) -> DataFrame:
    """A10: element-wise mean over files of ``n`` scores each; map-side partial
    sums per position.  Another width is an error."""
    return preds.withColumn("scores", checked("scores", n)).groupBy("id").agg(
        F.array(*[F.avg(F.get("scores", i)) for i in range(n)]).alias("scores"),
        F.count(F.lit(1)).alias("n_files"),
    )


def fold_mean(preds: DataFrame, lo: float = 0.0, hi: float = 3.0, n: int = N_LABELS,
              group: str = "model") -> DataFrame:
    """Clamp every fold's scores to [lo, hi] first, then average across folds."""
    return mean_ensemble(preds.withColumn("scores", clamp_scores("scores", lo, hi)).drop(group), n)


def weighted_mean(preds: DataFrame, weights, n: int = N_LABELS) -> DataFrame:
    """``sum(w * x) / sum(w)`` per id and position (the intended formula;
    the reference's loop keeps only its last file).  A null score counts neither
    in the sum nor in the weights; a position that is null in every file stays
    null."""
    w = _weights(preds.sparkSession, weights, "model")
    j = preds.withColumn("scores", checked("scores", n)).join(F.broadcast(w), "model", "inner")

    def mean(i):
        x = F.get("scores", i)
        return F.sum(F.col("_w") * x) / F.sum(F.when(x.isNotNull(), F.col("_w")))

    return j.groupBy("id").agg(F.array(*[mean(i) for i in range(n)]).alias("scores"))


def weighted_vote(preds: DataFrame, weights, label_weights=None, n: int = N_LABELS) -> DataFrame:
    """Per id and position, each file votes its value with its weight; the
    value with the largest total wins, a tie goes to the value of the earliest
    file in ``weights`` order.  Values are compared as given - bucketize
    scores first for integer votes.  Works for any value, not only one digit.

    Two partial aggregates, no per-id collection: totals per (id, position,
    value), then per id and position the minimum of ``(value is null,
    -total, first file, value)``.  An id duplicated across many rows is
    combined map-side like any other.
    """
    lw = F.array(*[F.lit(float(x)) for x in (label_weights or [1.0] * n)])
    w = _weights(preds.sparkSession, weights, "model")
    cells = (preds.join(F.broadcast(w), "model", "inner")
             .select("id", "_order", "_w", F.posexplode_outer(checked("scores", n)).alias("pos", "value")))
    totals = cells.groupBy("id", "pos", "value").agg(
        F.round(F.sum(F.col("_w") * F.get(lw, F.col("pos"))), 9).alias("_t"),
        F.min("_order").alias("_f"),
    )
    best = totals.groupBy("id").agg(*[
        F.min(F.when(F.col("pos") == p, F.struct(
            F.col("value").isNull().alias("_nul"), (-F.col("_t")).alias("_neg"), F.col("_f").alias("_first"),
            F.col("value").alias("value")))).alias(f"_p{p}")
        for p in range(n)
    ])
    return best.select("id", F.array(*[F.col(f"_p{p}.value") for p in range(n)]).alias("scores"))


def rank_vote(ranked: DataFrame, weights, top: int = 3, base: int = RANK_WEIGHT_BASE) -> DataFrame:
    """Borda-style vote over ranked-guess files ``(file, key_id, words)``.

    A word at rank r (0-based) in file f scores ``(base - r) * weight(f)``; the
    ``top`` best totals win, ties go to the word seen first in (file order,
    rank) order.  Totals are rounded to 9 places so float summation order
    cannot break ties differently on another engine.

    Totals are a partial aggregate per (key, word); the ``top`` per key come
    from a ``row_number`` filter, which Spark limits per group *before* the
    shuffle, so a key with many rows or words sends at most ``top`` rows per
    task.  Keys whose lists are all empty keep an empty result.
    """
    w = _weights(ranked.sparkSession, weights, "file")
    entries = (ranked.withColumn("file", F.col("file").cast("string")).join(F.broadcast(w), "file", "inner")
               .select("key_id", "_order", "_w", F.posexplode_outer("words").alias("r", "token")))
    totals = entries.groupBy("key_id", "token").agg(
        F.round(F.sum((F.lit(base) - F.col("r")) * F.col("_w")), 9).alias("total"),
        F.min(F.struct(F.col("_order").alias("o"), F.col("r").alias("r"))).alias("_first"),
    )
    order = Window.partitionBy("key_id").orderBy(F.col("token").isNull(), F.desc("total"), "_first", "token")
    best = totals.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= top)
    g = best.groupBy("key_id").agg(F.sort_array(F.collect_list(
        F.when(F.col("token").isNotNull(), F.struct("_rn", "token", "total")))).alias("_b"))
    return g.select(
        "key_id",
        F.array_join(F.transform("_b", lambda s: s["token"]), " ").alias("word"),
        F.transform("_b", lambda s: s["total"]).alias("totals"),
    )


def _cells(preds: DataFrame, models: list[str], n: int) -> DataFrame:
    """One vector per (id, position) that every listed file has a value for, a
    slot per file.  One shuffle by id; a repeated (file, id) is counted, not
    collected, and is an error."""
    spark = preds.sparkSession
    files = spark.createDataFrame([(m, i) for i, m in enumerate(models)], "model string, _slot int")
    listed = preds.select("model", "id", checked("scores", n).alias("_s")).join(F.broadcast(files), "model")
    one = listed.repartition("id").groupBy("id", "_slot").agg(F.max("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
    one = one.withColumn("_s", F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.get(F.array(*[F.lit(m) for m in models]), F.col("_slot")), F.lit(": repeated id "), F.col("id").cast("string"))))
        .otherwise(F.col("_s")))
    rows = one.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("_slot", "_s"))).alias("_f"))
    rows = rows.where((F.size("_f") == len(models)) & ~F.exists("_f", lambda f: f["_s"].isNull()))
    cells = rows.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_p"), "_f").select(
        F.transform("_f", lambda f: F.get(f["_s"], F.col("_p"))).alias("_v"))
    return cells.where(~F.exists("_v", lambda v: v.isNull())).select(array_to_vector("_v").alias("cell"))


def model_corr(preds: DataFrame, models: list[str], n: int = N_LABELS, digits: int = 9) -> DataFrame:
    """Pearson correlation between every pair of files over all (id, label)
    cells present in every file.

    A cell is one vector with a slot per file, and the matrix of second moments
    is one tree aggregation of vectors: the plan does not grow with the files, and
    what reaches the driver is files x files numbers.  A file whose cells are all
    equal has NaN with the others; with fewer than two cells every pair is null.
    """
    spark, models = preds.sparkSession, list(dict.fromkeys(models))
    cells = cut_lineage(_cells(preds, models, n))
    if cells.limit(2).count() < 2:
        found = [[None] * len(models) for _ in models]
    else:
        found = Correlation.corr(cells, "cell").first()[0].toArray().tolist()
    rows = [(a, b, found[i][j]) for i, a in enumerate(models) for j, b in enumerate(models)]
    return spark.createDataFrame(rows, "model_a string, model_b string, corr double").withColumn(
        "corr", F.round("corr", digits))
