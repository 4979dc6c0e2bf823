"""Submission templates (S6, S7): predictions are matched by id, never by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.functions.labels import format_scores


def fill_template(template: DataFrame, preds: DataFrame, digits: int = 6,
                  out: str = "emotion") -> DataFrame:
    """Left-join the template's ids with ``(id, scores)``; ids without a
    prediction get a null ``emotion``.  The result has one row per template row:
    an id that is predicted twice is an error (see ``template_report``).  Extra template columns (such as an
    ``ordinal`` carrying the original file order) pass through, so the sink can
    restore the order with one ``orderBy``.
    """
    keep = [c for c in template.columns if c != out]
    once = preds.groupBy("id").agg(F.max("scores").alias("scores"), F.count(F.lit(1)).alias("_n"))
    scored = once.select("id", F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated prediction for id "), F.col("id").cast("string"))))
        .otherwise(format_scores("scores", digits)).alias(out))
    return template.select(*keep).join(scored, "id", "left")


def template_report(template: DataFrame, preds: DataFrame) -> DataFrame:
    """One row of counts: template rows, ids without a prediction, duplicated
    prediction ids and predictions whose id is not in the template."""
    t = template.select("id").withColumn("_t", F.lit(1))
    p = preds.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    j = t.join(p, "id", "full")
    return j.agg(
        F.sum(F.col("_t")).alias("template_rows"),
        F.sum(F.when(F.col("_t").isNotNull() & F.col("_n").isNull(), 1).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).alias("duplicated"),
        F.sum(F.when(F.col("_t").isNull(), 1).otherwise(0)).alias("extra"),
    )
