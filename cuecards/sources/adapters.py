"""Shape the driver's generic tables into the library's inputs.

The formulas are deterministic functions of the source rows (md5 of the line
id picks nulls and labels), so an independent SQL engine can build exactly the
same inputs.  See FIXTURES.md for the matching SQL spelling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_LABELS = 6
MODELS = ["m0", "m1", "m2"]


def _digit(h: Column, k: int) -> Column:
    """Hex character ``k`` (1-based) of an md5 text -> level 0..3."""
    ch = F.substring(h, k, 1)
    return (F.when(ch < "a", 0).when(ch < "d", 1).when(ch < "f", 2).otherwise(3)).cast("int")


def lines_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` -> labelled lines ``(id, content, character, emotions)``.

    Every 8 conversations form a script, a conversation is a scene and the turn
    is the sequence number: ``id = 3xxxx_<conv, 4 digits>_A_<turn>``.
    """
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    line_id = F.format_string("%d_%04d_A_%d", F.expr("30000 + (conv_id div 8)"), F.col("conv_id"), F.col("turn"))
    h = F.md5(F.col("id"))
    emotions = F.concat_ws(",", *[_digit(h, k).cast("string") for k in range(3, 3 + N_LABELS)])
    return (
        conv.select(line_id.alias("id"), F.col("text").alias("content"), F.col("role"))
        .select(
            "id",
            "content",
            F.when(F.substring(h, 1, 1) < "2", F.lit(None).cast("string")).otherwise(F.col("role")).alias("character"),
            F.when(F.substring(h, 2, 1) < "2", F.lit(None).cast("string")).otherwise(emotions).alias("emotions"),
        )
    )


def preds_from_embeddings(spark: SparkSession, sf_dir: str, models=MODELS) -> DataFrame:
    """``embeddings`` -> prediction files in long form ``(model, id, scores)``.

    Model ``k`` scores label ``i`` with ``embedding[6k + i] * 8 + 1`` (spreads
    scores past both ends of 0..3).  One narrow explode, no shuffle.
    """
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    per_model = [
        F.struct(
            F.lit(m).alias("model"),
            F.array(*[F.get("embedding", N_LABELS * k + i).cast("double") * 8 + 1 for i in range(N_LABELS)]).alias("scores"),
        )
        for k, m in enumerate(models)
    ]
    return (
        emb.select(F.col("vec_id").alias("id"), F.explode(F.array(*per_model)).alias("p"))
        .select("p.model", "id", "p.scores")
    )


def truth_from_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold labels for the prediction files: ``(id, labels array<int>)``."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    h = F.md5(F.col("vec_id").cast("string"))
    return emb.select(F.col("vec_id").alias("id"), F.array(*[_digit(h, k) for k in range(1, 1 + N_LABELS)]).alias("labels"))


def ranked_from_events(spark: SparkSession, sf_dir: str, top: int = 3) -> DataFrame:
    """``events`` -> three ranked-guess files ``(file, key_id, words array<string>)``.

    File ``event_id % 3``; per user the ``top`` event types by count, ties by name.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    counts = (
        ev.select((F.col("event_id") % 3).cast("int").alias("file"), F.col("user_id").alias("key_id"), "event_type")
        .groupBy("file", "key_id", "event_type").count()
    )
    order = Window.partitionBy("file", "key_id").orderBy(F.desc("count"), "event_type")
    best = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
    return best.groupBy("file", "key_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("r", "event_type"))), lambda s: s["event_type"]).alias("words"))
