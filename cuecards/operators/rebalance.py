"""Rebalancing rare label buckets."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuecards.constants import DOUBLED_BUCKETS
from cuecards.operators.labelops import all_buckets, explode_buckets, unlabelled
from cuecards.operators.ranking import hash_order


def default_policy(spark: SparkSession, doubled=DOUBLED_BUCKETS, copies: int = 2) -> DataFrame:
    """``(bucket, copies)``: listed buckets get ``copies`` rows, the rest one."""
    rows = F.array(*[F.lit(b) for b in doubled]).cast("array<string>")  # a plan of its own, no rows of the driver
    return spark.range(1).select(F.explode(rows).alias("bucket"), F.lit(copies).alias("copies"))


def rebalance(df: DataFrame, policy: DataFrame | None = None, rewrite: Callable[[Column], Column] | None = None,
              col: str = "labels") -> DataFrame:
    """Every line once per (emotion, level) bucket it belongs to (lines
    without a label once, bucket ``none``); lines in a doubled bucket get extra
    copies (``copy_no`` 2..), whose ``content`` is passed through ``rewrite``
    (identity by default; the reference used a translation service).

    The policy counts for the 19 known buckets, the largest number of copies
    where it lists one twice: a table of at most 19 rows, broadcast.
    """
    policy = policy if policy is not None else default_policy(df.sparkSession)
    policy = (policy.join(F.broadcast(all_buckets(df.sparkSession)), "bucket", "left_semi")
              .groupBy("bucket").agg(F.max("copies").alias("copies")))
    b = explode_buckets(df, col).join(F.broadcast(policy), "bucket", "left")
    out = b.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1))))).drop("copies")
    if rewrite is not None:
        out = out.withColumn("content", F.when(F.col("copy_no") > 1, rewrite(F.col("content"))).otherwise(F.col("content")))
    return out


def rewrite_copies(rebalanced: DataFrame, fn, schema: str | None = None) -> DataFrame:
    """Rewrite copy rows with a pandas batch function (``mapInPandas``)
    and union them back with the originals.  ``fn(pdf) -> pdf`` keeps columns."""
    originals = rebalanced.where(F.col("copy_no") == 1)
    copies = rebalanced.where(F.col("copy_no") > 1)

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    rewritten = copies.mapInPandas(run, schema or copies.schema)
    return originals.unionByName(rewritten)


def sample_unlabelled(df: DataFrame, n: int, seed: int = 2021, key: str = "id", col: str = "labels") -> DataFrame:
    """At most ``n`` unlabelled lines, the ``n`` smallest hashes (the limit
    is the feature: a reproducible sample)."""
    return unlabelled(df, col).orderBy(hash_order(seed, key), F.col(key)).limit(n)
