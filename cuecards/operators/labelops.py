"""Label filters, bucket explode and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuecards.constants import BUCKET_LETTERS, SENTINEL

UNLABELLED = "none"


def labelled(df: DataFrame) -> DataFrame:
    """rows that carry labels."""
    return df.where(F.col("emotions").isNotNull())


def drop_sentinel(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """drop rows whose labels were filled with the sentinel and recompute
    ``text_len``.  Must run *after* context building: such rows still serve as
    neighbours.  Rows whose labels are null carry no sentinel and stay."""
    return df.where(F.coalesce(F.col("emotions") != sentinel, F.lit(True))).withColumn("text_len", F.char_length("content"))


def holdout(df: DataFrame, scripts) -> tuple[DataFrame, DataFrame]:
    """(train, dev) where dev holds the listed scripts (a short literal list)."""
    listed = F.col("jb_id").isin(list(scripts))
    return df.where(~listed), df.where(listed)


def bucket_name(pos, level):
    letters = F.array(*[F.lit(x) for x in BUCKET_LETTERS])
    return F.concat(F.get(letters, pos), level.cast("string"))


def explode_buckets(df: DataFrame, col: str = "labels", keep_unlabelled: bool = True) -> DataFrame:
    """One row per (emotion, level>0) bucket of a line, ``bucket`` like
    ``"B2"``; a line without any positive label yields one ``"none"`` row.
    One narrow explode instead of a 19-way union."""
    buckets = F.transform(
        F.filter(F.arrays_zip(F.sequence(F.lit(0), F.size(col) - 1).alias("p"), F.col(col).alias("v")),
                 lambda z: z["v"] > 0),
        lambda z: bucket_name(z["p"], z["v"]),
    )
    if keep_unlabelled:
        buckets = F.when(F.size(buckets) > 0, buckets).otherwise(F.array(F.lit(UNLABELLED)))
    return df.withColumn("bucket", F.explode(buckets))


def with_bucket(df: DataFrame, bucket: str, col: str = "labels") -> DataFrame:
    """rows in one bucket, e.g. ``"A1"`` = emotion 0 at level 1."""
    pos = BUCKET_LETTERS.index(bucket[0])
    return df.where(F.get(col, pos) == int(bucket[1:]))


def in_bucket(bucket: str, col: str = "labels") -> Column:
    """The condition of F4/F5 for a bucket named by a column: the emotion has
    the level, or, for ``"none"``, no emotion has one."""
    letters = F.array(*[F.lit(x) for x in BUCKET_LETTERS])
    pos = F.array_position(letters, F.substring(bucket, 1, 1)).cast("int")
    level = F.substring(F.col(bucket), 2, 10).try_cast("int")
    return F.when(F.col(bucket) == UNLABELLED, ~F.exists(col, lambda v: v > 0)).otherwise(F.get(col, pos - 1) == level)


def unlabelled(df: DataFrame, col: str = "labels") -> DataFrame:
    """rows whose label vector has no positive entry."""
    return df.where(~F.exists(col, lambda v: v > 0))


def all_buckets(spark: SparkSession, levels: int = 3) -> DataFrame:
    names = [f"{x}{lv}" for x in BUCKET_LETTERS for lv in range(1, levels + 1)] + [UNLABELLED]
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("bucket"))


def bucket_counts(df: DataFrame, col: str = "labels") -> DataFrame:
    """A2: rows per bucket (every bucket listed, zeros included) plus ``none``.

    Map-side partial counts; the 19-row bucket list is a fixed-size broadcast.
    """
    counts = explode_buckets(df.select(col), col).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(all_buckets(df.sparkSession)).join(counts, "bucket", "left")
            .select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def scene_counts(df: DataFrame) -> DataFrame:
    """A1: rows per (script, scene)."""
    return df.groupBy("jb_id", "cc_id").agg(F.count(F.lit(1)).alias("n"))
