"""Reproducible splits and folds.

Random choices are hash orders ``md5(seed|id)``: identical on any cluster
layout, after any task retry, and in any SQL engine.  Sizes follow the
reference exactly (row membership cannot, its generators are process-local).
Every per-group position comes from ``rank_within``, which spreads one huge
scene or class over ``16**prefix`` tasks (default 65 536: a scene holding a
third of 100 TB becomes pieces of about 0.5 GB); the per-sub-bucket count
table it needs is never larger than the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuecards.operators.ranking import hash_order, hash_rank


def shuffle_rows(df: DataFrame, seed: int = 2021, key: str = "id") -> DataFrame:
    """Seeded full shuffle (a total order by hash, ties by key)."""
    return df.orderBy(hash_order(seed, key), F.col(key))


def split_random(df: DataFrame, frac: float = 0.2, seed: int = 2021, key: str = "id",
                 prefix: int = 4) -> DataFrame:
    """Adds ``is_dev``; exactly ``ceil(frac * n)`` rows, the smallest hashes
    (rows that share the id at the cut stay on one side).

    The rows themselves are not shuffled: ``16**prefix`` hash-prefix buckets
    are counted, the bucket that the cut falls into is searched for the last
    (hash, id) on the dev side, and every row is compared with that one value,
    a scalar subquery.  A null id hashes like the empty text.
    """
    ids = df.select(hash_order(seed, key).alias("_h"), F.col(key).alias("_k"))
    counts = ids.groupBy(F.substring("_h", 1, prefix).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = (counts.withColumn("_end", upto).withColumn("_take", F.ceil(F.sum("_c").over(everything) * F.lit(frac)))
           .where((F.col("_end") >= F.col("_take")) & (F.col("_end") - F.col("_c") < F.col("_take")))
           .select("_p", (F.col("_take") - F.col("_end") + F.col("_c")).alias("_nth")))  # one row at most
    inside = ids.join(F.broadcast(cut), F.substring("_h", 1, prefix) == F.col("_p"))
    last = (inside.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy("_h", "_k")))
            .where(F.col("_rn") == F.col("_nth")).select(F.struct("_h", "_k").alias("last")))
    mine = F.struct(hash_order(seed, key).alias("_h"), F.col(key).alias("_k"))
    return df.withColumn("is_dev", F.coalesce(mine <= last.scalar(), F.lit(False)))


def split_scene(df: DataFrame, frac: float = 0.2, seed: int = 2021, key: str = "id",
                prefix: int = 4) -> DataFrame:
    """``int(frac * n)`` dev rows in every scene (scenes under 5 rows give none)."""
    r = hash_rank(df, seed, key, ["jb_id", "cc_id"], prefix=prefix)
    return r.withColumn("is_dev", F.col("_rank") <= F.floor(F.col("_n") * F.lit(frac))).drop("_rank", "_n")


def fold_scene(df: DataFrame, k: int = 5, seed: int = 2021, key: str = "id", prefix: int = 4) -> DataFrame:
    """D3: per-scene k-fold.  Scenes of at least ``k`` rows: fold sizes differ by
    at most one, the first ``n mod k`` folds larger.  Smaller scenes: ``fold``
    is null - the rows are training rows in every fold, dev in none."""
    r = hash_rank(df, seed, key, ["jb_id", "cc_id"], prefix=prefix)
    fold = F.when(F.col("_n") >= k, ((F.col("_rank") - 1) % k).cast("int"))
    return r.withColumn("fold", fold).drop("_rank", "_n")


def fold_stratified(df: DataFrame, cls: str, k: int = 5, seed: int = 2021, key: str = "id",
                    prefix: int = 4) -> DataFrame:
    """Stratified k-fold: fold = (class offset + position in class - 1) mod k,
    which balances both every class and the fold totals.  A class holding most
    rows is still numbered in ``16**prefix`` pieces; the class offset comes with
    the pieces' offsets, so the rows are never joined on the class alone.  A
    null class is a class."""
    r = hash_rank(df, seed, key, [cls], prefix=prefix, base="_base")
    return (r.withColumn("fold", ((F.col("_base") + F.col("_rank") - 1) % k).cast("int"))
            .drop("_rank", "_n", "_base"))


def fold_plain(df: DataFrame, k: int = 5, seed: int = 42, key: str = "id", prefix: int = 4) -> DataFrame:
    """Shuffled k-fold without classes (global hash position mod k)."""
    r = hash_rank(df, seed, key, [], prefix=prefix)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def fold_view(df: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """(train, dev) of fold ``i``; rows with a null fold are always train."""
    dev = F.col("fold") == i
    return df.where(F.col("fold").isNull() | ~dev), df.where(dev)
