"""Position of a row within its group, without putting a whole group in one task.

``row_number() over (partition by g order by o)`` sends every row of a group
to one task, so a group holding a third of the table becomes a third of the
job in one task.  Here the order is split by a *sub-bucket* ``s`` that is
monotone in ``o`` (a hash prefix for hash orders, ``seq div B`` for sequence
orders): rows are numbered inside ``(g, s)``, the per-``(g, s)`` counts (a
narrow, partially aggregated table) give each sub-bucket its offset, and the
offset is joined back on the same keys the window already partitioned by, so
the data side is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(seed: int | str, key: Column | str) -> Column:
    """md5 of ``seed|key``: a reproducible random order (same text in any engine)."""
    k = key if isinstance(key, Column) else F.col(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), k.cast("string")))


def rank_within(df: DataFrame, group_cols: list[str], order_cols: list[Column | str], sub: Column,
                rank: str = "_rank", total: str = "_n", base: str | None = None) -> DataFrame:
    """Add 1-based ``rank`` within ``group_cols`` by ``order_cols`` and the group size ``total``.

    ``sub`` must be non-decreasing along ``order_cols`` inside a group.  Null
    group values form groups of their own, and null sub-buckets come first:
    every key travels inside a struct, which is never null itself, so no row
    is lost by the join.  With ``base``, a column of that name holds the
    number of rows in all groups before the row's own (in group order); it is
    taken from the per-group totals, one row per group.
    """
    group = F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.struct(F.lit(0).alias("all"))
    d = df.withColumn("_key", F.struct(group.alias("g"), sub.alias("s")))
    numbered = d.withColumn("_rn_sub", F.row_number().over(Window.partitionBy("_key").orderBy(*order_cols)))
    counts = d.groupBy("_key").agg(F.count(F.lit(1)).alias("_n_sub"))
    gw = Window.partitionBy(F.col("_key.g"))
    before = gw.orderBy(F.col("_key.s")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_key",
        F.coalesce(F.sum("_n_sub").over(before), F.lit(0)).alias("_off"),
        F.sum("_n_sub").over(gw).alias(total),
    )
    if base:
        groups = counts.groupBy(F.col("_key.g").alias("_g")).agg(F.sum("_n_sub").alias("_n_g"))
        groups = groups.select("_g", F.coalesce(F.sum("_n_g").over(
            Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(base))
        offsets = offsets.join(groups, F.col("_key.g") == F.col("_g")).drop("_g")
    return (
        numbered.join(offsets, "_key", "inner")
        .withColumn(rank, (F.col("_off") + F.col("_rn_sub")).cast("long"))
        .drop("_key", "_rn_sub", "_off")
    )


def hash_rank(df: DataFrame, seed: int | str, key: str = "id", group_cols: list[str] | None = None,
              prefix: int = 4, rank: str = "_rank", total: str = "_n", base: str | None = None) -> DataFrame:
    """Rank rows by ``md5(seed|key)`` within groups; ``16**prefix`` sub-buckets per group."""
    h = hash_order(seed, key)
    d = df.withColumn("_h", h)
    out = rank_within(d, list(group_cols or []), [F.col("_h"), F.col(key)], F.substring("_h", 1, prefix),
                      rank=rank, total=total, base=base)
    return out.drop("_h")
