"""Mixing sources to target weights by pivotal dependent rounding.

Targets: sources in code point order (null last) get the given weights in turn
and share the total of all sizes; a target stops at ``max_copies`` times its
source's size and the excess goes to the others by weight.  All documents of a
source want the same number of copies, target / source size; the whole part is
taken, the fraction is rounded.

Rounding: fractions are paired, and words move from one document of the pair to
the other, in a random direction that keeps both expectations, until one
fraction is 0 or 1.  So the words taken stay the same at every step.  Each
bucket of at most about ``bucket`` documents leaves one fractional document;
those meet in the next level of a reduction tree (``fan_in`` to one), up to one
per source, which is rounded to the nearer side.  Random choices are hashes of
the pair and the seed, so reruns agree.  Larger documents are paired first, so
the documents left over tend to be small.

Defined results: null or empty texts have size 0 and are taken 0 words; rows
equal in id, source and text are decided together and get the same number of
copies; a null source is a source; nothing but empty texts gives targets of 0;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import per_segment, stage

U = np.uint64


def _counter(raw, off, carry):
    _, _, first = tv.word_bounds(raw, off, tv.NON_SPACE)
    return pa.RecordBatch.from_arrays([*(carry[c] for c in ("doc", "source", "text_key")), pa.array(np.diff(first))],
                                      ["doc", "source", "text_key", "size"])


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``doc, source, text_key, size`` (words) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("source"),
                      F.col(text_col).cast("string").alias("text"),
                      F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    return src.mapInArrow(per_segment(_counter, "text", "doc", "source", "text_key"),
                          "doc long, source string, text_key long, size long")


def targets(sources: DataFrame, weights: list[float], max_copies: int) -> DataFrame:
    """``sources (source, source_size, ...)`` with ``target``.  The windows run
    over one row per source.

    With the sources in order of cap / weight, the capped ones are a leading
    run: the level is that of the first source whose own ratio reaches it."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", (max_copies * F.col("source_size")).cast("double"))
    s = s.withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(up), F.lit(0.0))
    s = s.withColumn("level", left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(up), F.lit(0.0))))
    s = s.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level")))
                     .over(everything)["level"])
    return s.withColumn("target", F.least(F.col("w") * F.coalesce("level", F.lit(0.0)), "cap")).drop(
        "w", "cap", "ratio", "level")


def pivot(key: np.ndarray, mass: np.ndarray, p: np.ndarray, seed: int) -> np.ndarray:
    """Round the fractions ``p`` of units of ``mass`` in the given order; at
    most one stays fractional.  The sum of mass times fraction does not change."""
    p = p.copy()
    free = np.flatnonzero((p > 0) & (p < 1))
    if len(free) < 2:
        return p
    draws = tv.mix(key ^ tv.constants(1, seed)[0])
    i = int(free[0])
    for j in free[1:]:
        j = int(j)
        a, b = mass[i], mass[j]
        up = min(a * (1 - p[i]), b * p[j])  # words that can move from j to i
        down = min(a * p[i], b * (1 - p[j]))  # words that can move from i to j
        u = float(tv.mix((draws[i: i + 1] + draws[j: j + 1] * U(3)))[0] >> U(11)) / (1 << 53)
        if u * (up + down) < down:
            full_i, full_j = a * (1 - p[i]) <= b * p[j], b * p[j] <= a * (1 - p[i])
            p[i], p[j] = p[i] + up / a, p[j] - up / b
            end_i, end_j = 1.0, 0.0
        else:
            full_i, full_j = a * p[i] <= b * (1 - p[j]), b * (1 - p[j]) <= a * p[i]
            p[i], p[j] = p[i] - down / a, p[j] + down / b
            end_i, end_j = 0.0, 1.0
        if full_i:
            p[i] = end_i
        if full_j:
            p[j] = end_j
        if 0 < p[j] < 1 and not 0 < p[i] < 1:
            i = j
    return p


def _rounder(seed: int):
    """``mapInArrow`` over rows sorted by (source, bucket): each group is
    rounded on its own; groups are bounded by the bucket size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
            mark = t.column("group").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(mark[1:] != mark[:-1]) + 1, [len(mark)]])
            key = t.column("key").to_numpy().view(U)
            mass, p = t.column("mass").to_numpy().astype(np.float64), t.column("p").to_numpy().copy()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                p[lo:hi] = pivot(key[lo:hi], mass[lo:hi], p[lo:hi], seed)
            yield from t.set_column(t.schema.get_field_index("p"), "p", pa.array(p)).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None \
                else pa.Table.from_batches([batch])
            mark = held.column("group").to_numpy()
            change = np.flatnonzero(mark[1:] != mark[:-1])
            last = int(change[-1]) + 1 if len(change) else 0
            if last:  # all groups but the last are complete
                yield from done(held.slice(0, last).combine_chunks())
                held = held.slice(last)
        if held is not None:
            yield from done(held.combine_chunks())
    return run


def _round_level(rows: DataFrame, seed: int) -> DataFrame:
    cols = "doc, source, text_key, size, copies, source_size, target, bucket, group, key, mass, p"
    types = ("doc long, source string, text_key long, size long, copies long, source_size long, target double, "
             "bucket long, group long, key long, mass long, p double")
    rows = rows.withColumn("group", F.xxhash64("source", F.col("source").isNull(), "bucket"))
    return (rows.select(*cols.split(", ")).repartition("group")
            .sortWithinPartitions("group", F.desc("mass"), "key").mapInArrow(_rounder(seed), types))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = (5, 2, 1), max_copies: int = 3, bucket: int = 4096, fan_in: int = 64,
        seed: int = 1) -> DataFrame:
    """Per row of ``docs``: ``doc, source, text_key, size, source_size, target,
    copies`` (how often the mix takes the document)."""
    rows = stage(sized(docs, id_col, source_col, text_col), "mix-sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                 F.count(F.lit(1)).alias("n_rows")), list(weights), max_copies)
    sources = stage(sources, "mix-targets")
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (rows.groupBy("doc", "source", "text_key", "size").agg(F.count(F.lit(1)).alias("same"))
             .join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("want", want)
             .withColumn("copies", F.least(F.floor("want"), F.lit(max_copies)).cast("long"))
             .withColumn("mass", F.col("size") * F.col("same"))
             .withColumn("p", F.when((F.col("mass") > 0) & (F.col("copies") < max_copies),
                                     F.col("want") - F.col("copies")).otherwise(0.0))
             .withColumn("key", F.xxhash64("doc", "text_key", "source"))
             .withColumn("bucket", F.pmod(F.col("key"), F.ceil(F.col("n_rows") / bucket))))
    width = sources.agg(F.max(F.ceil(F.col("n_rows") / bucket))).first()[0] or 1
    decided, level, open_ = None, 0, units
    while True:
        level_rows = stage(_round_level(open_, seed + level), "mix-level")
        settled = level_rows.where("p <= 0 or p >= 1")
        open_ = level_rows.where("p > 0 and p < 1")
        decided = settled if decided is None else decided.unionAll(settled)
        if width <= 1:
            break
        width, level = -(-width // fan_in), level + 1
        open_ = open_.withColumn("bucket", F.floor(F.col("bucket") / fan_in))
    decided = decided.unionAll(open_.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)))
    final = decided.select(F.col("doc").alias("d"), F.col("source").alias("s"), F.col("text_key").alias("t"),
                           "source_size", "target", (F.col("copies") + F.col("p").cast("long")).alias("copies"))
    return (rows.join(final, F.col("doc").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s"))
                      & (F.col("text_key") == F.col("t")))
            .select("doc", "source", "text_key", "size", "source_size", "target", "copies"))
