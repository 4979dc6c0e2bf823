"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised to ``bits`` bits each, their cell's
place on the Hilbert curve is looked up, rows are ordered along the curve, and
the order is cut into runs of equal row counts (at most one apart).  Rows that
are alike in all dimensions thus share shards, so readers prune files by any of
the dimensions.

The global position is not a global sort: a cell's rows are split into
sub-buckets by a hash of the id, so a cell that holds a third of all rows is
numbered by many tasks; counts per cell and sub-bucket give the offsets.  The
only single-task step is a running sum over at most ``2 ** (bits * dimensions)``
cells.

Defined results: a null text has 0 bytes (size 1) and checksum 0; null metadata
is a value of its own; ties in the order are broken by id and checksum, equal
rows are interchangeable; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuecards.llm.common import stage


def hilbert_index(point: list[int], bits: int) -> int:
    """Place of an integer point on the Hilbert curve of ``len(point)``
    dimensions: the coordinates are untwisted from the top bit down (each
    level's reflection and exchange undone), then read as a Gray code."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    place = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            place = place << 1 | ((v ^ t) >> b & 1)
    return place


def curve_places(dimensions: int, bits: int) -> list[int]:
    """Curve place of every cell, by the cell's row-major number."""
    side = 1 << bits
    return [hilbert_index([cell // side ** d % side for d in range(dimensions)], bits)
            for cell in range(side ** dimensions)]


def hashed(value: Column, bits: int) -> Column:
    """A categorical dimension: a hash bucket; null has its own hash."""
    return F.pmod(F.xxhash64(value.cast("string")), F.lit(1 << bits)).cast("int")


def log_scaled(value: Column, bits: int, top: float = 24.0) -> Column:
    """A size: its binary logarithm between 0 and ``top``, in equal steps."""
    step = F.floor(F.log2(F.greatest(value, F.lit(1)).cast("double")) * ((1 << bits) / top))
    return F.least(F.coalesce(step, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def shard(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang", bits: int = 4, sub_buckets: int = 256) -> DataFrame:
    """Per row: ``doc, size, text_crc32, place`` (on the curve), ``rank`` (0-based,
    global), ``shard`` and ``slot``."""
    if n_shards < 1 or bits < 1:
        raise ValueError("n_shards and bits must be positive")
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    dims = [hashed(F.col(source_col), bits), hashed(F.col(lang_col), bits), log_scaled(size, bits)]
    cell = sum((d * (1 << (bits * i)) for i, d in enumerate(dims)), F.lit(0))
    places = F.array(*[F.lit(p) for p in curve_places(len(dims), bits)])
    doc = F.col(id_col).cast("long")
    rows = stage(docs.select(
        doc.alias("doc"), size.alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.element_at(places, (cell + 1).cast("int")).alias("place"),
        F.pmod(F.xxhash64(doc, F.octet_length(text)), F.lit(sub_buckets)).cast("int").alias("sub")), "shard-rows")

    counts = stage(rows.groupBy("place", "sub").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    zero = F.lit(0)
    cells = counts.groupBy("place").agg(F.sum("n").alias("n"))
    cells = cells.select("place", F.coalesce(F.sum("n").over(
        Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), zero).alias("cell_start"))
    within = Window.partitionBy("place").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.withColumn("sub_start", F.coalesce(F.sum("n").over(within), zero)).join(cells, "place")
                   .select("place", "sub", (F.col("cell_start") + F.col("sub_start")).alias("start")), "shard-starts")

    number = F.row_number().over(Window.partitionBy("place", "sub").orderBy("doc", "text_crc32", "size")) - 1
    ranked = (rows.withColumn("number", number).join(starts, ["place", "sub"])
              .withColumn("rank", F.col("start") + F.col("number")))
    total = rows.count()
    base, more = divmod(total, n_shards)
    longer = more * (base + 1)  # rows in the shards that hold one row more
    in_longer = F.col("rank") < longer
    shard_no = F.when(in_longer, F.floor(F.col("rank") / F.lit(base + 1))).otherwise(
        more + F.floor((F.col("rank") - longer) / max(base, 1)))
    slot = F.when(in_longer, F.pmod(F.col("rank"), F.lit(base + 1))).otherwise(
        F.pmod(F.col("rank") - longer, F.lit(max(base, 1))))
    return ranked.select("doc", "size", "text_crc32", "place", "rank", shard_no.cast("int").alias("shard"),
                         slot.cast("long").alias("slot"))
