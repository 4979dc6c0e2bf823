"""The order of rows in split files (S7), and records that span lines.

Spark reads a large text file in blocks, one task or more for each.  A row's
place is its block's place plus its number inside the block: the scan counts the
rows of a task as it reads them, the first count of a block is subtracted, and
the blocks' row numbers are summed up in file order.  The only step of a single
task is that sum, over one narrow row per block.

Quoted fields may hold line breaks.  Whether a line starts inside quotes depends
on the parity of the quotes before it, which is again a sum inside its block plus
a sum over the blocks before it in its file; a record starts at every line that
does not.  Files are therefore read by many tasks and give the records that
reading each file from its start would give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["_file", "_block"]


def _tagged(df: DataFrame) -> DataFrame:
    """The file, the block and a count that grows with every row a task reads."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_seen"))


def number_rows(df: DataFrame, out: str = "ordinal") -> DataFrame:
    """``df``, as read from files, with ``out``: the 0-based place of each row,
    files by path and rows as they stand in them.  The same for any split size."""
    rows = _tagged(df)
    blocks = rows.groupBy(*_BLOCK).agg(F.min("_seen").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(*_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*_BLOCK, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = (F.col("_start") + F.col("_seen") - F.col("_first")).alias(out)
    return rows.join(starts, _BLOCK).select(*[F.col(f"`{c}`") for c in df.columns], place)


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(ordinal, first, record)``: the records of text files whose quoted
    fields may hold line breaks, with the place of their first line (0-based,
    over all files by path) and whether the record is its file's first.  Quotes
    pair up as they stand in the file; a last one without a partner takes the
    rest of its file."""
    lines = _tagged(spark.read.option("lineSep", "\n").text(path))
    lines = lines.withColumn("_quotes", F.char_length("value") - F.char_length(F.replace("value", F.lit(quote), F.lit(""))))
    inside = Window.partitionBy(*_BLOCK).orderBy("_seen")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.select("value", *_BLOCK, "_quotes", F.row_number().over(inside).alias("_n"), F.sum("_quotes").over(upto).alias("_sum"))

    # one row per block: lines and quotes before it, and the last line of earlier blocks that starts a record
    def parity(before):
        return (F.coalesce(before, F.lit(0)) + F.col("_sum") - F.col("_quotes")) % 2

    blocks = lines.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_quotes").alias("_q"),
        F.max(F.when(parity(F.lit(0)) == 0, F.col("_n"))).alias("_even"), F.max(F.when(parity(F.lit(0)) == 1, F.col("_n"))).alias("_odd"))
    earlier = Window.orderBy(*_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*_BLOCK, "_even", "_odd", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
                           F.coalesce(F.sum("_q").over(in_file), F.lit(0)).alias("_before"))
    last = F.when(F.col("_before") % 2 == 0, F.col("_even")).otherwise(F.col("_odd"))
    blocks = blocks.select(*_BLOCK, "_start", "_before", F.last(F.col("_start") + last - 1, True).over(in_file).alias("_open"))

    placed = lines.join(blocks, _BLOCK).withColumn("ordinal", F.col("_start") + F.col("_n") - 1)
    starts = F.when(parity(F.col("_before")) == 0, F.col("ordinal"))
    own = Window.partitionBy(*_BLOCK).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_record", F.coalesce(F.max(starts).over(own), F.col("_open")))
    first = (F.col("_block") == 0) & (F.col("_n") == 1)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "value"))), lambda x: x["value"])
    return placed.groupBy(F.col("_record").alias("ordinal")).agg(F.max(first).alias("first"), F.array_join(parts, "\n").alias("record"))
