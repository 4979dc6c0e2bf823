"""Line ids: ``<script>_<scene>_<tag>_<seq>`` (P1) and text length (P5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_line_id(df: DataFrame, col: str = "id") -> DataFrame:
    """Add ``jb_id`` (script), ``cc_id`` (scene), ``ids`` (sequence) and ``id_t``.

    ``id_t`` is every part but the last, re-joined with ``_``.  Parts that are
    not integers give nulls (ANSI-safe ``try_cast``); ``quarantine_ids``
    separates such rows instead of failing the job.
    """
    parts = F.split(F.col(col), "_")
    return (
        df.withColumn("jb_id", F.get(parts, 0).try_cast("int"))
        .withColumn("cc_id", F.get(parts, 1).try_cast("int"))
        .withColumn("ids", F.get(parts, 3).try_cast("int"))
        .withColumn(
            "id_t",
            F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "_")),
        )
    )


def quarantine_ids(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a parsed table into (good, bad) rows by whether the id parsed."""
    ok = F.col("jb_id").isNotNull() & F.col("cc_id").isNotNull() & F.col("ids").isNotNull()
    return df.where(ok), df.where(~ok)


def text_len(col: str | Column) -> Column:
    """Code-point length, like Python's ``len`` on a str."""
    return F.char_length(col if isinstance(col, Column) else F.col(col))
