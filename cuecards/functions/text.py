"""Text templates, null fills and punctuation removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuecards.constants import (
    DESCRIBE_CLOSE, DESCRIBE_OPEN, NO_ROLE, PUNCT_LONG, PUNCT_SHORT, ROLE_MARK, SENTINEL,
)

NULL_CHARACTER_CHOICES = (SENTINEL, NO_ROLE, "nan")


def fill_nulls(df: DataFrame, null_character: str = NO_ROLE, null_labels: str | None = None) -> DataFrame:
    """Fill a missing ``character`` (``'99'``, ``'无角色'`` or ``'nan'``) and, optionally, ``emotions``."""
    out = df.withColumn("character", F.coalesce(F.col("character"), F.lit(null_character)))
    if null_labels is not None and "emotions" in df.columns:
        out = out.withColumn("emotions", F.coalesce(F.col("emotions"), F.lit(null_labels)))
    return out


def make_text(df: DataFrame, template: str = "id_char_content", out: str = "text",
              null_character: str = "nan") -> DataFrame:
    """Model input text.

    * ``id_char_content``: ``id_t:character:content`` (best-scoring template)
    * ``content_role``:    ``content + ' 角色: ' + character``
    * ``char_content``:    ``character + content``
    * ``described``:       ``（描述角色：<character> ）<content>``

    A null character prints as ``null_character`` (the reference's ``astype(str)``
    gives ``nan``), so no template silently drops a field.
    """
    ch = F.coalesce(F.col("character"), F.lit(null_character))
    content = F.col("content")
    if template == "id_char_content":
        expr = F.concat(F.col("id_t"), F.lit(":"), ch, F.lit(":"), content)
    elif template == "content_role":
        expr = F.concat(content, F.lit(ROLE_MARK), ch)
    elif template == "char_content":
        expr = F.concat(ch, content)
    elif template == "described":
        expr = F.concat(F.lit(DESCRIBE_OPEN), ch, F.lit(DESCRIBE_CLOSE), content)
    else:
        raise ValueError(f"unknown template {template!r}")
    return df.withColumn(out, expr)


def strip_punctuation(col: str | Column, charset: str = "short") -> Column:
    """Remove every character of the chosen set (``short``, ``long`` or an explicit string)."""
    chars = {"short": PUNCT_SHORT, "long": PUNCT_LONG}.get(charset, charset)
    return F.translate(col if isinstance(col, Column) else F.col(col), chars, "")
