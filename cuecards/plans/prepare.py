"""Entry 1 of the reference: prepare a dialogue table for labelling.

read -> parse ids -> quarantine -> fill -> labels -> context -> drop
sentinels -> model text.  One lazy plan; the only wide steps are the range
exchange + window of the context operator (see ``operators.context``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.constants import CONTEXT_THRESHOLD, SENTINEL
from cuecards.functions.ids import parse_line_id, quarantine_ids
from cuecards.functions.labels import parse_labels, render_labels
from cuecards.functions.text import fill_nulls, make_text
from cuecards.operators.context import attach_context, attach_context_labelled
from cuecards.operators.labelops import drop_sentinel


def label_columns(df: DataFrame) -> DataFrame:
    """``labels`` (array<int>) and ``labels_text`` from ``emotions``."""
    return df.withColumn("labels", parse_labels("emotions")).withColumn("labels_text", render_labels("labels"))


def prepare_lines(lines: DataFrame, threshold: int = CONTEXT_THRESHOLD, k: int = 3, scope: str = "global",
                  labelled_context: bool = False, template: str = "id_char_content",
                  n_ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(prepared, quarantined)``.

    ``quarantined`` holds rows whose id does not parse or whose content is null
    (they cannot be placed in the order or measured).  Sentinel-labelled rows
    act as context for their neighbours and are dropped afterwards.
    """
    parsed = parse_line_id(lines)
    good, bad_id = quarantine_ids(parsed)
    bad = bad_id.unionByName(good.where(F.col("content").isNull()))
    good = good.where(F.col("content").isNotNull())
    filled = label_columns(fill_nulls(good, null_character=SENTINEL, null_labels=SENTINEL))
    if labelled_context:
        ctx = attach_context_labelled(filled, threshold=threshold, k=k, scope=scope, n_ranges=n_ranges)
    else:
        ctx = attach_context(filled, threshold=threshold, k=k, scope=scope, n_ranges=n_ranges)
    kept = drop_sentinel(ctx)
    return make_text(kept, template), bad
