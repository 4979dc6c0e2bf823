"""Column expressions (P1-P19).  All JVM-side, codegen-friendly."""

from cuecards.functions.ids import parse_line_id, quarantine_ids, text_len  # noqa: F401
from cuecards.functions.labels import (  # noqa: F401
    binarize, bucketize, clamp, decode_levels, format_scores, ints_text, one_hot_levels,
    parse_labels, parse_scores, render_labels, sigmoid, smooth,
)
from cuecards.functions.text import fill_nulls, make_text, strip_punctuation  # noqa: F401
