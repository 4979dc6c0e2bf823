"""Label and score encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuecards.constants import EMOTION_NAMES, LEVEL_WORDS, NO_LABEL_TEXT, SCORE_HI, SCORE_LO


def _c(col: str | Column) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def parse_labels(col: str | Column) -> Column:
    """``"0,1,0,0,3,0"`` -> ``array<int>``; non-integers become null elements."""
    return F.transform(F.split(_c(col), ","), lambda x: F.trim(x).try_cast("int"))


def parse_scores(col: str | Column) -> Column:
    """``"0.1,2.5,..."`` -> ``array<double>``."""
    return F.transform(F.split(_c(col), ","), lambda x: F.trim(x).try_cast("double"))


def render_labels(col: str | Column, names=None, levels=None, empty: str = NO_LABEL_TEXT) -> Column:
    """Level word + emotion name for every non-zero label, in position order.

    A vector without any level 1..3 renders as ``empty``.
    """
    names = names or EMOTION_NAMES
    levels = levels or LEVEL_WORDS
    name_arr = F.array(*[F.lit(n) for n in names])

    def piece(level, name):
        out = F.lit("")
        for i in range(len(levels) - 1, -1, -1):
            out = F.when(level == i + 1, F.concat(F.lit(levels[i]), name)).otherwise(out)
        return out

    joined = F.array_join(F.zip_with(_c(col), name_arr, piece), "")
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def one_hot_levels(col: str | Column, levels: int = 4) -> Column:
    """6 ordinal labels -> 6 blocks of ``levels`` slots, slot = level; 0 is all zeros.

    A vector holding a level outside ``0..levels-1`` is rejected (null).
    """
    arr = _c(col)
    blocks = F.flatten(
        F.transform(
            arr,
            lambda lv: F.transform(
                F.sequence(F.lit(0), F.lit(levels - 1)),
                lambda k: ((lv > 0) & (k == lv)).cast("int"),
            ),
        )
    )
    bad = F.exists(arr, lambda lv: lv.isNull() | (lv < 0) | (lv >= levels))
    return F.when(~bad, blocks)


def decode_levels(col: str | Column, n: int = 6, levels: int = 4) -> Column:
    """Inverse of ``one_hot_levels``: per block the last set slot wins, 0 if none."""
    arr = _c(col)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda j: F.coalesce(
            F.array_max(
                F.filter(F.sequence(F.lit(0), F.lit(levels - 1)),
                         lambda k: F.get(arr, j * levels + k) == 1)
            ),
            F.lit(0),
        ),
    )


def binarize(col: str | Column, threshold: float = 0.5) -> Column:
    """1 where ``x >= threshold``."""
    return F.transform(_c(col), lambda x: (x >= F.lit(threshold)).cast("int"))


def clamp(col: str | Column, lo: float = SCORE_LO, hi: float = SCORE_HI) -> Column:
    """Clip every score to ``[lo, hi]``.

    Spark orders NaN above every number, so a NaN score becomes ``hi``
    (Python's comparison chain would leave it NaN).
    """
    return F.transform(_c(col), lambda x: F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def bucketize(col: str | Column, cuts=(0.5, 1.5, 2.5)) -> Column:
    """Left-closed buckets: ``< 0.5`` -> 0, ``< 1.5`` -> 1, ``< 2.5`` -> 2, else 3."""

    def one(x):
        out = F.lit(len(cuts))
        for i in range(len(cuts) - 1, -1, -1):
            out = F.when(x < F.lit(cuts[i]), F.lit(i)).otherwise(out)
        return out

    return F.transform(_c(col), one)


def smooth(col: str | Column, eps: float = 0.1, k: int = 2) -> Column:
    """Label smoothing ``(1 - eps) * y + eps / k``."""
    return F.transform(_c(col), lambda y: y * F.lit(1.0 - eps) + F.lit(eps / k))


def sigmoid(col: str | Column) -> Column:
    return F.transform(_c(col), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def format_scores(col: str | Column, digits: int = 6) -> Column:
    """Comma-joined fixed-decimal text, so every engine prints the same digits."""
    # "+ 0.0" turns a negative zero into zero, which every engine prints alike.
    return F.array_join(F.transform(_c(col), lambda x: F.format_string(f"%.{digits}f", x + F.lit(0.0))), ",")


def ints_text(col: str | Column) -> Column:
    """Comma-joined ints (for sinks and order-insensitive comparisons)."""
    # one array cast (compiled), not a per-element lambda
    return F.array_join(_c(col).cast("array<string>"), ",")
