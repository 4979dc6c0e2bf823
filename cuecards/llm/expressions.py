"""Column expressions that Spark has no function for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(xs: Column, scan: Callable[[Column], Column]) -> Column:
    """``scan`` of each block of about sqrt(n) elements."""
    step = F.ceil(F.sqrt(F.size(xs))).cast("int")
    return let(step, lambda s: F.transform(F.sequence(F.lit(1), F.size(xs), s), lambda at: scan(F.slice(xs, at, s))))


def prefix_sums(lengths: Column) -> Column:
    """``[0, x1, x1 + x2, ...]``: blocks of about sqrt(n) first, then their
    totals, so that n elements cost about n ** 1.5 steps."""
    def scan(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def joined(parts: Column) -> Column:
        return let(scan(F.transform(parts, lambda p: F.element_at(p, -1))), lambda base: F.concat(
            F.array(F.lit(0)),
            F.flatten(F.transform(parts, lambda p, k: F.transform(F.slice(p, 2, F.size(p)), lambda x: x + F.get(base, k))))))

    return let(lengths, lambda xs: F.when(F.size(xs) == 0, F.array(F.lit(0))).otherwise(let(_blocks(xs, scan), joined)))


def running_max(xs: Column) -> Column:
    """The largest value before each element, 0 at first, in blocks as ``prefix_sums``."""
    def scan(ys: Column) -> Column:
        return F.aggregate(ys, F.array(F.lit(0)), lambda acc, y: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), y))))

    def joined(parts: Column) -> Column:
        return let(scan(F.transform(parts, lambda p: F.element_at(p, -1))), lambda base: F.flatten(F.transform(
            parts, lambda p, k: F.transform(F.slice(p, 1, F.size(p) - 1), lambda y: F.greatest(y, F.get(base, k))))))

    return F.when(F.size(xs) == 0, F.array().cast("array<int>")).otherwise(let(_blocks(xs, scan), joined))
