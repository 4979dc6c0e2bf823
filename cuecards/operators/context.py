"""Context for short lines (W1, W2), positions (W4), combination codes (W5), order (O1).

The reference walks the whole table in (script, scene, sequence) order and
appends the three preceding lines to every short line - across scene and
script boundaries.  A window ordered without ``partitionBy`` would put the
whole table in one task, and a per-script window would put a huge script in
one task.  Instead the table is cut into ranges of the sort key at fixed bounds
(keys of a sample, computed once, so even one giant script spreads over many
ranges); each range computes its own lags, and the first ``k`` rows of a range
take the missing neighbours from a carry-in built from the last ``k`` rows of
the preceding ranges (``n_ranges * k`` rows: a proven size bound).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuecards.constants import CONTEXT_LINES, CONTEXT_THRESHOLD, NO_LABEL_TEXT, SENTINEL
from cuecards.operators.ranking import rank_within
from cuecards.sources.stages import input_bytes

N_LABELS = 6
ORDER = ["jb_id", "cc_id", "ids", "id"]

RANGE_BYTES = 128 << 20
#: Keys looked at for each bound, and for all bounds at most.
KEYS_PER_RANGE, MAX_KEYS = 40, 1_000_000


def _n_ranges(df: DataFrame, n_ranges: int | None) -> int:
    """The caller's number of ranges, or one for every ``RANGE_BYTES`` of the
    files that ``df`` reads (compressed bytes, so a range's rows are a few times
    that in memory), and the session's shuffle partitions at least."""
    if n_ranges:
        return int(n_ranges)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(df) // RANGE_BYTES))


def range_bounds(df: DataFrame, n: int, order: list[str] = ORDER) -> list[tuple]:
    """At most ``n - 1`` keys, ascending, that cut ``df`` into ranges of similar size.

    The keys come from a sample by hash, the same on every run; it holds about
    ``KEYS_PER_RANGE`` different keys a range and ``MAX_KEYS`` in all, whatever
    the size of ``df``.  The sample steers sizes only, no row is left out.
    """
    rows = df.count() if n > 1 else 0
    if not rows:
        return []
    share = min(1.0, min(KEYS_PER_RANGE * n, MAX_KEYS) / rows)
    picked = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
    keys = [tuple(r) for r in df.select(*order).where(picked).distinct().orderBy(*order).collect()]
    return [keys[i] for i in sorted({i * len(keys) // n for i in range(1, n)}) if i > 0]


def range_of(bounds: list[tuple], key: Column, schema: T.StructType) -> Column:
    """The number of ``bounds`` at or before ``key`` (a struct of ``schema``), by
    binary search in one constant array that travels with the plan."""
    if not bounds:
        return F.lit(0)
    names = schema.fieldNames()
    array = F.from_json(F.lit(json.dumps([dict(zip(names, b, strict=True)) for b in bounds])), T.ArrayType(schema))

    def halve(acc, _step):
        middle = F.shiftright(acc["lo"] + acc["hi"], 1)
        still, after = acc["lo"] < acc["hi"], F.get(array, middle) <= key
        return F.struct(F.when(still & after, middle + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(still & ~after, middle).otherwise(acc["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve)["lo"]


def preceding_rows(df: DataFrame, values: list[str], k: int = CONTEXT_LINES, scope: str = "global",
                   n_ranges: int | None = None, out: str = "_prev") -> DataFrame:
    """Add ``out``: up to ``k`` preceding rows (structs of ``values``), most recent first.

    ``scope='global'`` follows the reference (order over the whole table);
    ``'script'`` / ``'scene'`` restart at every script / scene.  Null keys sort
    first; rows with one key follow a hash of ``values``.
    """
    scopes = {"global": [], "script": ["jb_id"], "scene": ["jb_id", "cc_id"]}
    if scope not in scopes:
        raise ValueError(f"unknown scope {scope!r}")
    # 'script' / 'scene' restart per group: in the global order a row's
    # same-group neighbours are a leading run of its global neighbours, so
    # the global job is reused and the others are filtered out (no per-group
    # window, so a huge script is not one task).
    part = scopes[scope]

    n = _n_ranges(df, n_ranges)
    # The bounds are constants of the plan, so both branches below (the lagged
    # rows and the range tails) cut the table alike whatever the planner does, and
    # a task that runs again after a lost executor cuts it the same way.  Several
    # ranges share a task: sizes even out.
    keys = df.select(*ORDER)
    bounds = range_bounds(keys, 4 * n if n_ranges is None else n)
    packed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    key = F.struct(*[F.col(f"_row.{c}").alias(c) for c in ORDER])
    ranged = packed.withColumn("_part", range_of(bounds, key, keys.schema))
    tie = F.xxhash64(*[F.col(f"_row.{v}") for v in values])
    order = [*[F.col(f"_row.{c}") for c in ORDER], tie]
    w = Window.partitionBy("_part").orderBy(*order)
    lagged = ranged.repartition(n, "_part").select(
        "_part", "_row",
        *[F.lag("_row", j).over(w).alias(f"_lag{j}") for j in range(1, k + 1)],
        F.row_number().over(w).alias("_rn"),
    )
    # Last k rows of every range, oldest first: a descending row_number
    # filter, which Spark runs as a per-task top-k (WindowGroupLimit) before a
    # shuffle of at most k rows per range and task, keys and values only.  Then for every range the last k
    # rows before it (ranges can hold fewer than k rows, so look k back).
    last = Window.partitionBy("_part").orderBy(*[c.desc() for c in order])
    wanted = list(dict.fromkeys([*values, *part]))

    def narrow(row):
        return F.struct(*[row[v].alias(v) for v in wanted])

    # only the values asked for go on to the carry-in window
    tails = (
        ranged.withColumn("_rd", F.row_number().over(last)).where(F.col("_rd") <= k)
        .groupBy("_part")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct(
            (-F.col("_rd")).alias("_o"), narrow(F.col("_row")).alias("_v")))), lambda s: s["_v"]).alias("_tail"))
    )
    carry = tails.select(
        "_part",
        F.reverse(F.flatten(F.collect_list("_tail").over(Window.orderBy("_part").rowsBetween(-k, -1)))).alias("_carry"),
    )
    joined = lagged.join(carry, "_part", "left")
    # Neighbour j of the row numbered rn inside its range is lag j when j < rn,
    # otherwise carry element (j - rn + 1), counting back from the range start.
    prev = F.array_compact(F.array(*[
        F.when(F.lit(j) < F.col("_rn"), F.when(F.col(f"_lag{j}").isNotNull(), narrow(F.col(f"_lag{j}"))))
        .otherwise(F.get(F.col("_carry"), F.lit(j) - F.col("_rn")))
        for j in range(1, k + 1)
    ]))
    if part:
        def same_group(_p):
            cond = F.lit(True)
            for c in part:
                cond = cond & _p[c].eqNullSafe(F.col(f"_row.{c}"))
            return cond

        prev = F.filter(prev, same_group)
    return joined.select("_row.*", F.transform(prev, lambda _p: F.struct(*[_p[v].alias(v) for v in values])).alias(out))


def attach_context(df: DataFrame, threshold: int = CONTEXT_THRESHOLD, k: int = CONTEXT_LINES,
                   scope: str = "global", n_ranges: int | None = None) -> DataFrame:
    """A line shorter than ``threshold`` code points with ``k`` preceding lines
    becomes ``content || prev1 || ... || prevk`` (most recent first, original
    texts).  ``text_len`` is the length of the final content.
    """
    p = preceding_rows(df, ["content"], k=k, scope=scope, n_ranges=n_ranges)
    short = F.char_length("content") < threshold
    ctx = F.concat(F.col("content"), *[F.get("_prev", j)["content"] for j in range(k)])
    content = F.when(short & (F.size("_prev") == k), ctx).otherwise(F.col("content"))
    return p.withColumn("content", content).withColumn("text_len", F.char_length("content")).drop("_prev")


def attach_context_labelled(df: DataFrame, threshold: int = 50, k: int = CONTEXT_LINES,
                            scope: str = "global", n_ranges: int | None = None,
                            empty: str = NO_LABEL_TEXT) -> DataFrame:
    """Only short lines that carry a label get context; when the previous
    line carries one too, its character and label text come first:
    ``content || prev.character || prev.labels_text || prev1..prevk``.
    Needs ``labels_text`` (see ``render_labels``).
    """
    d = df.withColumn("_ch", F.coalesce(F.col("character"), F.lit(SENTINEL)))
    p = preceding_rows(d, ["content", "_ch", "labels_text"], k=k, scope=scope, n_ranges=n_ranges)
    texts = [F.get("_prev", j)["content"] for j in range(k)]
    prev1 = F.get("_prev", 0)
    with_label = F.concat(F.col("content"), prev1["_ch"], prev1["labels_text"], *texts)
    plain = F.concat(F.col("content"), *texts)
    apply = (F.char_length("content") < threshold) & (F.col("labels_text") != empty) & (F.size("_prev") == k)
    content = (F.when(apply & (prev1["labels_text"] != empty), with_label)
               .when(apply, plain).otherwise(F.col("content")))
    return p.withColumn("content", content).withColumn("text_len", F.char_length("content")).drop("_prev", "_ch")


def position_in_scene(df: DataFrame, block: int = 1024, out: str = "pos") -> DataFrame:
    """1-based position of a line in its scene, by (sequence, id).

    Sub-buckets of ``block`` sequence numbers keep a huge scene off one task.
    """
    r = rank_within(df, ["jb_id", "cc_id"], ["ids", "id"], F.floor(F.col("ids") / block),
                    rank=out, total="scene_rows")
    return r


def combo_text(col: str = "labels"):
    """``[0, 1, 0, 0, 3, 0]``: the text whose sort order defines combination codes."""
    return F.concat(F.lit("["), F.array_join(F.col(col).cast("array<string>"), ", "), F.lit("]"))


def encode_combos(df: DataFrame, col: str = "labels", out: str = "combo") -> DataFrame:
    """Dense 0-based code per distinct label combination, in text order.

    The distinct texts are numbered like any other group, in sub-buckets of
    their first 12 characters (a prefix sorts like the text).  A valid vector
    is six levels 0..3, so at most 4**6 of the codes are for valid ones: that
    part of the table is broadcast, and the lines are not shuffled by a text
    that most of them share.  Only lines with junk labels (another width or
    level) are joined by shuffle.  A null vector gets a null code and uses up
    none.
    """
    text = combo_text(col)
    junk = F.coalesce((F.size(col) != N_LABELS) | F.exists(col, lambda v: ~F.coalesce(v.between(0, 3), F.lit(False))),
                      F.lit(False)) & text.isNotNull()
    d = df.withColumn("_combo_text", text).withColumn("_junk", junk)
    found = d.select("_combo_text", "_junk").where(F.col("_combo_text").isNotNull()).distinct()
    ranked = rank_within(found, [], [F.col("_combo_text")], F.substring("_combo_text", 1, 12), rank="_r", total="_nc")
    codes = ranked.select("_combo_text", "_junk", (F.col("_r") - 1).cast("int").alias(out))
    valid = d.where(~F.col("_junk")).join(F.broadcast(codes.where(~F.col("_junk")).drop("_junk")), "_combo_text", "left")
    rest = d.where("_junk").join(codes.where("_junk").drop("_junk"), "_combo_text", "left")
    return valid.unionByName(rest).drop("_combo_text", "_junk")


def sort_lines(df: DataFrame) -> DataFrame:
    """O1: (script, scene, sequence), ties on the same three numbers by id."""
    return df.orderBy(*ORDER)
