"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

A byte is removed if a ``length``-byte string that covers it also starts
earlier (in a document with a smaller id, or earlier in the same one).

Suffix arrays are sparse: only suffixes at *anchors* are kept, positions whose
``k``-byte hash is the smallest of some string of ``length`` bytes around them.
Equal strings have equal anchors, so every repeated string is found from the
suffix at its anchor.  An entry is the hash of the suffix's first ``k`` bytes,
the hash of its whole context (all strings of ``length`` bytes that hold the
anchor) and its place; an array is sorted by both hashes.

The documents come in ``batches`` by id.  Each batch gets its array, and one
merge scan runs over it and the arrays of the existing levels, in hash order:

* an entry whose context stands earlier repeats all its strings: its whole
  context is marked;
* entries with equal first bytes but different contexts may share some strings:
  they are passed on as *open*;
* the first entry of each context goes to the new level.  Levels of the same
  size as what has been gathered are merged into it by the same scan, so sizes
  grow geometrically and there are logarithmically many.

Open contexts are then cut from the texts and compared string by string, within
the group of equal first bytes; a group of more than ``hot`` contexts is
compared by string hash over many tasks instead, each task settling its own
repeats first.  The scan holds two entries at
a time, whatever the size of a group.  Copies inside a task are combined before
the shuffle.  Texts travel compressed.

Defined results: null and empty texts have 0 bytes; nothing is removed from
texts shorter than ``length``; rows equal in id and text are one document and
get the same result; different texts of one id are ordered by a hash of the
text, null ids come last; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import drop_files, release, small_batches, stage, stage_path, text_buffers

U = np.uint64
_LAST = (1 << 63) - 1
_CHUNK = 1 << 20
_ENTRY = "h long, c long, doc long, tie long, pos int, right int, src int"
_MARKS = "doc long, tie long, lo int, hi int"
#: Entry sources: the new batch, or a repeat found before the shuffle; level n has 2 n, and 2 n + 1 once passed on as open.
NEW, REPEAT = 0, -1
_BYTES = tv.constants(256, 41)


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` consecutive values, by doubling."""
    span = 1
    out = x
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[:-rest], out[rest:]) if rest else out


def anchors(text: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, hashes of their first ``k`` bytes and of their contexts."""
    pos, head, context = [], [], []
    width = length - k + 1  # k-byte strings in a string of ``length``
    for a in range(0, max(0, len(text) - length + 1) and len(text), _CHUNK):
        lo = max(0, a - 2 * length)
        part = text[lo: a + _CHUNK + 2 * length]
        if len(part) < length:
            continue
        prefix = tv.prefix_hash(_BYTES[part])
        at = np.arange(len(part) - k + 1)
        h = tv.window_hash(prefix, at, at + k)
        order = (h >> U(32)).astype(np.uint32)
        low = np.zeros(len(part) - length + 1 + 2 * (width - 1), np.uint32)
        low[width - 1: len(low) - width + 1] = _slide(order, width, np.minimum)
        j = np.flatnonzero(_slide(low, width, np.maximum) == order)
        j = j[(j + lo >= a) & (j + lo < a + _CHUNK)]
        left, right = np.minimum(j, length - k), np.minimum(len(part) - j, length)
        c = tv.window_hash(prefix, j - left, j + right) + left.astype(U) * U(0xD6E8FEB86659FD93) + right.astype(U)
        pos.append(j + lo)
        head.append(h[j])
        context.append(tv.mix(c))
    if not pos:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U)
    return np.concatenate(pos), np.concatenate(head), np.concatenate(context)


def _entry_batch(h, c, doc, tie, pos, right, src) -> pa.RecordBatch:
    long = lambda x: pa.array(x.view(np.int64))
    return pa.RecordBatch.from_arrays(
        [long(h), long(c), pa.array(doc), pa.array(tie), pa.array(pos.astype(np.int32)),
         pa.array(right.astype(np.int32)), pa.array(src.astype(np.int32))],
        ["h", "c", "doc", "tie", "pos", "right", "src"])


def _suffix_array(length: int, k: int, most: int = 1 << 19):
    """``mapInArrow``: the entries of a task's documents.  Contexts that repeat
    within ``most`` entries are marked here and dealt out by place, so that a
    common passage sends one entry per task to its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def combined():
            h, c, doc, tie, pos, right = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, tie, doc, c, h))
            h, c, doc, tie, pos, right = (x[order] for x in (h, c, doc, tie, pos, right))
            again = np.zeros(len(h), bool)
            again[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
            # a repeat needs no hash any more: its own place deals it out evenly
            h = np.where(again, tv.mix(doc.view(U) + pos.astype(U) * U(3)), h)
            return _entry_batch(h, c, doc, tie, pos, right, np.where(again, REPEAT, NEW))

        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            doc, tie = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            for i in range(batch.num_rows):
                text = raw[off[i]: off[i + 1]]
                pos, h, c = anchors(text, length, k)
                if not len(pos):
                    continue
                held.append((h, c, np.full(len(pos), doc[i]), np.full(len(pos), tie[i]), pos,
                             np.minimum(len(text) - pos, length)))
                size += len(pos)
                if size >= most:
                    yield combined()
                    held, size = [], 0
        if held:
            yield combined()
    return run


_KINDS = {"mark": 0, "open": 1, "level": 2}


def _merge_scan():
    """``mapInArrow`` over entries sorted by (h, c, doc, tie, pos): marks, open
    contexts and the first entries of contexts.  Between batches it holds the
    first entry of the current group and the last context seen."""
    names = ["h", "c", "doc", "tie", "pos", "right", "src"]

    def rows(kind, cols, at, src=None) -> pa.RecordBatch:
        h, c, doc, tie, pos, right, own = (x[at] for x in cols)
        if kind == "mark":  # hashes are of no more use
            h, c = np.zeros_like(h), np.zeros_like(c)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h), _KINDS[kind], np.int32)), *(pa.array(x) for x in (h, c, doc, tie)),
             pa.array(pos.astype(np.int32)), pa.array(right.astype(np.int32)),
             pa.array((own if src is None else src).astype(np.int32))], ["kind", *names])

    def judged(cols, at, opened):
        """Entries that are the first of their context, and whether their group has others."""
        src = cols[6][at]
        yield rows("open", cols, at[opened & (src % 2 == 0)])
        yield rows("level", cols, at, src // 2 * 2 + (opened | (src % 2 == 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(n).to_numpy() for n in names]
            early = cols[6] == REPEAT
            yield rows("mark", cols, np.flatnonzero(early))
            cols = [x[~early] for x in cols]
            if not len(cols[0]):
                continue
            held = 0
            if carry is not None:
                held = len(carry[0])
                cols = [np.concatenate([a, b]) for a, b in zip(carry, cols, strict=True)]
            h, c = cols[0], cols[1]
            new_h = np.append(True, h[1:] != h[:-1])
            new_c = new_h | np.append(True, c[1:] != c[:-1])
            contexts = np.bincount(np.cumsum(new_h) - 1, weights=new_c)
            index = np.arange(len(h))
            heads = index[new_h]
            yield rows("mark", cols, index[~new_c & (index >= held)])
            later = index[new_c & ~new_h & (index >= held)]
            yield from judged(cols, later, np.ones(len(later), bool))
            yield from judged(cols, heads[:-1], contexts[:-1] > 1)
            # the last group may go on: its first entry waits
            last = np.array([heads[-1], len(h) - 1]) if contexts[-1] > 1 else heads[-1:]
            carry = [x[last] for x in cols]
        if carry is not None:
            yield from judged(carry, np.array([0]), np.array([len(carry[0]) > 1]))
    return run


class SuffixFamily:
    """Levels of sparse suffix arrays over batches of documents, added in id order."""

    def __init__(self, length: int, k: int):
        self.length, self.k = length, k
        self.levels: list[tuple[int, DataFrame, str]] = []  # batches in it, entries, folder

    def add(self, docs: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame]:
        """Scan a batch ``docs (doc, tie, text)`` against all levels: its marks,
        and the contexts that have become open.  The batch joins the family,
        unless it is the last: nothing will be compared with it."""
        spark = docs.sparkSession
        entries = docs.select("doc", "tie", "text").mapInArrow(_suffix_array(self.length, self.k), _ENTRY)
        for n, (_, level, _) in enumerate(self.levels, 1):
            entries = entries.unionByName(level.select(
                "h", "c", "doc", "tie", "pos", "right",
                (F.col("src") % 2 + 2 * n).alias("src")))
        scan = (entries.repartition("h").sortWithinPartitions("h", "c", "doc", "tie", "pos")
                .mapInArrow(_merge_scan(), "kind int, h long, c long, doc long, tie long, pos int, right int, src int"))
        # levels of the size gathered so far are written anew together with the batch
        size, merged = 1, []
        while self.levels and self.levels[-1][0] == size:
            merged.append(self.levels.pop())
            size += merged[-1][0]
        level_rows = F.col("kind") == _KINDS["level"]
        fresh = F.lit(not last) & ((F.col("src") < 2) | (F.col("src") >= 2 * (len(self.levels) + 1)))
        path = stage_path(spark, "suffix-scan")
        with small_batches(spark):
            scan.where(~level_rows | fresh).write.partitionBy("kind").option("compression", "zstd").parquet(path)
        out = spark.read.schema(scan.schema).parquet(path)
        if not last:
            folder = f"{path}/kind={_KINDS['level']}"
            self.levels.append((size, out.where(level_rows).drop("kind"), folder))
        for _, _, folder in merged:
            drop_files(spark, folder)
        release(spark)
        marks = out.where(f"kind = {_KINDS['mark']}").select(
            "doc", "tie", (F.col("pos") - F.least("pos", F.lit(self.length - self.k))).alias("lo"),
            (F.col("pos") + F.col("right")).alias("hi"))
        return marks, out.where(f"kind = {_KINDS['open']}").select("h", "doc", "tie", "pos", "right")

    def close(self, spark) -> None:
        for _, _, folder in self.levels:
            drop_files(spark, folder)
        self.levels = []


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw, off = text_buffers(batch.column("text"))
        data = raw.tobytes()
        packed = [press.compress(data[off[i]: off[i + 1]]) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("doc"), batch.column("tie"),
                                          pa.array(packed, pa.binary())], ["id", "doc", "tie", "packed"])


def _cut(length: int, k: int):
    """``mapInArrow``: the bytes of each open context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                text = unpack.decompress(row["packed"])
                out = [(x["h"], x["pos"] - min(x["pos"], length - k), min(x["pos"], length - k),
                        text[x["pos"] - min(x["pos"], length - k): x["pos"] + x["right"]], x["hot"])
                       for x in row["spots"]]
                h, lo, at, data, hot = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array([row["doc"]] * len(out), pa.int64()),
                     pa.array([row["tie"]] * len(out), pa.int64()), pa.array(lo, pa.int32()),
                     pa.array(at, pa.int32()), pa.array(data, pa.binary()), pa.array(hot, pa.bool_())],
                    ["h", "doc", "tie", "lo", "at", "data", "hot"])
    return run


def _strings(h, lo, at, data: list[bytes], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context index, start and hash of each string of ``length`` bytes whose
    smallest anchor is the context's; ``h`` is part of the hash."""
    sizes = np.array([len(x) for x in data], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"".join(data), np.uint8)
    prefix = tv.prefix_hash(_BYTES[raw])
    spots = np.arange(len(raw) - k + 1)
    order = (tv.window_hash(prefix, spots, spots + k) >> U(32)).astype(np.uint32)
    low = _slide(order, length - k + 1, np.minimum)  # by string start
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(data)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[owner]
    own = low[start] == order[begin[owner] + at[owner]]
    owner, start = owner[own], start[own]
    found = tv.window_hash(prefix, start, start + length) ^ tv.mix(h.view(U)[owner])
    return owner, start - begin[owner] + lo[owner], found


def _cover(doc, tie, start, length: int) -> pa.RecordBatch:
    """Ranges that the strings at (doc, tie, start), in that order, cover."""
    if not len(doc):
        cut = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (cut, cut)] + [pa.array(cut.astype(np.int32))] * 2,
                                          ["doc", "tie", "lo", "hi"])
    new = np.append(True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + length))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[first]), pa.array(tie[first]), pa.array(start[first].astype(np.int32)),
         pa.array((start[last] + length).astype(np.int32))], ["doc", "tie", "lo", "hi"])


def _repeats(t: pa.Table, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Document, tie, start and hash of the strings of some contexts, in place
    order, and whether each also stands earlier among them."""
    h, doc, tie = (t.column(c).to_numpy() for c in ("h", "doc", "tie"))
    lo, at = (t.column(c).to_numpy().astype(np.int64) for c in ("lo", "at"))
    owner, start, found = _strings(h, lo, at, t.column("data").to_pylist(), length, k)
    place = np.lexsort((start, tie[owner], doc[owner]))
    owner, start, found = owner[place], start[place], found[place]
    doc, tie = doc[owner], tie[owner]
    again = np.zeros(len(found), bool)
    if len(found):
        by = np.argsort(found, kind="stable")
        new = np.append(True, found[by][1:] != found[by][:-1])
        first = by[np.flatnonzero(new)][np.cumsum(new) - 1]
        again[by] = ~((doc[by] == doc[first]) & (tie[by] == tie[first]) & (start[by] == start[first]))
    return doc, tie, start, found, again


def _compare(length: int, k: int, most: int = 1 << 13):
    """``mapInArrow`` over contexts sorted by h: ranges of the strings that also
    stand earlier in their group.  Whole groups are compared, about ``most``
    contexts at a time."""
    def judged(t: pa.Table) -> pa.RecordBatch:
        doc, tie, start, _, again = _repeats(t, length, k)
        return _cover(doc[again], tie[again], start[again], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < most:
                continue
            h = held.column("h").to_numpy()
            ends = np.flatnonzero(h[1:] != h[:-1])
            if len(ends):
                yield judged(held.slice(0, int(ends[-1]) + 1))
                held = held.slice(int(ends[-1]) + 1)
        if held is not None and held.num_rows:
            yield judged(held)
    return run


def _hashed(length: int, k: int, most: int = 1 << 13):
    """``mapInArrow``: the strings of contexts, for groups compared by hash.
    What repeats among the ``most`` contexts that a task holds at a time is
    settled here and leaves as ranges (string null); only the first occurrences
    go on to be compared between tasks."""
    def settled(t: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, tie, start, found, again = _repeats(t, length, k)
        ranges = _cover(doc[again], tie[again], start[again], length)
        yield pa.RecordBatch.from_arrays([pa.nulls(ranges.num_rows, pa.int64()), *ranges.columns],
                                         ["string", "doc", "tie", "lo", "hi"])
        doc, tie, start, found = (x[~again] for x in (doc, tie, start, found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(doc), pa.array(tie), pa.array(start.astype(np.int32)),
             pa.array((start + length).astype(np.int32))], ["string", "doc", "tie", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from settled(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from settled(pa.Table.from_batches(held))
    return run


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its marked ranges."""
    unpack = zstandard.ZstdDecompressor()
    names = ["id", "doc", "tie", "n_bytes", "n_removed", "spans", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
             pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])), pa.binary()]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for row in batch.to_pylist():
            text = unpack.decompress(row["packed"])
            spans: list[list[int]] = []
            for x in sorted((x["lo"], x["hi"]) for x in row["ranges"] or ()):
                if spans and x[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], x[1])
                else:
                    spans.append(list(x))
            edges = [0, *(e for s in spans for e in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            for col, v in zip(cols, (row["id"], row["doc"], row["tie"], len(text), len(text) - len(kept),
                                     [{"lo": a, "hi": b} for a, b in spans], kept), strict=True):
                col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types, strict=True)], names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, k: int = 32,
                   batches: int = 4, hot: int = 5000) -> DataFrame:
    """Per row of ``docs``: ``id, n_bytes, n_removed, spans`` (maximal removed
    byte ranges) and ``kept`` (the remaining bytes)."""
    if not 0 < k <= length:
        raise ValueError("k must be between 1 and length")
    spark = docs.sparkSession
    ident, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    counted = docs.select(ident.alias("doc")).agg(F.count(F.lit(1)), F.countDistinct("doc")).first()
    unique = counted[0] == counted[1]
    tie = F.lit(0).cast("long") if unique else F.xxhash64(text)
    rows = docs.select(ident.alias("id"), F.coalesce(ident, F.lit(_LAST)).alias("doc"), tie.alias("tie"),
                       text.alias("text"))
    indexed = rows if unique else rows.dropDuplicates(["doc", "tie"])

    # consecutive id ranges of about equal counts; the scan itself is exact for any cut
    share = [i / batches for i in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("doc", F.lit(share).cast("array<double>"))).first()[0] if share else []
    cuts = sorted(set(cuts or []))
    family, marks, opened = SuffixFamily(length, k), None, None
    for i in range(len(cuts) + 1):
        batch = indexed
        if i:
            batch = batch.where(F.col("doc") > cuts[i - 1])
        if i < len(cuts):
            batch = batch.where(F.col("doc") <= cuts[i])
        m, o = family.add(batch, last=i == len(cuts))
        marks = m if marks is None else marks.unionByName(m)
        opened = o if opened is None else opened.unionByName(o)
    family.close(spark)

    opened = stage(opened.distinct(), "suffix-open")
    crowded = stage(opened.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select(
        "h", F.lit(True).alias("hot")), "suffix-hot")
    spots = (opened.join(crowded, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
             .groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "pos", "right", "hot")).alias("spots")))
    packed = indexed.mapInArrow(_pack, "id long, doc long, tie long, packed binary")
    contexts = stage(packed.drop("id").join(spots, ["doc", "tie"]).mapInArrow(
        _cut(length, k), "h long, doc long, tie long, lo int, at int, data binary, hot boolean"), "suffix-contexts")
    release(spark)
    cold = (contexts.where("not hot").drop("hot").repartition("h").sortWithinPartitions("h")
            .mapInArrow(_compare(length, k), _MARKS))
    strings = stage(contexts.where("hot").mapInArrow(
        _hashed(length, k), "string long, doc long, tie long, lo int, hi int"), "suffix-strings")
    firsts = strings.where("string is not null")
    first = stage(firsts.groupBy("string").agg(F.min(F.struct("doc", "tie", "lo")).alias("first"),
                                               F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "suffix-first")
    again = firsts.join(first, "string").where(F.struct("doc", "tie", "lo") != F.col("first"))
    again = strings.where("string is null").unionByName(again.drop("first")).drop("string")
    ranges = stage(marks.unionByName(cold).unionByName(again).distinct(), "suffix-ranges")
    release(spark)
    per_doc = ranges.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    packed = rows.mapInArrow(_pack, "id long, doc long, tie long, packed binary")
    return (packed.join(per_doc, ["doc", "tie"], "left").mapInArrow(
        _strip, "id long, doc long, tie long, n_bytes long, n_removed long, "
                "spans array<struct<lo: int, hi: int>>, kept binary").drop("doc", "tie"))
