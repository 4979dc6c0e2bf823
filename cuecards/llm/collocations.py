"""Phrase collocation mining by SON partitioning.

The corpus is cut into at most ``shards`` shards (whole input splits).  Every
shard is mined completely, level by level, at its proportional support: a
phrase with ``support`` occurrences overall has, in at least one shard ``i``, a
count ``c`` with ``c * N >= support * n_i`` (``n_i`` of the language's ``N``
words lie in the shard).  A shard is as large as the corpus makes it, so it is
counted by a Spark aggregation, not inside one task; a task combines its own
occurrences first.  The union of the locally frequent phrases are the
candidates; as every shard is counted completely, a candidate's exact count is
the sum over all shards, worked out where its local counts already lie.  Words
come first, then pairs of frequent words, then phrases of three and more words
all of whose pairs are frequent.

What a task must know of the level before is a Bloom filter of ``2**bits`` bits
(its size is fixed, whatever the corpus); what it lets through wrongly falls
below the support.  Texts of the frequent phrases come from one last scan: the
counts name one split that holds the phrase, and a filter of (phrase, split)
lets only that split's tasks send its text, so that a phrase is sent about once
and not by every task.

Phrases are known by a 64-bit hash of their language and words.  A rarer phrase
with the same hash would be added to a frequent one's count: for 10**13 distinct
phrases that is a chance of 5e-7 for a given frequent phrase.

Words are lower-cased (A-Z only); phrases never cross a piece (see ``BREAKS``)
or a text.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count as often as they stand there; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cuecards.llm import textvec as tv
from cuecards.llm.common import segments, stage, text_buffers

#: What ends a piece, and what else ends a word.
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_BREAK = np.zeros(256, bool)
_BREAK[[*BREAKS]] = True
_WORD = np.ones(256, bool)
_WORD[[*BREAKS, *BLANKS]] = False

#: Occurrences a task holds before it hands on their counts.
HELD = 4_000_000


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _passes(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set (``bloom``: 64-bit words)."""
    bits = np.uint64(len(bloom).bit_length() + 5)
    out = np.ones(len(h), bool)
    for at in (h >> (np.uint64(64) - bits), (h << bits) >> (np.uint64(64) - bits)):
        out &= (bloom[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


class _Segment:
    """The words of one segment: bounds, piece, text, and the hash of any run of words."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, seeds: np.ndarray):
        self.raw = raw
        self.start, self.end, first = tv.word_bounds(raw, off, _WORD)
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(first))
        piece = np.searchsorted(np.flatnonzero(_BREAK[raw]), self.start)
        new = np.ones(len(self.start), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (self.text[1:] != self.text[:-1])
        self.run = np.cumsum(new, dtype=np.int32)
        self.prefix = tv.prefix_hash(tv.word_hashes(raw, self.start, self.end))
        self.seeds = seeds

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return tv.mix(tv.window_hash(self.prefix, at, at + size) + self.seeds[self.text[at]])

    def phrases(self, sizes: tuple[int, ...], words: np.ndarray | None, pairs: np.ndarray | None
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(size, first words, hashes)`` of the phrases whose words and
        pairs pass the given filters."""
        n = len(self.start)
        every = np.arange(n)
        one = self.hashes(every, 1) if words is not None or 1 in sizes else None
        good = np.ones(n, bool) if words is None else _passes(words, one)
        if 1 in sizes:
            yield 1, every[good], one[good]
        if max(sizes) < 2:
            return
        at = np.flatnonzero(good[:-1] & good[1:] & (self.run[:-1] == self.run[1:]))
        two = self.hashes(at, 2)
        if pairs is not None:
            passed = _passes(pairs, two)
            at, two = at[passed], two[passed]
        if 2 in sizes:
            yield 2, at, two
        if max(sizes) < 3:
            return
        begins = np.zeros(n + max(sizes), bool)  # a good pair begins here
        begins[at] = True
        for size in range(3, max(sizes) + 1):
            at = at[begins[at + size - 2]]
            if size in sizes:
                yield size, at, self.hashes(at, size)

    def phrase(self, at: int, size: int) -> bytes:
        return b" ".join(self.raw[self.start[at]: self.end[at + size - 1]].tobytes().lower().split())


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[_Segment, list, np.ndarray]]:
    """Each segment of a batch, its distinct (split, language) pairs and the pair of each word."""
    raw, off = text_buffers(batch.column("text"))
    owners = list(zip(batch.column("split").to_pylist(), batch.column("lang").to_pylist(), strict=True))
    code = {o: i for i, o in enumerate(dict.fromkeys(owners))}
    codes = np.array([code[o] for o in owners], np.int64)
    seeds = np.array([_seed(o[1]) for o in code], np.uint64)
    for i, j in segments(off):
        seg = _Segment(raw[off[i]: off[j]], off[i: j + 1] - off[i], seeds[codes[i: j]])
        if len(seg.start):
            yield seg, list(code), codes[i: j][seg.text]


def _by_owner(owner: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(owner[part[0]]), tuple(c[part] for c in columns)


def _counter(sizes: tuple[int, ...], words=None, pairs=None) -> Callable:
    """``mapInArrow``: a task's counts of hashed phrases per split and language."""
    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for (split, lang), arrays in held.items():
            h, n = np.unique(np.concatenate(arrays), return_counts=True)
            for k in range(0, len(h), 1 << 17):
                part = h[k: k + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), split, np.int64)), pa.array([lang] * len(part), pa.string()),
                     pa.array(part.view(np.int64)), pa.array(n[k: k + (1 << 17)])], ["split", "lang", "h", "n"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            for seg, owners, owner in _parts(batch):
                for _, at, h in seg.phrases(sizes, words and words.value, pairs and pairs.value):
                    for code, (own,) in _by_owner(owner[at], h):
                        held[owners[code]].append(own)
                    size += len(h)
                if size >= HELD:
                    yield from emit(held)
                    size = 0
        yield from emit(held)

    return run


def _spell(longest: int, words, pairs, wanted) -> Callable:
    """``mapInArrow``: the texts of the phrases whose (phrase, split) pass ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for seg, owners, owner in _parts(batch):
                splits = np.array([o[0] for o in owners], np.int64).view(np.uint64)
                out = []
                for m, at, h in seg.phrases(tuple(range(1, longest + 1)), words.value, pairs.value):
                    hit = _passes(wanted.value, h ^ splits[owner[at]])
                    found, where = np.unique(h[hit], return_index=True)
                    out += [(owners[owner[i]][1], x, m, seg.phrase(i, m).decode("utf-8", "replace"))
                            for x, i in zip(found.view(np.int64).tolist(), at[hit][where].tolist(), strict=True) if x not in sent]
                if len(sent) > HELD:  # sending a text twice does no harm
                    sent.clear()
                sent.update(o[1] for o in out)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], ["lang", "h", "size", "phrase"])

    return run


def _bloom(hashes: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of ``2**bits`` bits, two a hash; at most ``2**(bits - 6)`` rows reach the driver."""
    places = hashes.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - bits),
                                             F.shiftrightunsigned(F.shiftleft("h", bits), 64 - bits))).alias("at"))
    rows = (places.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("one"))
            .groupBy("word").agg(F.bit_or("one").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = 100,
                     longest: int = 5, shards: int = 4, bits: int = 26) -> tuple[DataFrame, DataFrame]:
    """Exact counts ``(lang, size, phrase, n)`` of all phrases of up to
    ``longest`` words with at least ``support`` occurrences in their language,
    and ``(lang, words)``, the number of all words of each language."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    src = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        # the same scan has the same splits in every pass; a table that no file backs is one split
        F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"))
    shard = F.pmod("split", F.lit(shards)).alias("shard")

    def counted(sizes, *filters) -> DataFrame:
        """The shards' complete counts; one exchange serves both aggregations of ``candidates``."""
        rows = src.mapInArrow(_counter(sizes, *filters), "split long, lang string, h long, n long")
        return rows.repartition("lang", "h").groupBy("lang", "h", shard).agg(F.sum("n").alias("n"), F.min("split").alias("split"))

    def candidates(counts: DataFrame) -> DataFrame:
        wide = {c: F.col(c).cast("decimal(18,0)") for c in ("n", "all_words", "part_words")}
        local = wide["n"] * wide["all_words"] >= wide["part_words"] * F.lit(support)
        found = (counts.join(parts, ["shard", "lang"]).groupBy("lang", "h")
                 .agg(F.sum("n").alias("n"), F.max(local).alias("local"), F.min("split").alias("split")))
        return found.where("local").where(F.col("n") >= support).select("lang", "h", "n", "split")

    words_found = stage(counted((1,)), "phrase-words")
    parts = words_found.groupBy("shard", "lang").agg(F.sum("n").alias("part_words"))
    parts = stage(parts.join(parts.groupBy("lang").agg(F.sum("part_words").alias("all_words")), "lang"), "phrase-parts")
    found = [stage(candidates(words_found), "phrase-level1")]
    words = share(_bloom(found[0], bits))
    found.append(stage(candidates(counted((2,), words)), "phrase-level2"))
    pairs = share(_bloom(found[1], bits))
    if longest > 2:
        found.append(stage(candidates(counted(tuple(range(3, longest + 1)), words, pairs)), "phrase-level3"))
    frequent = found[0]
    for more in found[1:]:
        frequent = frequent.unionByName(more)
    wanted = share(_bloom(frequent.select(F.col("h").bitwiseXOR(F.col("split")).alias("h")), bits))
    texts = (src.mapInArrow(_spell(longest, words, pairs, wanted), "lang string, h long, size int, phrase string")
             .groupBy("lang", "h").agg(F.min("size").alias("size"), F.min("phrase").alias("phrase")))
    out = stage(frequent.join(texts, ["lang", "h"]).select("lang", "size", "phrase", "n"), "phrase-counts")
    return out, parts.groupBy("lang").agg(F.max("all_words").alias("words"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = 100, longest: int = 5,
                 top: int = 2000, share: int = 100, **how) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language:
    ``lang, rank, phrase, a, l, r, n, score``.

    A phrase's score is that of its weakest cut, ``1000 * a * n div (l * r)``
    in 38-digit decimals.  A phrase goes if a longer frequent phrase holds it
    with at least ``share`` per cent of its occurrences; as counts only fall
    with every word added, the phrases one word longer decide that.
    """
    found, all_words = frequent_phrases(docs, text_col, lang_col, support, longest, **how)
    cand = (found.where("size > 1")
            .select("lang", "phrase", F.col("n").alias("a"), "size", F.split("phrase", " ").alias("w")))

    def run(first, n):
        return F.array_join(F.slice("w", first, n), " ")

    def lookup(name: str, key: str) -> DataFrame:
        return found.select("lang", F.col("phrase").alias(key), F.col("n").alias(name))

    cuts = (cand.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
            .select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("head"),
                    run(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
            .join(lookup("l", "head"), ["lang", "head"]).join(lookup("r", "tail"), ["lang", "tail"]).join(all_words, "lang"))
    score = F.expr("cast((cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(words as decimal(17,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as long)")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "words")).alias("b")).select("lang", "phrase", "b.*"))
    inner = (cand.where("size > 2")
             .select("lang", F.explode(F.array(run(F.lit(1), F.col("size") - 1), run(F.lit(2), F.col("size") - 1))).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score"))
