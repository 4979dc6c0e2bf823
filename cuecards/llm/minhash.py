"""MinHash near-duplicate detection.

Texts are lower-cased (A-Z), split into words, and turned into the set of their
``shingle`` consecutive words.  Per text: ``bands * rows`` universal hash
minima, one key per band.  Texts with equal sets form one class first, so
copies cost one row each from there on.  Classes that share a band key are
candidates; a candidate link is confirmed on the full sets.  Links are closed
to components by alternating large-star and small-star steps.

Candidates are taken in two passes, so that a bucket of m near copies costs m
checks and not m squared.  First every class is checked against the smallest
class it meets in any bucket.  A pair inside a component then needs no check: it
changes nothing.  What is left are buckets whose members are still in different
components; a large group of texts just below the similarity makes such
buckets.  Their members go through an exact prefix join: with all shingles in
one global order, rare ones first, two sets at the similarity share a shingle
near the front of both, and the positions of the first shared one bound the
overlap.  Frequencies come from a table of ``slots`` counters (they steer the
order, so they affect cost only).  Nothing is capped.

Defined results: a null or empty text, or one without words, has no set and no
links; a text of fewer than ``shingle`` words has its whole word sequence as
the only element; repeated rows are copies of each other; rows with a repeated
id are one node that has all the rows' links; a row without id is returned
unlinked (component null, kept true).  Extra columns are ignored.

The chance to miss a pair at similarity 0.8 exactly is ``(1 - 0.8**5)**40``,
about 1.2e-7; above it, less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import per_segment, segments, stage, text_buffers
from cuecards.llm.components import connected_components

U = np.uint64
_SIG_BLOCK = 256


def shingle_hashes(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word windows that start at each word, word hashes,
    and the first word of each text."""
    start, end, first = tv.word_bounds(raw, off, tv.NON_SPACE)
    words = tv.word_hashes(raw, start, end)
    c = tv.constants(k, 11) | U(1)
    n = max(0, len(words) - k + 1)
    acc = np.zeros(n, U)
    for i in range(k):
        acc += words[i: i + n] * c[i]
    return tv.mix(acc), words, first


def shingle_set(sh: np.ndarray, words: np.ndarray, lo: int, hi: int, k: int) -> np.ndarray:
    """The sorted distinct shingles of the text whose words are ``lo:hi``."""
    n = hi - lo
    if n >= k:
        return np.unique(sh[lo: hi - k + 1])
    if n == 0:
        return np.zeros(0, U)
    c = tv.constants(k, 11) | U(1)
    tagged = np.append(words[lo:hi] * c[:n], tv.constants(k, 12)[n - 1])
    return tv.mix(tagged.sum(dtype=U, keepdims=True))


def _sketcher(k: int, bands: int, rows: int):
    m = bands * rows

    def one(raw, off, carry):
        mul, add = tv.constants(m, 21) | U(1), tv.constants(m, 22)
        fold, name = tv.constants(rows, 23) | U(1), tv.constants(bands, 24)
        sh, words, first = shingle_hashes(raw, off, k)
        n = len(off) - 1
        size, digest, keys = np.zeros(n, np.int64), [], np.zeros((n, bands), U)
        low = np.empty((_SIG_BLOCK, m), U)
        for i in range(n):
            s = shingle_set(sh, words, first[i], first[i + 1], k)
            size[i] = len(s)
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            if not len(s):
                continue
            sig = np.full(m, np.iinfo(np.uint64).max, U)
            for b in range(0, len(s), _SIG_BLOCK):
                part = s[b: b + _SIG_BLOCK]
                buf = low[: len(part)]
                np.multiply(part[:, None], mul[None, :], out=buf)
                buf += add
                np.minimum(sig, buf.min(axis=0), out=sig)
            keys[i] = tv.mix((sig.reshape(bands, rows) * fold).sum(axis=1, dtype=U) + name)
        flat = pa.array(keys.reshape(-1).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)
        return pa.RecordBatch.from_arrays(
            [carry["doc"], carry["text_key"], pa.array(size), pa.array(digest, pa.binary()), lists],
            ["doc", "text_key", "n_shingles", "digest", "bands"])

    return per_segment(one, "text", "doc", "text_key")


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """One row per document: ``doc, text_key, n_shingles, digest`` of the set,
    and the band keys."""
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return src.mapInArrow(_sketcher(k, bands, rows),
                          "doc long, text_key long, n_shingles long, digest binary, bands array<long>")


def _sets(texts: pa.Array, want: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index and set of each text whose set has the wanted digest (another row
    of a repeated id may have another)."""
    raw, off = text_buffers(texts)
    for i, j in segments(off):
        sh, words, first = shingle_hashes(raw[off[i]: off[j]], off[i: j + 1] - off[i], k)
        for t in range(j - i):
            s = shingle_set(sh, words, first[t], first[t + 1], k)
            if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == want[i + t]:
                yield i + t, s


def _confirmer(k: int, percent: int):
    """Pairs whose two texts, found among the rows of one (a, b), reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, have = None, {}
        for batch in batches:
            a, b = batch.column("a").to_numpy(zero_copy_only=False), batch.column("b").to_numpy(zero_copy_only=False)
            side = batch.column("side").to_pylist()
            left, right = [], []
            for i, s in _sets(batch.column("text"), batch.column("want").to_pylist(), k):
                if key != (a[i], b[i]):
                    key, have = (a[i], b[i]), {}
                if side[i] in have:
                    continue
                have[side[i]] = s
                if len(have) == 2:
                    x, y = have.values()
                    both = np.intersect1d(x, y, assume_unique=True).size
                    if 100 * both >= percent * (x.size + y.size - both):
                        left.append(int(key[0]))
                        right.append(int(key[1]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of class representatives that are links on full
    sets.  Each pair's two texts meet by a shuffle on the pair, so a class with
    thousands of partners is spread out."""
    ends = (pairs.select("a", "b", F.col("a").alias("rep"), F.lit(0).alias("side"))
            .unionAll(pairs.select("a", "b", F.col("b").alias("rep"), F.lit(1).alias("side"))))
    rows = (ends.join(texts, "rep").select("a", "b", "side", "want", "text")
            .repartition("a", "b").sortWithinPartitions("a", "b"))
    return rows.mapInArrow(_confirmer(k, percent), "a long, b long")


def _prefix_join(open_texts: DataFrame, k: int, percent: int, slots: int) -> DataFrame:
    """Pairs ``(a, b)`` of classes in different components that may reach the
    similarity; none that reaches it is missing.

    ``open_texts (rep, comp, want, text)``.  For sets of sizes x <= y the
    overlap must be at least ``need = percent / (100 + percent) * (x + y)``, so
    the first shared shingle stands early enough to leave that many in both."""
    shift = U(64 - slots.bit_length() + 1)

    def count(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            for _, s in _sets(batch.column("text"), batch.column("want").to_pylist(), k):
                total += np.bincount((s >> shift).astype(np.int64), minlength=slots)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    spark = open_texts.sparkSession
    counted = (open_texts.select("want", "text").mapInArrow(count, "slot long, n long")
               .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())  # at most ``slots`` rows
    often = np.zeros(slots, np.int64)
    often[counted["slot"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    often = spark.sparkContext.broadcast(often)

    def prefixes(batches):
        for batch in batches:
            rep, comp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "comp"))
            for i, s in _sets(batch.column("text"), batch.column("want").to_pylist(), k):
                n = len(s)
                s = s[np.lexsort((s, often.value[(s >> shift).astype(np.int64)]))]
                s = s[: n - -(-percent * n // 100) + 1]
                m = len(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.view(np.int64)), pa.array(np.arange(m, dtype=np.int32)),
                     pa.array(np.full(m, n, np.int32)), pa.array(np.full(m, rep[i])), pa.array(np.full(m, comp[i]))],
                    ["token", "pos", "n", "rep", "comp"])

    rows = stage(open_texts.mapInArrow(prefixes, "token long, pos int, n int, rep long, comp long"), "minhash-prefix")
    # a shingle of one component only joins nothing
    mixed = (rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo < hi").select("token"))
    rows = stage(rows.join(mixed, "token"), "minhash-prefix")
    small = rows.where(((F.col("n") - F.col("pos")) * (100 + percent)) >= 2 * percent * F.col("n")).alias("x")
    large = rows.alias("y")
    left = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (small.join(large, F.col("x.token") == F.col("y.token"))
            .where((F.col("x.comp") != F.col("y.comp"))
                   & (F.struct("x.n", "x.rep") < F.struct("y.n", "y.rep"))
                   & (100 * F.col("x.n") >= percent * F.col("y.n"))
                   & ((100 + percent) * left >= percent * (F.col("x.n") + F.col("y.n"))))
            .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = 40, rows: int = 5, slots: int = 1 << 16) -> DataFrame:
    """Per row of ``docs``: ``doc, text_key`` (hash of the text), ``n_shingles,
    component, kept``."""
    found = stage(sketches(docs, id_col, text_col, shingle, bands, rows), "minhash-sketch")
    # rows of one digest are equal, so any value of the others will do
    classes = stage(found.where("doc is not null and digest is not null").groupBy("digest")
                    .agg(F.min("doc").alias("rep"), F.first("bands").alias("bands")), "minhash-classes")
    placed = stage(found.select("doc", "text_key", "n_shingles", "digest")
                   .join(classes.select("digest", "rep"), "digest", "left").drop("digest"), "minhash-rows")

    banded = classes.select("rep", "digest", F.explode("bands").alias("key"))
    shared = stage(banded.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
                   .where("low < high").select("key", "low"), "minhash-shared")
    members = stage(banded.join(shared, "key").select("key", "rep", "digest", "low"), "minhash-buckets")
    wanted = members.select("rep", F.col("digest").alias("want")).distinct()
    texts = stage(docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
                  .join(wanted, "rep"), "minhash-texts")

    first = (members.where("low < rep").groupBy("rep").agg(F.min("low").alias("a"))
             .select("a", F.col("rep").alias("b")))
    links = stage(_confirm(first, texts, shingle, percent), "minhash-links")
    comp = stage(connected_components(links), "minhash-comp")

    now = stage(members.select("key", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                .select("key", "rep", F.coalesce("component", "rep").alias("comp")), "minhash-now")
    split = stage(now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                  .where("lo < hi").select("key"), "minhash-split")
    open_ = now.join(split, "key").select("rep", "comp").distinct()
    open_texts = stage(texts.join(open_, "rep"), "minhash-open")
    second = _prefix_join(open_texts, shingle, percent, slots)
    more = stage(_confirm(second, texts, shingle, percent), "minhash-links")

    # rows of one repeated id are one node, whatever their sets
    several = (placed.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b"))
    ids = placed.join(several.select("doc", "a"), "doc").select("a", F.col("rep").alias("b"))
    comp = stage(connected_components(comp.select(F.col("component").alias("a"), F.col("node").alias("b"))
                                      .unionAll(more).unionAll(ids)), "minhash-comp")
    return (placed.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc", "text_key", "n_shingles", F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep", "doc")).alias("component"))
            .withColumn("kept", F.coalesce(F.col("component") == F.col("doc"), F.lit(True))))
