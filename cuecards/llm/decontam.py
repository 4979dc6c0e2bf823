"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by document, as in a sharded search engine: each
segment of the corpus (about ``segment`` bytes of text) stores one row with the
sorted terms of the segment and, for each, the positions of its tokens.  The
rows are written to the shared folder.  Test phrases (windows of ``n`` words of
an item; an item with fewer words is one phrase) come to the segments in blocks
of bounded size; inside a segment the offset-adjusted position lists of a
phrase are intersected from its rarest term on.  Texts never cross a shuffle;
only the found spans do.

Terms are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, compared by
64-bit hashes.  Segments keep only the terms that the benchmark uses, if that
vocabulary is within ``max_terms`` (else all terms); phrases beyond
``max_phrases`` are matched block by block.  Neither bound changes a result.

Defined results: null or empty texts have no words and no hits; an item without
words matches nothing; a null item id matches words but is not listed; repeated
items count once; rows of ``docs`` are judged one by one, so repeated ids stay
separate rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import per_segment, segments, stage, text_buffers

U = np.uint64
_POSTINGS = ("seg long, ids array<long>, text_keys array<long>, n_words array<int>, base binary, "
             "terms binary, ptr binary, pos binary")


def _tokens(raw, off):
    start, end, first = tv.word_bounds(raw, off, tv.ALNUM)
    return tv.word_hashes(raw, start, end), first


def _member(sorted_terms: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_terms):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_terms, x)
    at[at == len(sorted_terms)] = 0
    return sorted_terms[at] == x


def _phrases(n: int):
    """Rows (item, terms) of each item's windows."""
    def one(raw, off, carry):
        terms, first = _tokens(raw, off)
        items, lists = [], []
        ids = carry["item"].to_pylist()
        for i, item in enumerate(ids):
            w = terms[first[i]: first[i + 1]].view(np.int64)
            for s in range(max(1, len(w) - n + 1) if len(w) else 0):
                items.append(item)
                lists.append(w[s: s + n])
        return pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                                          ["item", "terms"])
    return per_segment(one, "text", "item")


def _indexer(vocab, gap: int, segment: int):
    """``mapInArrow`` function that writes one row of postings per segment."""
    keep = None
    if vocab is not None:
        small = np.zeros(1 << 16, bool)
        small[(vocab >> U(48)).astype(np.int64)] = True

        def keep(h):
            hit = np.flatnonzero(small[(h >> U(48)).astype(np.int64)])
            return hit[_member(vocab, h[hit])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            raw_all, off_all = text_buffers(batch.column("text"))
            for i, j in segments(off_all, segment):
                terms, poss = [], []
                ids = batch.column("doc").slice(i, j - i)
                counts, base, at = [], [], 0
                # hash in small steps; positions run on over the segment with a gap between texts
                for k, m in segments(off_all[i: j + 1]):
                    lo = off_all[i + k]
                    h, first = _tokens(raw_all[lo: off_all[i + m]], off_all[i + k: i + m + 1] - lo)
                    n_words = np.diff(first)
                    begin = at + np.concatenate([[0], np.cumsum(n_words + gap)])
                    pos = np.arange(len(h)) - np.repeat(first[:-1], n_words) + np.repeat(begin[:-1], n_words)
                    at = int(begin[-1])
                    counts.append(n_words)
                    base.append(begin[:-1])
                    sel = keep(h) if keep else slice(None)
                    terms.append(h[sel])
                    poss.append(pos[sel].astype(np.int32))
                t, p = np.concatenate(terms), np.concatenate(poss)
                order = np.argsort(t, kind="stable")
                t, p = t[order], p[order]
                uniq, ptr = np.unique(t, return_index=True)
                made += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                     pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                     pa.array([batch.column("text_key").slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.concatenate(counts).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([np.concatenate(base).astype(np.int32).tobytes()], pa.binary()),
                     pa.array([uniq.tobytes()], pa.binary()),
                     pa.array([np.append(ptr, len(p)).astype(np.int32).tobytes()], pa.binary()),
                     pa.array([p.tobytes()], pa.binary())],
                    ["seg", "ids", "text_keys", "n_words", "base", "terms", "ptr", "pos"])
    return run


def build_index(docs: DataFrame, vocab, id_col: str, text_col: str, gap: int, segment: int) -> DataFrame:
    """The postings table: one row per segment of the corpus."""
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return stage(src.mapInArrow(_indexer(vocab, gap, segment), _POSTINGS), "postings")


def term_frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Corpus frequency of each wanted term (terms that never occur are left out)."""
    def count(batches):
        for batch in batches:
            t = [np.frombuffer(x, np.int64) for x in batch.column("terms").to_pylist()]
            n = [np.diff(np.frombuffer(x, np.int32)).astype(np.int64) for x in batch.column("ptr").to_pylist()]
            if t:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(t)), pa.array(np.concatenate(n))],
                                                 ["term", "n"])
    counted = index.select("terms", "ptr").mapInArrow(count, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi")


def _matcher(vocab: np.ndarray, freq: np.ndarray, windows: np.ndarray, length: np.ndarray, items: list[list[int]]):
    """Spans of phrases in each segment.  ``windows``: indexes into ``vocab``,
    padded by repeating the first term; ``items``: the item ids of a phrase."""
    order = np.argsort(freq[windows], axis=1, kind="stable")  # rarest first, by the whole corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                terms, ptr = np.frombuffer(row["terms"], U), np.frombuffer(row["ptr"], np.int32)
                pos, base = np.frombuffer(row["pos"], np.int32), np.frombuffer(row["base"], np.int32)
                at = np.searchsorted(terms, vocab)
                at[at == len(terms)] = 0
                have = terms[at] == vocab if len(terms) else np.zeros(len(vocab), bool)
                docs: dict[int, tuple[list, set]] = {}
                for w in np.flatnonzero(have[windows].all(axis=1)):
                    starts = None
                    for o in order[w]:
                        if o >= length[w]:
                            continue
                        k = at[windows[w, o]]
                        here = pos[ptr[k]: ptr[k + 1]] - o
                        starts = here if starts is None else starts[_member_sorted(here, starts)]
                        if not len(starts):
                            break
                    for s, d in zip(starts, np.searchsorted(base, starts, "right") - 1, strict=True):
                        spans, seen = docs.setdefault(int(d), ([], set()))
                        spans.append((int(s - base[d]), int(s - base[d] + length[w])))
                        seen.update(items[w])
                if docs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["seg"]] * len(docs), pa.int64()), pa.array(list(docs), pa.int32()),
                         pa.array([[{"s": s, "e": e} for s, e in sorted(set(v[0]))] for v in docs.values()],
                                  pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                         pa.array([sorted(v[1]) for v in docs.values()], pa.list_(pa.int64()))],
                        ["seg", "doc_no", "spans", "items"])
    return run


def _member_sorted(big: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.searchsorted(big, x)
    at[at == len(big)] = 0
    return big[at] == x


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", n: int = 10, segment: int = 4 << 20,
                  max_terms: int = 4_000_000, max_phrases: int = 500_000) -> DataFrame:
    """Per row of ``docs``: ``doc, text_key`` (hash of the text), ``n_words,
    n_hit, n_items, items, spans, contaminated``; ``spans`` are the found phrases
    as word ranges."""
    spark = docs.sparkSession
    src = benchmark.select(F.col(item_col).cast("long").alias("item"),
                           F.col(item_text).cast("string").alias("text"))
    phrases = stage(src.mapInArrow(_phrases(n), "item long, terms array<long>"), "phrases")
    words = phrases.select(F.explode("terms").alias("term")).distinct()
    n_terms, n_phrases = words.count(), phrases.count()
    vocab = None
    if n_terms <= max_terms:  # checked bound: eight bytes a term
        vocab = np.sort(words.toPandas()["term"].to_numpy(np.int64).view(U)) if n_terms else np.zeros(0, U)
    index = build_index(docs, vocab, id_col, text_col, n, segment)
    counts = stage(term_frequencies(index, words), "term-counts")

    blocks = max(1, -(-n_phrases // max_phrases))
    key = F.pmod(F.xxhash64("terms"), F.lit(blocks))
    hits = None
    for b in range(blocks):
        block = (phrases.where(key == b).groupBy("terms").agg(F.collect_set("item").alias("items"))
                 .toPandas())  # at most about max_phrases rows
        if not len(block):
            continue
        lists = [np.asarray(t, np.int64).view(U) for t in block["terms"]]
        own = np.unique(np.concatenate(lists))
        seen = counts
        if blocks > 1:
            seen = counts.join(phrases.where(key == b).select(F.explode("terms").alias("term")), "term", "left_semi")
        seen = seen.toPandas()
        freq = np.zeros(len(own), np.int64)
        freq[np.searchsorted(own, seen["term"].to_numpy(np.int64).view(U))] = seen["n"].to_numpy(np.int64)
        length = np.array([len(t) for t in lists], np.int64)
        windows = np.empty((len(lists), n), np.int64)
        for i, t in enumerate(lists):
            windows[i, : len(t)] = np.searchsorted(own, t)
            windows[i, len(t):] = windows[i, 0]
        items = [sorted(int(x) for x in v) for v in block["items"]]
        model = spark.sparkContext.broadcast((own, freq, windows, length, items))

        def match(batches, model=model):
            yield from _matcher(*model.value)(batches)

        part = index.select("seg", "base", "terms", "ptr", "pos").mapInArrow(
            match, "seg long, doc_no int, spans array<struct<s: int, e: int>>, items array<long>")
        hits = part if hits is None else hits.unionAll(part)
    rows = index.select("seg", F.posexplode(F.arrays_zip("ids", "text_keys", "n_words")).alias("doc_no", "x")).select(
        "seg", "doc_no", F.col("x.ids").alias("doc"), F.col("x.text_keys").alias("text_key"), F.col("x.n_words").cast("long").alias("n_words"))
    if hits is None:
        hits = spark.createDataFrame([], "seg long, doc_no int, spans array<struct<s: int, e: int>>, items array<long>")
    found = hits.groupBy("seg", "doc_no").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                              F.flatten(F.collect_list("items")).alias("items"))
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).alias("n"),
                                F.greatest(acc["end"], x["e"]).alias("end")))["n"]
    found = found.select("seg", "doc_no", "spans", covered.cast("long").alias("n_hit"),
                         F.array_sort(F.transform(F.array_distinct("items"), lambda x: x.cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    return (rows.join(found, ["seg", "doc_no"], "left")
            .select("doc", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", none).alias("items"), "spans")
            .withColumn("contaminated", F.col("n_hit") > 0))
