"""Proximity matches of benchmark passages on the positional inverted index.

``decontam`` finds a benchmark window word for word.  Here a window of ``n`` words
matches wherever a run of at most ``n + slop`` words of a document holds at least
``share`` of the window's different terms, in any order, so that a passage with
words inserted, replaced or moved is found too.

Postings are those of ``decontam.build_index``, with a gap between texts as wide as
a run.  Inside a segment a window starts from its rarest terms: if ``need`` of
``t`` terms must occur, one of the ``t - need + 1`` rarest must, so only positions
beside one of those are looked at.  That leaves out no match.  Windows come in
blocks of ``max_phrases``; neither this bound nor ``segment`` or ``max_terms``
changes a result.

Defined results: null or empty texts have no words and no match; an item of fewer
than ``n`` words, but not none, is one window; an item without words matches
nothing; a null item id matches words but is not listed; repeated items count
once; rows of ``docs`` are judged one by one, so repeated ids stay separate rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm.common import stage
from cuecards.llm.decontam import U, _phrases, build_index, term_frequencies

_RUNS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_FOUND = "seg long, doc_no int, spans array<struct<s: int, e: int>>, items array<long>"


def _runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the words that the spans cover."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.append(True, start[1:] > end[:-1])
    return start[first], end[np.append(first[1:], True)]


def _near(lists: list[np.ndarray], rare: int, need: int, span: int, step: int = 1 << 16):
    """Spans of at most ``span`` words with ``need`` of the terms, each from a term to
    the last one within reach.  ``lists``: positions of each term; the first
    ``rare`` of them are the anchors."""
    anchors = np.sort(np.concatenate(lists[:rare]))
    if not len(anchors):
        return anchors, anchors
    close = []
    for p in lists:
        j = np.searchsorted(anchors, p - (span - 1))
        close.append(p[(j < len(anchors)) & (anchors[np.minimum(j, len(anchors) - 1)] <= p + (span - 1))])
    term = np.repeat(np.arange(len(lists)), [len(p) for p in close])
    pos = np.concatenate(close)
    order = np.argsort(pos, kind="stable")
    pos, term = pos[order], term[order]
    by_term = np.lexsort((pos, term))
    before = np.full(len(pos), -1)  # the same term's occurrence before
    same = term[by_term[1:]] == term[by_term[:-1]]
    before[by_term[1:][same]] = by_term[:-1][same]
    starts, ends = [], []
    for lo in range(0, len(pos), step):  # a position holds one word, so a run holds ``span`` of them at most
        i = np.arange(lo, min(lo + step, len(pos)))
        at = i[:, None] + np.arange(span)[None, :]
        inside = at < len(pos)
        at = np.minimum(at, len(pos) - 1)
        inside &= pos[at] < pos[i][:, None] + span
        hit = (inside & (before[at] < i[:, None])).sum(axis=1) >= need
        starts.append(pos[i[hit]])
        ends.append(pos[(i + inside.sum(axis=1) - 1)[hit]] + 1)
    return np.concatenate(starts), np.concatenate(ends)


def _matcher(vocab, windows, length, need, items, span: int):
    """Runs near a window in each segment.  ``windows``: indexes into ``vocab``,
    rarest term first, padded with -1."""
    used = windows >= 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                terms, ptr = np.frombuffer(row["terms"], U), np.frombuffer(row["ptr"], np.int32)
                pos, base = np.frombuffer(row["pos"], np.int32).astype(np.int64), np.frombuffer(row["base"], np.int32)
                at = np.searchsorted(terms, vocab)
                at[at == len(terms)] = 0
                have = terms[at] == vocab if len(terms) else np.zeros(len(vocab), bool)
                docs: dict[int, tuple[list, list, set]] = {}
                for w in np.flatnonzero((have[windows] & used).sum(axis=1) >= need):
                    own = [pos[ptr[at[v]]: ptr[at[v] + 1]] if have[v] else pos[:0] for v in windows[w, : length[w]]]
                    start, end = _near(own, length[w] - need[w] + 1, need[w], span)
                    doc = np.searchsorted(base, start, "right") - 1
                    for d in np.unique(doc):
                        starts, ends, seen = docs.setdefault(int(d), ([], [], set()))
                        starts.append(start[doc == d] - base[d])
                        ends.append(end[doc == d] - base[d])
                        seen.update(items[w])
                if docs:
                    runs = [_runs(np.concatenate(v[0]), np.concatenate(v[1])) for v in docs.values()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["seg"]] * len(docs), pa.int64()), pa.array(list(docs), pa.int32()),
                         pa.array([[{"s": int(s), "e": int(e)} for s, e in zip(*r, strict=True)] for r in runs], _RUNS),
                         pa.array([sorted(v[2]) for v in docs.values()], pa.list_(pa.int64()))],
                        ["seg", "doc_no", "spans", "items"])
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs that all blocks found in one row of ``docs``."""
    for batch in batches:
        out = {"seg": [], "doc_no": [], "spans": [], "items": []}
        for row in batch.to_pylist():
            s, e = _runs(np.array([x["s"] for x in row["spans"]]), np.array([x["e"] for x in row["spans"]]))
            out["seg"].append(row["seg"])
            out["doc_no"].append(row["doc_no"])
            out["spans"].append([{"s": int(a), "e": int(b)} for a, b in zip(s, e, strict=True)])
            out["items"].append(sorted(set(row["items"])))
        kinds = [pa.int64(), pa.int32(), _RUNS, pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))


def near_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", n: int = 10, slop: int = 4, share: float = 0.8,
                 segment: int = 4 << 20, max_terms: int = 4_000_000, max_phrases: int = 500_000) -> DataFrame:
    """Per row of ``docs``: ``doc, text_key`` (hash of the text), ``n_words, n_near``
    (words inside a match), ``near_items`` (ids as text, sorted), ``near_spans``
    (maximal runs of such words)."""
    spark = docs.sparkSession
    src = benchmark.select(F.col(item_col).cast("long").alias("item"),
                           F.col(item_text).cast("string").alias("text"))
    windows_of = src.mapInArrow(_phrases(n), "item long, terms array<long>")
    phrases = stage(windows_of.select("item", F.array_sort(F.array_distinct("terms")).alias("terms")).distinct(), "near-phrases")
    words = phrases.select(F.explode("terms").alias("term")).distinct()
    n_terms, n_phrases = words.count(), phrases.count()
    vocab = None
    if n_terms <= max_terms:  # checked bound: eight bytes a term
        vocab = np.sort(words.toPandas()["term"].to_numpy(np.int64).view(U)) if n_terms else np.zeros(0, U)
    index = build_index(docs, vocab, id_col, text_col, n + slop, segment)
    counts = stage(term_frequencies(index, words), "near-counts")

    blocks = max(1, -(-n_phrases // max_phrases))
    key = F.pmod(F.xxhash64("terms"), F.lit(blocks))
    hits = spark.createDataFrame([], _FOUND)
    for b in range(blocks):
        block = (phrases.where(key == b).groupBy("terms").agg(F.collect_set("item").alias("items"))
                 .toPandas())  # at most about max_phrases rows
        if not len(block):
            continue
        lists = [np.asarray(t, np.int64).view(U) for t in block["terms"]]
        own = np.unique(np.concatenate(lists))
        wanted = phrases.where(key == b).select(F.explode("terms").alias("term"))
        seen = counts.join(wanted, "term", "left_semi").toPandas()
        freq = np.zeros(len(own), np.int64)
        freq[np.searchsorted(own, seen["term"].to_numpy(np.int64).view(U))] = seen["n"].to_numpy(np.int64)
        length = np.array([len(t) for t in lists], np.int64)
        need = np.array([max(1, math.ceil(share * len(t) - 1e-9)) for t in lists], np.int64)
        windows = np.full((len(lists), n), -1, np.int64)
        for i, t in enumerate(lists):
            v = np.searchsorted(own, t)
            windows[i, : len(t)] = v[np.argsort(freq[v], kind="stable")]
        items = [sorted(int(x) for x in v) for v in block["items"]]
        model = spark.sparkContext.broadcast((own, windows, length, need, items, n + slop))

        def match(batches, model=model):
            yield from _matcher(*model.value)(batches)

        hits = hits.unionAll(index.select("seg", "base", "terms", "ptr", "pos").mapInArrow(match, _FOUND))
    found = (hits.groupBy("seg", "doc_no").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                               F.flatten(F.collect_list("items")).alias("items"))
             .mapInArrow(_joined, _FOUND))
    rows = index.select("seg", F.posexplode(F.arrays_zip("ids", "text_keys", "n_words")).alias("doc_no", "x")).select(
        "seg", "doc_no", F.col("x.ids").alias("doc"), F.col("x.text_keys").alias("text_key"),
        F.col("x.n_words").cast("long").alias("n_words"))
    n_near = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))
    return (rows.join(found, ["seg", "doc_no"], "left")
            .select("doc", "text_key", "n_words", F.coalesce(n_near, F.lit(0)).alias("n_near"),
                    F.coalesce(F.array_sort(F.transform("items", lambda x: x.cast("string"))),
                               F.array().cast("array<string>")).alias("near_items"),
                    F.coalesce("spans", F.array().cast("array<struct<s: int, e: int>>")).alias("near_spans")))
