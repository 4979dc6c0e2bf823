"""Spelling variant grouping with bidirectional FM-index search schemes.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, lower-cased (A-Z only).
Some runs lose a code point, as the task's rule says (``h`` is the crc32 of
``<id>:<run>``; where ``199`` divides it, the code point ``h % length`` goes).
The vocabulary is the words of at least ``least_chars`` code points and
``least_count`` occurrences.  Counting is exact: words are counted as strings.

Two words are near when one inserted, deleted or replaced code point turns one
into the other.  One of the two halves of the query then stands unchanged in
its neighbour, at the same end.  Every word is therefore indexed under its
possible first and last halves (two lengths each), and asked for under its own
two halves; equal halves meet in one group.  A group's words, each between
delimiters, are one text, indexed in both directions: the FM-index of the text
is read leftwards, that of its reversal rightwards.  A search matches the
delimiter and one half exactly, then goes on across the other half with one
error, narrowing intervals of suffix ranks; at the far delimiter an interval is
one word.  Pairs whose first halves agree are counted by the first search
alone, so every pair counts once.

Groups are hash buckets of halves with about ``block`` words; a half that more
than ``block`` words share is cut into blocks of its own, and its queries go to
each of them, so a task never holds more than a few blocks.  A group hands on
one row per query (number of neighbours, best neighbour), never the pairs.

Defined results: a null or empty text has no words; a null id counts as an
empty one in the rule above; repeated rows count as often as they stand there;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import segments, stage, text_buffers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LEAD = 0xC3  # in UTF-8, U+00C0 to U+00FF are this byte and one more
_INSIDE = np.array([False, True] + [False] * 254)

#: Words a counting task holds before it hands on their counts.
HELD = 2_000_000
#: Error states that one search step may have at once, about.
STATES = 2_000_000


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()
LONG_WORD = 64


def word_crcs(letters: np.ndarray, at: np.ndarray, size: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """crc32 of each word ``letters[at: at + size]`` carried on from ``begin``."""
    out = begin.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")
    long = int((size > LONG_WORD).sum())
    for i in order[:long]:
        out[i] = zlib.crc32(letters[at[i]: at[i] + size[i]].tobytes(), int(begin[i])) ^ 0xFFFFFFFF
    order = order[long:]
    c, pos, left = out[order], at[order], size[order]
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j))  # the words longer than j come first
        c[:n] = _CRC[(c[:n] ^ letters[pos[:n] + j]) & 0xFF] ^ (c[:n] >> np.uint32(8))
    out[order] = c
    return out ^ np.uint32(0xFFFFFFFF)


def _runs(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all runs in a row, each run's place there and its bytes, and its text."""
    inside = _LETTER[raw] | (raw == _LEAD)
    inside[1:] |= raw[:-1] == _LEAD
    start, end, first = tv.word_bounds(inside.view(np.uint8), off, _INSIDE)
    size = end - start
    return _LOWER[raw[inside]], np.cumsum(size) - size, size, np.repeat(np.arange(len(off) - 1), np.diff(first))


def _words_of(raw: np.ndarray, off: np.ndarray, ids: list, least: int, modulus: int) -> tuple[pa.Array, list[str]]:
    """The unchanged words of a segment and, apart, those that lost a code point."""
    letters, at, size, text = _runs(raw, off)
    leads = np.concatenate([[0], np.cumsum(letters == _LEAD)])
    chars = size - (leads[at + size] - leads[at])
    keep = chars >= least
    at, size, text, chars = at[keep], size[keep], text[keep], chars[keep]
    begin = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = word_crcs(letters, at, size, begin[text])
    hit = h % modulus == 0
    changed = []
    for i in np.flatnonzero(hit & (chars > least)):
        w = letters[at[i]: at[i] + size[i]].tobytes().decode()
        cut = int(h[i]) % len(w)
        changed.append(w[:cut] + w[cut + 1:])
    at, size = at[~hit], size[~hit]
    edge = np.zeros(len(letters) + 1, np.int8)
    edge[at], edge[at + size] = 1, 0
    cover = np.zeros(len(letters) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    held = letters[np.cumsum(cover)[:-1] > 0]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(held)), changed


def _counter(least: int, modulus: int):
    def emit(held: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        found = pa.chunked_array(held, pa.large_string()).value_counts()
        found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
        for k in range(0, len(found), 1 << 16):
            part = found.slice(k, 1 << 16)
            yield pa.RecordBatch.from_arrays([pc.cast(part.field("values"), pa.string()), part.field("counts")], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            ids = batch.column("doc").to_pylist()
            for i, j in segments(off):
                words, changed = _words_of(raw[off[i]: off[j]], off[i: j + 1] - off[i], ids[i: j], least, modulus)
                held += [words, pa.array(changed, pa.large_string())]
                size += len(words) + len(changed)
                if size >= HELD:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 6,
               least_count: int = 5, modulus: int = 199) -> DataFrame:
    """``(word, n)`` for the words of the vocabulary."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(_counter(least_chars, modulus), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


class FMIndex:
    """The suffix array of a text of symbols (0: delimiter) and its ranks: the
    interval of a pattern's suffixes is narrowed symbol by symbol to the left."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while True:
            key = rank * (n + 2)
            key[:-step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1 or step >= n:
                break
            step *= 2
        self.n, self.sa = n, order
        self.bwt = text[order - 1]
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.ranks = self.bwt[by_symbol].astype(np.int64) * n + by_symbol
        self.symbols = int(text.max()) + 1

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol.astype(np.int64) * self.n
        return np.searchsorted(self.ranks, base + lo), np.searchsorted(self.ranks, base + hi)

    def choices(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(interval, symbol)`` for the symbols that can come next, delimiter left out."""
        wide = hi - lo > self.symbols
        narrow = np.flatnonzero(~wide)
        size = (hi - lo)[narrow]
        at = np.repeat(lo[narrow] - np.cumsum(size) + size, size) + np.arange(size.sum())
        pair = np.unique(np.repeat(narrow, size) * self.symbols + self.bwt[at])
        state, symbol = pair // self.symbols, pair % self.symbols
        if wide.any():  # too many suffixes to look at one by one: try every symbol
            many = np.flatnonzero(wide)
            s, c = np.repeat(many, self.symbols - 1), np.tile(np.arange(1, self.symbols), len(many))
            a, b = self.extend(c, lo[s], hi[s])
            state, symbol = np.concatenate([state, s[b > a]]), np.concatenate([symbol, c[b > a]])
        real = symbol > 0
        return state[real], symbol[real]


def one_error(index: FMIndex, symbols: np.ndarray, off: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(query, suffix rank)`` for each word that matches a query's first
    ``exact`` symbols and the others with exactly one error.  Queries are
    ``symbols[off[i]: off[i + 1]]`` in reading direction."""
    size = np.diff(off)
    delimiters = int((index.bwt == 0).sum())

    def wanted(q: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """The next symbol of each query; after the last one, the delimiter."""
        inside = pos < size[q]
        return np.where(inside, symbols[np.minimum(off[q] + pos, len(symbols) - 1)], 0)

    q = np.arange(len(size))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), delimiters, np.int64)
    for j in range(int(exact.max(initial=0))):
        on = exact[q] > j
        lo[on], hi[on] = index.extend(wanted(q[on], np.full(on.sum(), j)), lo[on], hi[on])
        alive = hi > lo
        q, lo, hi = q[alive], lo[alive], hi[alive]
    pos = exact[q]
    pool: list[tuple[np.ndarray, ...]] = []
    while len(q):
        state, c = index.choices(lo, hi)
        a, b = index.extend(c, lo[state], hi[state])
        at, who = pos[state], q[state]
        pool.append((who, at, a, b))  # one symbol more
        other = (at < size[who]) & (wanted(who, at) != c)
        pool.append((who[other], at[other] + 1, a[other], b[other]))  # another symbol
        more = pos < size[q]
        q, pos, lo, hi = q[more], pos[more], lo[more], hi[more]
        pool.append((q, pos + 1, lo, hi))  # one symbol less
        lo, hi = index.extend(wanted(q, pos), lo, hi)
        pos = pos + 1
        alive = hi > lo
        q, pos, lo, hi = q[alive], pos[alive], lo[alive], hi[alive]
    if not pool:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, pos, lo, hi = (np.concatenate(x) for x in zip(*pool, strict=True))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(q):
        last = pos == size[q]
        lo, hi = index.extend(wanted(q, pos), lo, hi)
        alive = hi > lo
        done = last & alive
        found.append((q[done], lo[done]))
        on = alive & ~last
        q, pos, lo, hi = q[on], pos[on] + 1, lo[on], hi[on]
    pairs = np.unique(np.stack([np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])]), axis=1)
    return pairs[0], pairs[1]


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row and their offsets."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def near_words(words: list[str], queries: list[str], first_half: bool) -> list[tuple[int, int]]:
    """``(query, word)`` indexes of the near words whose first half (else only
    their last half) is the query's."""
    flat, off = _codes(words)
    alphabet = np.unique(flat)
    delimited = np.zeros(len(flat) + len(words) + 1, np.int64)
    delimited[np.arange(len(flat)) + np.repeat(np.arange(len(words)), np.diff(off)) + 1] = np.searchsorted(alphabet, flat) + 1
    starts = off + np.arange(len(off))  # the places of the delimiters
    index = FMIndex(delimited[::-1] if first_half else delimited)
    unknown = len(alphabet) + 1  # no suffix follows it
    out: list[tuple[int, int]] = []
    asked = [w if first_half else w[::-1] for w in queries]
    halves = [len(w) // 2 if first_half else len(w) - len(w) // 2 for w in asked]
    cost = np.cumsum([(len(w) - h + 1) * 2 * min(index.symbols, len(words)) for w, h in zip(asked, halves, strict=True)])
    i = 0
    while i < len(asked):
        j = max(i + 1, int(np.searchsorted(cost, (cost[i - 1] if i else 0) + STATES)))
        q_flat, q_off = _codes(asked[i: j])
        place = np.minimum(np.searchsorted(alphabet, q_flat), len(alphabet) - 1)
        symbols = np.where(alphabet[place] == q_flat, place + 1, unknown)
        q, row = one_error(index, symbols, q_off, np.array(halves[i: j], np.int64))
        at = index.sa[row]
        word = np.searchsorted(starts, index.n - 1 - at) - 1 if first_half else np.searchsorted(starts, at)
        for a, b in zip((q + i).tolist(), word.tolist(), strict=True):
            h = len(queries[a]) // 2
            if first_half or words[b][:h] != queries[a][:h]:
                out.append((a, b))
        i = j
    return out


def _group_search(table: pa.Table) -> pa.Table:
    """One group: per query and search, the number of near words and the best one."""
    rows = {"word": [], "near": [], "best_n": [], "best": []}
    for side in (0, 1):
        part = table.filter(pc.equal(table["side"], side))
        if not part.num_rows:
            continue
        isq = part["query"].to_numpy(zero_copy_only=False)
        every, n = part["word"].to_pylist(), part["n"].to_numpy()
        held = {w: int(k) for w, k, x in zip(every, n, isq, strict=True) if not x}
        queries = list(dict.fromkeys(w for w, x in zip(every, isq, strict=True) if x))
        if not held or not queries:
            continue
        words = list(held)
        place = {i: p for p, i in enumerate(sorted(range(len(words)), key=lambda i: (-held[words[i]], words[i])))}
        count, best = [0] * len(queries), [len(words)] * len(queries)
        for a, b in near_words(words, queries, side == 0):
            count[a] += 1
            best[a] = min(best[a], place[b])
        order = {p: i for i, p in place.items()}
        for a, c in enumerate(count):
            if c:
                w = words[order[best[a]]]
                for k, v in zip(rows, (queries[a], c, held[w], w), strict=True):
                    rows[k].append(v)
    return pa.table(rows, pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))


def neighbours(vocab: DataFrame, block: int = 20_000) -> DataFrame:
    """``(word, n_near, best_n, best)`` for the words of ``(word, n)`` that have near words."""
    size = F.char_length("word")
    # side 0: first halves (floor), side 1: last halves (ceiling)
    first = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor((size + d) / 2).cast("int")))
    last = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.ceil((size + d) / 2).cast("int")))

    def half(side: int, n):
        return F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), n, F.substring("word", F.lit(1), n) if side == 0
                                                             else F.substring("word", size - n + 1, n)).alias("key"))

    words = vocab.select("word", "n", F.explode(F.concat(F.transform(first, lambda k: half(0, k)),
                                                         F.transform(last, lambda k: half(1, k)))).alias("x"))
    words = words.select("word", "n", "x.*", F.lit(False).alias("query"))
    asked = vocab.select("word", "n", F.explode(F.array(half(0, F.floor(size / 2).cast("int")),
                                                        half(1, F.ceil(size / 2).cast("int")))).alias("x"))
    asked = asked.select("word", "n", "x.*", F.lit(True).alias("query"))
    crowded = (words.groupBy("key").agg(F.count("word").alias("held")).where(F.col("held") > block)
               .select("key", F.ceil(F.col("held") / block).cast("int").alias("blocks")))
    groups = max(1, math.ceil(5 * vocab.count() / block))
    rows = words.unionByName(asked).join(crowded, "key", "left")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", F.explode(
        F.when(F.col("blocks").isNull(), F.array(F.lit(-1)))
        .when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))))
    rows = rows.withColumn("group", F.when(F.col("block") < 0, F.pmod("key", F.lit(groups))).otherwise(F.col("key")))
    found = (rows.select("group", "block", "side", "query", "word", "n").groupBy("group", "block")
             .applyInArrow(_group_search, "word string, near long, best_n long, best string"))
    # the largest count first, then the smallest word
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 5, block: int = 20_000,
                      **words) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the
    vocabulary: the form is the near word with the largest ``n`` if that is at
    least ``ratio`` times the word's own, the root the end of the chain."""
    vocab = stage(vocabulary(docs, id_col, text_col, **words), "spelling-words")
    near = neighbours(vocab, block)
    out = vocab.join(near, "word", "left")
    is_form = F.col("best_n") >= F.col("n") * ratio
    out = stage(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    # every step multiplies n by ratio, so this many doublings reach the end of any chain
    top = vocab.agg(F.max("n")).first()[0] or 1
    hops = max(1, math.ceil(math.log(top, ratio))) if ratio > 1 else 64
    up = out.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("far"))
        up = up.join(nxt, "root", "left").select("word", F.coalesce("far", "root").alias("root"))
    return (out.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
