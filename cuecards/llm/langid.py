"""Language identification with interpolated Kneser-Ney character models.

Learning: every labelled training text is normalised (letters and marks
lower-cased, any other run of characters one space) and cut into character
``ORDER``-grams; tasks count them, Spark sums the counts per language.  The
counts of lower orders are continuation counts, so they follow from the
top-order table, which grows with the corpus.  Each language's interpolated
Kneser-Ney probabilities are stored in hash arrays, one sorted by the mixed
64-bit key per order, shared by all languages (a column for each).

Prediction: the language with the lowest cross-entropy per character, ties to
the smaller name.  ``score`` is the posterior of that choice, from the
cross-entropies sharpened by ``sharpness``.  Rejection is calibrated per
language on all training texts: both the mean cross-entropy and its variance
are fitted as linear functions of 1 / length (short texts vary more).  A text is
rejected if it holds no letter, or if its cross-entropy both lies more than
``reject_sd`` standard deviations above the mean of its length in the chosen
language and is above what that model gives the training texts of other
languages on average.  Texts that mix known languages pass.

``max_cells`` bounds the model (grams times languages) that is held at once.  A
larger one is divided by language and, within a language, by the grams' last
character but one, on which all contexts of a part's grams agree; discounts, the
alphabet and the lowest order, which cross parts, are counted in Spark.  Each
part scores all texts in a pass of its own and the partial log-probabilities
are added up, so the bound changes the cost, not the results.  (One language's
grams around one character are never divided, whatever ``max_cells``.)

Defined results: null and empty texts and texts without letters are ``und``
with score 0 and rejected; without any training text every text is ``und``;
rows without id count as the empty id; repeated rows each count and get the
same result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import segments, stage, text_buffers

U = np.uint64
ORDER = 4
SPACE = 32
_SEGMENT = 2 << 20
_lut: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its 16-bit unit after lower-casing (space for
    anything but letters and marks; beyond the basic plane folded into the
    private area), and whether it is a letter."""
    if not _lut:
        unit = np.full(0x110000, SPACE, np.uint16)
        letter = np.zeros(0x110000, bool)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LM":
                low = chr(c).lower()
                x = ord(low) if len(low) == 1 else c
                unit[c] = x if x < 0x10000 else 0xE000 + x % 0x1900
                letter[c] = kind == "L"
        _lut.extend([unit, letter])
    return _lut[0], _lut[1]


def normalise(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The units of all texts, each led by ``ORDER - 1`` spaces and ended by
    one; where each text begins; whether it holds a letter."""
    unit, letter = _tables()
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]  # code point offsets
    has = np.concatenate([[0], np.cumsum(letter[points])])
    has = has[at[1:]] > has[at[:-1]]
    units = unit[points]
    blank = units == SPACE
    drop = blank.copy()
    drop[1:] &= blank[:-1]
    edge = at[:-1][at[:-1] < len(units)]
    drop[:1] = blank[:1]
    drop[edge] = blank[edge]  # leading blanks go: the padding stands for them
    keep = ~drop
    size = np.concatenate([[0], np.cumsum(keep)])[at]
    n = len(off) - 1
    out = np.full(size[-1] + ORDER * n, SPACE, np.uint16)
    owner = np.repeat(np.arange(n), np.diff(size))
    out[np.arange(size[-1]) + ORDER * owner + ORDER - 1] = units[keep]
    return out, size + ORDER * np.arange(n + 1), has


def grams(units: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ``ORDER``-grams of all texts, and the text of each; none spans two."""
    wide = units.astype(U)
    n = len(units) - ORDER + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    key = np.zeros(n, U)
    for i in range(ORDER):
        key = (key << U(16)) | wide[i: i + n]
    length = np.diff(begin)
    count = np.maximum(0, length - ORDER + 1)
    owner = np.repeat(np.arange(len(length)), count)
    first = np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return key[np.arange(count.sum()) + first], owner


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    uniq, inverse = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(inverse, weights=counts, minlength=len(uniq)).astype(np.int64)


def _counter(most: int = 1 << 20):
    """``mapInArrow``: a task's gram counts per language, merged as they come
    and passed on when a language's table exceeds ``most`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(lang):
            keys, counts = zip(*held[lang], strict=True)
            return _sum(np.concatenate(keys), np.concatenate(counts))

        def batch_of(lang, table):
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(table[0])), pa.array(table[0].view(np.int64)), pa.array(table[1])],
                ["lang", "gram", "n"])

        for batch in batches:
            raw_all, off_all = text_buffers(batch.column("text"))
            labels = np.array(batch.column("lang").to_pylist(), object)
            for i, j in segments(off_all, _SEGMENT):
                units, begin, has = normalise(raw_all[off_all[i]: off_all[j]], off_all[i: j + 1] - off_all[i])
                keys, owner = grams(units, begin)
                names = labels[i:j]
                for lang in set(names[has]):
                    mine = (names == lang) & has
                    part = np.unique(keys[mine[owner]], return_counts=True)
                    held.setdefault(lang, []).append(part)
                    if sum(len(k) for k, _ in held[lang]) > most:
                        table = merged(lang)
                        if len(table[0]) > most // 2:
                            yield batch_of(lang, table)
                            del held[lang]
                        else:
                            held[lang] = [table]
        for lang in list(held):
            yield batch_of(lang, merged(lang))
    return run


def gram_counts(train: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``train (text, lang)``."""
    return (train.where("text is not null and lang is not null").select("text", "lang")
            .mapInArrow(_counter(), "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class HashTable:
    """Sorted mixed keys with an index over their leading bits; row lookups."""

    def __init__(self, keys: np.ndarray):
        mixed = tv.mix(keys)
        self.order = np.argsort(mixed)
        self.keys = np.append(mixed[self.order], U(0xFFFFFFFFFFFFFFFF))
        self.bits = max(1, int(np.ceil(np.log2(max(2, len(keys))))))
        cuts = np.arange(1 << self.bits, dtype=U) << U(64 - self.bits)
        self.index = np.searchsorted(self.keys[:-1], cuts).astype(np.int64)
        self.steps = int(np.bincount((mixed >> U(64 - self.bits)).astype(np.int64)).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        want = tv.mix(keys)
        at = self.index[(want >> U(64 - self.bits)).astype(np.int64)]
        low = np.flatnonzero(self.keys[at] < want)
        for _ in range(self.steps):
            if not len(low):
                break
            at[low] += 1
            low = low[(self.keys[at[low]] < want[low]) & (at[low] < len(self.keys) - 1)]
        at[(self.keys[at] != want) | (at >= len(self.keys) - 1)] = -1
        return at


class Whole(NamedTuple):
    """What a model of some of the grams takes from all of them."""

    size: int  # of the alphabet
    discount: np.ndarray  # (order, language)
    first: tuple[np.ndarray, np.ndarray, np.ndarray]  # language, character, continuation count


class Part(NamedTuple):
    """Some languages' grams, by their last character but one: ``low <= it < high``."""

    langs: list[int]
    low: int = 0
    high: int = 1 << 16


def _discount(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """From how many grams count one and two, per language."""
    return np.where(one + two > 0, one / np.maximum(1, one + 2 * two), 0.5).clip(0.1, 0.9)


class Model:
    """Interpolated Kneser-Ney log-probabilities of all languages."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, whole: Whole | None = None):
        self.langs = langs
        k = len(langs)
        level = [(lang, gram.astype(U), n.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            # continuation counts: how many different characters stand before the shorter gram
            l, g, _ = level[0]
            pair = np.stack([l.astype(U), g & U((1 << (16 * order)) - 1)], axis=1)
            uniq, count = np.unique(pair, axis=0, return_counts=True)
            level.insert(0, (uniq[:, 0].astype(np.int64), uniq[:, 1], count.astype(np.float64)))
        if whole:
            level[0] = whole.first
        self.size = whole.size if whole else _alphabet(level[0][1])
        self.tables: list[tuple[HashTable, np.ndarray]] = []
        self.contexts: list[tuple[HashTable, np.ndarray]] = []
        for order, (l, g, c) in enumerate(level, 1):
            ctx = g >> U(16)
            ctx_keys, ctx_at = np.unique(ctx, return_inverse=True)
            total, kinds = np.zeros((len(ctx_keys), k)), np.zeros((len(ctx_keys), k))
            np.add.at(total, (ctx_at, l), c)
            np.add.at(kinds, (ctx_at, l), 1)
            discount = whole.discount[order - 1] if whole else _discount(
                np.bincount(l[c == 1], minlength=k), np.bincount(l[c == 2], minlength=k))
            back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            keys = np.unique(g)
            row, own = np.searchsorted(keys, g), np.searchsorted(ctx_keys, keys >> U(16))
            lower = np.exp(self.log_prob(keys & U((1 << (16 * (order - 1))) - 1), order - 1))
            prob = back[own] * lower
            prob[row, l] += np.maximum(c - discount[l], 0) / total[ctx_at, l]
            table, ctx_table = HashTable(keys), HashTable(ctx_keys)
            self.tables.append((table, np.log(prob).astype(np.float32)[table.order]))
            self.contexts.append((ctx_table, np.log(back).astype(np.float32)[ctx_table.order]))

    def log_prob(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log-probability of the last character of each gram, per language."""
        if order == 0:
            return np.full((len(keys), len(self.langs)), -np.log(self.size), np.float32)
        table, values = self.tables[order - 1]
        at = table.find(keys)
        if not len(values):
            return self.log_prob(keys, 0)
        out = values[at]
        gone = np.flatnonzero(at < 0)
        if len(gone):
            ctx, back = self.contexts[order - 1]
            c = ctx.find(keys[gone] >> U(16))
            weight = np.where((c >= 0)[:, None], back[c], 0)
            out[gone] = weight + self.log_prob(keys[gone] & U((1 << (16 * (order - 1))) - 1), order - 1)
        return out


def _alphabet(chars: np.ndarray) -> int:
    return max(2, len(np.unique(chars)) + 1)


def _numbers(langs: list[str], column: pa.ChunkedArray) -> np.ndarray:
    return np.searchsorted(np.array(langs, object), np.array(column.to_pylist(), object)).astype(np.int64)


def _divide(counts: DataFrame, langs: list[str], max_cells: int) -> list[Part]:
    """Parts that each hold at most ``max_cells`` cells, and all grams together."""
    totals = dict(counts.groupBy("lang").count().collect())
    if sum(totals.values()) * len(langs) <= max_cells:
        return [Part(list(range(len(langs))))]
    parts, group, held = [], [], 0
    for i, lang in enumerate(langs):
        if totals[lang] <= max_cells:
            if group and (held + totals[lang]) * (len(group) + 1) > max_cells:
                parts.append(Part(group))
                group, held = [], 0
            group, held = [*group, i], held + totals[lang]
            continue
        unit = F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF)
        low = rows = 0
        for r in counts.where(F.col("lang") == lang).groupBy(unit.alias("unit")).count().orderBy("unit").collect():
            if rows and rows + r["count"] > max_cells:
                parts.append(Part([i], low, r["unit"]))
                low, rows = r["unit"], 0
            rows += r["count"]
        parts.append(Part([i], low))
    return [*parts, Part(group)] if group else parts


def _whole(counts: DataFrame, langs: list[str]) -> Whole:
    """Discounts, alphabet and lowest order over all grams."""
    level, discount = counts, np.zeros((ORDER, len(langs)))
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            shorter = F.col("gram").bitwiseAND((1 << (16 * order)) - 1)
            level = stage(level.groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "gram-level")
        got = level.groupBy("lang").agg(*[F.count(F.when(F.col("n") == x, 1)) for x in (1, 2)]).collect()
        few = {lang: (one, two) for lang, one, two in got}
        discount[order - 1] = _discount(*np.array([few[x] for x in langs]).T)
    first = level.toArrow()  # at most 65,536 rows a language
    chars = first.column("gram").to_numpy().view(U)
    return Whole(_alphabet(chars), discount,
                 (_numbers(langs, first.column("lang")), chars, first.column("n").to_numpy().astype(np.float64)))


def _part_model(counts: DataFrame, langs: list[str], part: Part, whole: Whole | None) -> Model:
    if whole:
        unit = F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF)
        counts = counts.where(F.col("lang").isin([langs[i] for i in part.langs]) & (unit >= part.low) & (unit < part.high))
        mine = np.isin(whole.first[0], part.langs)
        number, chars, n = (x[mine] for x in whole.first)
        whole = Whole(whole.size, whole.discount[:, part.langs], (np.searchsorted(part.langs, number), chars, n))
    names = [langs[i] for i in part.langs]
    got = counts.toArrow()
    return Model(names, _numbers(names, got.column("lang")), got.column("gram").to_numpy().view(U),
                 got.column("n").to_numpy(), whole)


def _log_sums(raw, off, model: Model | None, part: Part, k: int):
    """Each text's log-probability by language over the part's grams, its number
    of grams in all, and whether it holds a letter."""
    n = len(off) - 1
    units, begin, has = normalise(raw, off)
    if model is None:
        return np.zeros((n, 0)), np.zeros(n, np.int64), has
    keys, owner = grams(units, begin)
    length = np.bincount(owner, minlength=n)
    if part.high - part.low < 1 << 16:
        unit = (keys >> U(16)) & U(0xFFFF)
        mine = (unit >= U(part.low)) & (unit < U(part.high))
        keys, owner = keys[mine], owner[mine]
    logs = model.log_prob(keys, ORDER)
    sums = np.zeros((n, k))
    for j, i in enumerate(part.langs):
        sums[:, i] = np.bincount(owner, weights=logs[:, j], minlength=n)
    return sums, length, has


def _choose(sums: np.ndarray, length: np.ndarray, has: np.ndarray, langs: list[str], sharpness: float):
    """Columns ``lang_pred, score, cross, length``."""
    n = len(length)
    cross = -sums / np.maximum(length, 1)[:, None]
    if not langs:
        best, post, length = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    else:
        best = cross.argmin(axis=1)
        low = cross[np.arange(n), best]
        post = 1 / np.exp(-sharpness * (cross - low[:, None])).sum(axis=1)
        best, post = np.where(has, best, -1), np.where(has, post, 0.0)
    names = np.array([*langs, "und"], object)
    return [pa.array(names[best], pa.string()), pa.array(post, pa.float64()),
            pa.array(list(cross), pa.list_(pa.float64())), pa.array(length, pa.int64())]


_SCORED = "lang_pred string, score double, cross array<double>, length long"


def score_texts(docs: DataFrame, counts: DataFrame, keys: list[str], max_cells: int,
                sharpness: float = 20.0) -> tuple[list[str], DataFrame]:
    """The languages, and ``keys`` and ``lang_pred, score, cross, length`` of
    each row's ``text``; ``cross`` holds the cross-entropies of all languages in
    name order.  ``keys`` begin with ``doc, text_key``."""
    spark = docs.sparkSession
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    parts = _divide(counts, langs, max_cells) if langs else [Part([])]
    whole = _whole(counts, langs) if len(parts) > 1 else None
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", "
    names = [*keys, "lang_pred", "score", "cross", "length"]

    def sums_of(shared, part):
        def run(batch):
            raw, off = text_buffers(batch.column("text"))
            found = [_log_sums(raw[off[i]: off[j]], off[i: j + 1] - off[i], shared.value, part, len(langs))
                     for i, j in segments(off, _SEGMENT >> 2)]
            return [np.concatenate(x) for x in zip(*found, strict=True)]
        return run

    if len(parts) == 1:
        sums = sums_of(spark.sparkContext.broadcast(_part_model(counts, langs, parts[0], None) if langs else None), parts[0])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k) for k in keys), *_choose(*sums(batch), langs, sharpness)], names)

        return langs, docs.mapInArrow(run, schema + _SCORED)

    found = None
    for p, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(_part_model(counts, langs, part, whole))

        def add(batches: Iterator[pa.RecordBatch], sums=sums_of(shared, part), p=p) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    total, length, has = sums(batch)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc"), batch.column("text_key"), pa.array(np.full(len(has), p, np.int32)),
                         pa.array(list(total), pa.list_(pa.float64())), pa.array(length, pa.int64()), pa.array(has)],
                        ["doc", "text_key", "part", "sums", "length", "has"])

        mine = stage(docs.select("doc", "text_key", "text").mapInArrow(
            add, "doc long, text_key long, part int, sums array<double>, length long, has boolean"), "langid-part")
        shared.destroy()
        found = mine if found is None else found.unionAll(mine)
    zero = F.array_repeat(F.lit(0.0), len(langs))
    added = found.dropDuplicates(["doc", "text_key", "part"]).groupBy("doc", "text_key").agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("part", "sums"))), zero,
                    lambda acc, x: F.zip_with(acc, x["sums"], lambda a, b: a + b)).alias("sums"),
        F.first("length").alias("length"), F.first("has").alias("has"))
    added = added.withColumnsRenamed({"doc": "sum_doc", "text_key": "sum_key"})
    rows = docs.select(*keys).join(added, F.col("doc").eqNullSafe(F.col("sum_doc")) & (F.col("text_key") == F.col("sum_key")))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in keys), *_choose(
                        total, batch.column("length").to_numpy(), batch.column("has").to_numpy(zero_copy_only=False), langs, sharpness)],
                    names)

    return langs, rows.select(*keys, "sums", "length", "has").mapInArrow(choose, schema + _SCORED)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             reject_sd: float = 8.0, max_cells: int = 24_000_000) -> DataFrame:
    """Per row: ``doc, text_key`` (hash of the text), ``held_out, lang_pred,
    score, cross_entropy, rejected``."""
    src = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
        (F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))) % 3 == 1).alias("held_out"))
    counts = stage(gram_counts(src.where("not held_out")), "gram-counts")
    langs, scores = score_texts(src, counts, ["doc", "text_key", "held_out", "lang"], max_cells)
    scores = stage(scores, "langid-scores")
    scores = scores.withColumn("cross_entropy", F.array_min("cross"))
    short = 1 / F.col("length")
    # passes over the narrow score table: the mean by length, the variance around it, the foreign level
    train = scores.where("not held_out and lang is not null and length > 0")
    fit = train.where("lang = lang_pred")
    mean = fit.groupBy("lang_pred").agg(
        F.coalesce(F.regr_slope("cross_entropy", short), F.lit(0.0)).alias("m1"),
        F.avg("cross_entropy").alias("own"), F.avg(short).alias("avg_short"))
    mean = mean.select("lang_pred", "m1", "own", (F.col("own") - F.col("m1") * F.col("avg_short")).alias("m0"))
    over = F.col("cross_entropy") - F.col("m0") - F.col("m1") * short
    var = (fit.join(F.broadcast(mean), "lang_pred").withColumn("sq", over * over).groupBy("lang_pred").agg(
        F.greatest(F.coalesce(F.regr_slope("sq", short), F.lit(0.0)), F.lit(0.0)).alias("v1"),
        F.avg("sq").alias("v"), F.avg(short).alias("avg_short")))
    var = var.select("lang_pred", "v1", F.greatest(F.col("v") - F.col("v1") * F.col("avg_short"),
                                                   0.05 * F.col("v")).alias("v0"))
    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    foreign = (train.select("lang", F.explode(F.arrays_zip(names.alias("name"), F.col("cross"))).alias("x"))
               .where("lang <> x.name").groupBy(F.col("x.name").alias("lang_pred"))
               .agg(F.avg("x.cross").alias("foreign")))
    # one row per language of the model, whose size is bounded
    level = F.broadcast(stage(mean.join(var, "lang_pred").join(foreign, "lang_pred", "left"), "langid-levels"))
    odd = ((over > reject_sd * F.sqrt(F.col("v0") + F.col("v1") * short) + 1e-9)
           & (F.col("cross_entropy") > F.coalesce("foreign", "own")))
    return (scores.join(level, "lang_pred", "left")
            .select("doc", "text_key", "held_out", "lang_pred", "score", "cross_entropy",
                    F.when(F.col("lang_pred") == "und", True).otherwise(F.coalesce(odd, F.lit(False))).alias("rejected")))
