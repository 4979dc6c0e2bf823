"""Vocabulary and fixed-length encodings.

Character tables (vocabulary, dictionary) are reduced to one row per single
code point first, so they have at most 1,114,112 rows whatever the input: a
proven bound, and the reason why they may travel with the plan.  A table is one array
with the entry of a code point at its number, a scalar subquery; encoding
a text looks its characters up there and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuecards.constants import CLS_ID, PAD_ID, SEP_ID, VOCAB_SIZE
from cuecards.session import cut_lineage

MAX_CODE_POINTS = 0x110000
UNK = "<UNK>"
PAD = "<PAD>"
# Whitespace removed from both ends of a text before counting characters: what
# Python's str.strip() removes.  Fixed values: code points.
WHITESPACE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000]
_WS_CHARS = "".join(map(chr, WHITESPACE))


def chars(col: str | Column) -> Column:
    """Code points of a text (an astral character is one token).

    ``split`` on the empty pattern is about twice as fast as extracting every
    match of ``(?s).``; it yields one empty token for an empty text, removed.
    """
    c = col if isinstance(col, Column) else F.col(col)
    return F.array_remove(F.split(c, ""), "")


def strip_ws(col: str | Column) -> Column:
    """Remove edge whitespace (a character-set trim, no regex scan)."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.trim(c, F.lit(_WS_CHARS))


def token_counts(df: DataFrame, col: str = "text") -> DataFrame:
    """Character frequencies over whole (edge-stripped) texts; partial counts map-side."""
    return (df.select(F.explode(chars(strip_ws(col))).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def build_vocab(df: DataFrame, col: str = "text", size: int = VOCAB_SIZE, materialize: bool = True) -> DataFrame:
    """A5: ``(token, token_id, n)`` for the ``size`` most frequent characters
    (ties by code point), ids 0.. in that order, then ``<UNK>`` = V and
    ``<PAD>`` = V + 1.  ``orderBy().limit()`` is a per-partition top-k merge;
    the numbering window sees at most ``size`` rows.

    With ``materialize`` the (at most ``size + 2`` row) table is written once
    to the shared checkpoint folder, so encoders that look up special ids and
    broadcast the table do not recount every character of the corpus.
    """
    top = token_counts(df, col).orderBy(F.desc("n"), F.asc("token")).limit(size)
    w = Window.orderBy(F.desc("n"), F.asc("token"))
    ranked = (top.withColumn("token_id", (F.row_number().over(w) - 1).cast("int"))
              .withColumn("_v", F.count(F.lit(1)).over(Window.partitionBy())))
    # The last numbered row also emits <UNK> = V and <PAD> = V + 1, so the
    # specials need no second pass over the corpus.
    if not 0 < size <= MAX_CODE_POINTS:
        raise ValueError(f"size must be between 1 and {MAX_CODE_POINTS}")
    row = F.struct("token", "token_id", "n")
    specials = F.array(
        row,
        F.struct(F.lit(UNK).alias("token"), F.col("_v").cast("int").alias("token_id"), F.lit(0).cast("long").alias("n")),
        F.struct(F.lit(PAD).alias("token"), (F.col("_v") + 1).cast("int").alias("token_id"), F.lit(0).cast("long").alias("n")),
    )
    vocab = ranked.select(F.explode(F.when(F.col("token_id") == F.col("_v") - 1, specials)
                                    .otherwise(F.array(row))).alias("r")).select("r.*")
    return cut_lineage(vocab) if materialize else vocab


def special_ids(vocab: DataFrame) -> tuple[int, int]:
    """``(<UNK>, <PAD>)`` ids: a two-row lookup, the only values fetched to the driver."""
    got = {r["token"]: r["token_id"] for r in vocab.where(F.col("token").isin(UNK, PAD)).select("token", "token_id").collect()}
    return int(got.get(UNK, 0)), int(got.get(PAD, 1))  # an empty corpus has no specials rows


def one_per_code_point(table: DataFrame, value: str) -> DataFrame:
    """``(token, value)`` with one row per single code point (of several, the
    smallest value), so at most ``MAX_CODE_POINTS`` rows."""
    return (table.where(F.char_length("token") == 1).groupBy("token").agg(F.min(value).alias(value)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` evaluated once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def _by_code_point(table: DataFrame, value: str) -> Column:
    """The table as one array, the entry of a code point at its number, null where
    the table has none: a scalar subquery, evaluated once a query.  It has at most
    ``MAX_CODE_POINTS`` entries, and none beyond the table's largest code point."""
    none = F.lit(None).cast(table.schema[value].dataType)

    def dense(entries):  # in order of code points, the gaps filled
        return F.flatten(F.transform(entries, lambda e, i: F.concat(
            F.array_repeat(none, e["at"] - F.when(i > 0, F.get(entries, i - 1)["at"]).otherwise(-1) - 1), F.array(e["value"]))))

    entries = one_per_code_point(table, value).agg(
        F.sort_array(F.collect_list(F.struct(F.ascii("token").alias("at"), F.col(value).alias("value")))).alias("entries"))
    return entries.select(_let(F.col("entries"), dense)).scalar()


def encode_chars(df: DataFrame, vocab: DataFrame, max_len: int, col: str = "text", key: str = "id",
                 pad: bool = True, out: str = "input_ids", unk_id: int | None = None,
                 pad_id: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """E1 (with J3): first ``max_len`` characters -> vocabulary ids, unknown ->
    ``<UNK>``, right-padded with ``<PAD>`` to ``max_len`` when ``pad``.

    The text is not stripped here (only the vocabulary strips), so edge
    whitespace may map to ``<UNK>``.  Rows with empty text keep an all-pad row.
    No row is shuffled: each character is looked up by its code point.
    ``carry`` names columns of ``df`` to pass through, so callers need no join back.
    """
    if unk_id is None or pad_id is None:
        unk_id, pad_id = special_ids(vocab)
    table = _by_code_point(vocab.select("token", "token_id"), "token_id")
    # substring counts code points, so cutting before splitting yields the
    # same first max_len tokens without splitting the rest of a long text.
    cs = chars("_text")
    # the subquery is a column of its own, as none may stand in a lambda's call; Catalyst merges the two selects
    d = df.select(key, *carry, F.substring(col, 1, max_len).alias("_text"), table.alias("_table"))
    ids = F.coalesce(_let(F.col("_table"), lambda t: F.transform(cs, lambda c: F.coalesce(F.get(t, F.ascii(c)), F.lit(unk_id)))),
                     F.array().cast("array<int>"))
    if pad:
        ids = F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(max_len) - F.size(ids)))
    return d.select(key, *carry, ids.alias(out))


def pack_single(df: DataFrame, ids: str = "input_ids", max_len: int = 110, cls: int = CLS_ID,
                sep: int = SEP_ID, pad: int = PAD_ID) -> DataFrame:
    """``[CLS] x [SEP] pad...`` with attention mask and segment ids."""
    body = F.concat(F.array(F.lit(cls)), F.slice(ids, 1, max_len - 2), F.array(F.lit(sep)))
    n = F.size(body)
    return df.select(
        "*",
        F.concat(body, F.array_repeat(F.lit(pad), F.lit(max_len) - n)).alias("packed_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n)).alias("attention_mask"),
        F.array_repeat(F.lit(0), max_len).alias("token_type_ids"),
    )


def pair_lengths(text_len: Column, max_len: int, n_labels: int = 6) -> tuple[Column, Column]:
    """Lengths kept by longest-first pair truncation to ``max_len - 3``
    (pop the longer side, the label side on a tie), in closed form."""
    m = max_len - 3
    a = (F.when(text_len + n_labels <= m, text_len)
         .otherwise(F.greatest(F.least(text_len, F.lit((m + 1) // 2)), F.lit(m - n_labels))))
    a = F.greatest(a, F.lit(0))
    b = F.greatest(F.least(F.lit(n_labels), F.lit(m) - a), F.lit(0))
    return a, b


def pack_pair(df: DataFrame, ids: str = "input_ids", targets: str | None = "labels", max_len: int = 110,
              n_labels: int = 6, cls: int = CLS_ID, sep: int = SEP_ID, pad: int = PAD_ID) -> DataFrame:
    """Text + label-token pair ``[CLS] x [SEP] l1..l6 [SEP] pad``.

    Label tokens have ids 1..6 and segment 1; ``token_label_ids`` marks a label
    position only where its target *equals* 1; doc / label position lists
    partition ``0..max_len-1``.  ``targets=None`` encodes unlabelled rows.
    """
    a, b = pair_lengths(F.size(ids), max_len, n_labels)
    used = a + b + F.lit(3)
    rest = F.lit(max_len) - used
    labels = F.slice(F.sequence(F.lit(1), F.lit(n_labels)), 1, b)
    if targets is None:
        marks = F.array_repeat(F.lit(0), b)
    else:
        marks = F.transform(F.slice(targets, 1, b), lambda t: F.coalesce((t == 1).cast("int"), F.lit(0)))
    empty = F.array().cast("array<int>")
    return df.select(
        "*",
        F.concat(F.array(F.lit(cls)), F.slice(ids, 1, a), F.array(F.lit(sep)), labels, F.array(F.lit(sep)),
                 F.array_repeat(F.lit(pad), rest)).alias("pair_ids"),
        F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), rest)).alias("pair_mask"),
        F.concat(F.array_repeat(F.lit(0), a + 2), F.array_repeat(F.lit(1), b),
                 F.array_repeat(F.lit(0), rest + 1)).alias("pair_segments"),
        F.concat(F.array_repeat(F.lit(0), a + 2), marks, F.array_repeat(F.lit(0), rest + 1)).alias("pair_marks"),
        F.concat(F.sequence(F.lit(0), a + 1), F.sequence(a + b + 2, F.lit(max_len - 1))).alias("doc_positions"),
        F.when(b > 0, F.sequence(a + 2, a + b + 1)).otherwise(empty).alias("label_positions"),
    )


def _hash_int(seed, key: Column, *tags) -> Column:
    parts = [F.lit(str(seed)), key.cast("string")] + [t if isinstance(t, Column) else F.lit(str(t)) for t in tags]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def mask_labels(df: DataFrame, labels: str = "labels", seed: int = 2021, key: str = "id", n: int = 6) -> DataFrame:
    """E5: one positive label (hash-picked) is "given", every other position is
    masked with target 1 if its label is non-zero.  Lists are padded with -1
    to fixed width (the reference padded with a character)."""
    pos = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(labels, i) != 0)
    pick = F.when(F.size(pos) > 0, F.get(pos, _hash_int(seed, F.col(key), "given") % F.size(pos)))
    d = df.withColumn("given_pos", pick.cast("int"))
    masked = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.col("given_pos").isNull() | (i != F.col("given_pos")))
    tgt = F.transform(masked, lambda i: (F.get(labels, i) != 0).cast("int"))
    fill = F.array_repeat(F.lit(-1), F.lit(n) - F.size(masked))
    return d.select("*", F.concat(masked, fill).alias("mask_positions"), F.concat(tgt, fill).alias("mask_targets"))


def label_pairs(df: DataFrame, labels: str = "labels", seed: int = 2021, key: str = "id", n: int = 6) -> DataFrame:
    """Contrastive label pairs per row: every pair of positive labels
    (``same`` = 1) plus ``2 * pairs`` hash-drawn (positive, negative) pairs
    (``same`` = 0), duplicates collapsed.  At most 15 + 30 rows per line."""
    idx = F.sequence(F.lit(0), F.lit(n - 1))
    posl = F.filter(idx, lambda i: F.get(labels, i) == 1)
    negl = F.filter(idx, lambda i: F.get(labels, i) != 1)
    d = df.withColumn("_pos", posl).withColumn("_neg", negl)
    pairs = F.flatten(F.transform("_pos", lambda x, i: F.transform(
        F.slice("_pos", i + 2, n), lambda y: F.struct(x.alias("a"), y.alias("b"), F.lit(1).alias("same")))))
    npairs = (F.size("_pos") * (F.size("_pos") - 1) / 2).cast("int")
    draws = F.when(
        (npairs > 0) & (F.size("_neg") > 0),
        F.transform(F.sequence(F.lit(0), npairs * 2 - 1), lambda t: F.struct(
            F.get("_pos", _hash_int(seed, F.col(key), t, "r") % F.size("_pos")).alias("a"),
            F.get("_neg", _hash_int(seed, F.col(key), t, "w") % F.size("_neg")).alias("b"),
            F.lit(0).alias("same"))),
    ).otherwise(F.array().cast("array<struct<a:int,b:int,same:int>>"))
    return (d.select(key, F.explode(F.array_distinct(F.concat(pairs, draws))).alias("p"))
            .select(key, "p.a", "p.b", "p.same"))


def _of_width(ids: Column, width: int) -> Column:
    cut = F.slice(ids, 1, width)
    return F.concat(cut, F.array_repeat(F.lit(0), F.lit(width) - F.size(cut)))


def _char_lists(table: DataFrame, width: int) -> DataFrame:
    """The table's lists, cut and filled once per token, not once per character."""
    return table.where(F.col("ids").isNotNull()).select("token", _of_width(F.col("ids"), width).alias("ids"))


def char_features(df: DataFrame, table: DataFrame, width: int = 8, col: str = "text", key: str = "id",
                  max_len: int | None = None, out: str = "char_features") -> DataFrame:
    """Per character a fixed-width id list from a ``(token, ids array<int>)``
    dictionary, zero-filled when the character is missing.  A token listed
    twice counts once, with its smallest list; tokens that are not a single
    code point match no character.  No row is shuffled."""
    text = F.col(col) if max_len is None else F.substring(col, 1, max_len)
    lists = _by_code_point(_char_lists(table, width), "ids")
    zeros = F.array(*[F.lit(0)] * width)
    d = df.select(key, text.alias("_text"), lists.alias("_table"))
    features = _let(F.col("_table"), lambda t: F.transform(chars("_text"), lambda c: F.coalesce(F.get(t, F.ascii(c)), zeros)))
    return d.select(key, F.coalesce(features, F.array().cast("array<array<int>>")).alias(out))


def _phrases_in(text: Column, lengths: list[int]) -> Column:
    """The distinct substrings of ``text`` that have one of ``lengths``."""
    def longer(cs, shorter, have, rest):
        """The substrings of each length of ``rest``, each made from the one of ``have`` characters at its place."""
        if not rest:
            return F.array().cast("array<string>")
        n = rest[0]
        made = F.when(F.size(cs) >= n, F.transform(F.sequence(F.lit(0), F.size(cs) - n), lambda i: F.concat(
            F.get(shorter, i), *[F.get(cs, i + j) for j in range(have, n)])))
        made = F.coalesce(made, F.array().cast("array<string>"))
        return _let(made, lambda g: F.concat(g, longer(cs, g, n, rest[1:])))

    long_enough = F.char_length(text) >= min(lengths)
    return F.when(long_enough, F.array_distinct(
        _let(chars(text), lambda cs: longer(cs, cs, 1, lengths))))


def phrase_features(df: DataFrame, phrases: DataFrame, table: DataFrame, width: int = 8, col: str = "text",
                    key: str = "id", max_len: int | None = None, out: str = "char_features") -> DataFrame:
    """J6 with phrases: a character's list depends on the phrase it stands in.

    ``phrases (phrase, ids array<array<int>>)`` has a list for each code point of
    a phrase.  A text is read from the left; at each place the longest phrase that
    starts there gives the lists of its characters and reading goes on behind it.
    Where none starts, the character gets its list of ``table`` as in
    ``char_features``, zeros if it has none.  A phrase listed twice counts once, with its smallest
    lists; phrases of one code point and null lists of a phrase are ignored;
    a phrase with another number of lists than code points is an error.

    The phrase table may be of any size: each text's distinct substrings of
    the table's phrase lengths meet it in a plain join, which broadcasts it if
    its measured size allows and splits where a substring is frequent.  Only keys and phrases
    that were found come back, grouped by key and merged with the texts: they are larger
    than the texts, though Spark estimates them to be small.  Found phrases become one alternation,
    longest first, that cuts the text in one scan (its cost is characters times the text's found phrases).
    """
    text = F.col(col) if max_len is None else F.substring(col, 1, max_len)
    n = F.char_length("phrase")
    known = phrases.where((n > 1) & F.col("ids").isNotNull())
    counts = dict(known.groupBy(n).count().collect())  # at most one row a length
    lengths = sorted(counts)
    if not lengths:
        return char_features(df, table, width, col, key, max_len, out)
    # counted, as Spark's estimate of a table made by explode and distinct is far too small; a character has its
    # UTF-8 bytes and a list of ``width`` numbers, a row its header
    measured = sum(m * (64 + n * (32 + 4 * width)) for n, m in counts.items())
    small = measured <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    lists = F.transform("ids", lambda a: _of_width(F.coalesce(a, F.array().cast("array<int>")), width))
    wrong = F.raise_error(F.concat(F.lit("number of lists differs from the length of phrase: "), F.col("phrase")))
    known = (known.select("phrase", F.when(F.size("ids") != n, wrong).otherwise(lists).alias("_lists"))
             .groupBy("phrase").agg(F.min("_lists").alias("_lists")))
    # by key first: where the phrases are broadcast, nothing else is shuffled.  A number keeps AQE from
    # merging the tasks by the bytes of texts, which their substrings exceed many times.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.col(key), text.alias("_text")).repartition(tasks, key)
    grams = texts.select(
        F.col(key).alias("_phrase_key"), F.explode(_phrases_in(F.col("_text"), lengths)).alias("phrase"))
    found = (grams.join(known.hint("broadcast" if small else "merge"), "phrase").groupBy("_phrase_key")
             .agg(F.map_from_entries(F.collect_set(F.struct("phrase", "_lists"))).alias("_phrases")))
    g = texts.join(found.hint("merge"), F.col(key).eqNullSafe(F.col("_phrase_key")), "left")
    g = g.select("*", _by_code_point(_char_lists(table, width), "ids").alias("_table"))
    longest_first = F.sort_array(F.transform(F.map_keys("_phrases"), lambda p: F.struct(
        F.char_length(p), F.regexp_replace(p, r"([\\^$.|?*+()\[\]{}])", r"\\$1").alias("re"))), asc=False)
    pattern = F.concat(F.array_join(F.transform(longest_first, lambda s: s["re"]), "|"), F.lit("|(?s:.)"))
    pieces = F.when(F.col("_phrases").isNull(), chars("_text")).otherwise(
        F.regexp_extract_all("_text", pattern, F.lit(0)))
    zeros = F.array(*[F.lit(0)] * width)
    features = _let(F.col("_table"), lambda t: F.flatten(F.transform(pieces, lambda p: F.when(
        F.char_length(p) > 1, F.col("_phrases")[p]).otherwise(F.array(F.coalesce(F.get(t, F.ascii(p)), zeros))))))
    return g.select(key, F.coalesce(features, F.array().cast("array<array<int>>")).alias(out))
