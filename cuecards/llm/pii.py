"""Personal data: fixed patterns and information-theoretic sanitisation.

Four base kinds are always reported: ``email``, ``ip``, ``card``, ``phone``
(leftmost, non-overlapping per kind, failing matches dropped).  Around them
stand terms that may reveal them as well: a name beside an address.  How
strongly a term ``t`` reveals an entity ``e`` (a distinct value of a kind) is
estimated from the corpus:

* ``both``: the texts in which ``t`` stands within ``reach`` code points of ``e``,
* ``df(t)``, ``df(e)``: the texts that hold the term, the entity at all,
* ``PMI(e; t) = log2(both * N / (df(t) * df(e)))`` of the ``IC(e) = log2(N / df(e))``
  bits of the entity; what stays unknown is ``IC - PMI = log2(df(t) / both)``.

A term discloses ``e`` when at least ``support`` different texts show the pair
and the PMI is at least ``bits``.  Where it leaves at most ``generalise`` bits
unknown it is generalised to its class (``[Name]``, ``[word]``), at most
``remove`` bits, and it is removed.  Only texts that hold the entity are
touched: a text without personal data keeps every word.

All of it is Spark expressions, no Python runs on the executors.  Regular
expressions use possessive loops, which read digits by the thousand without
recursion.  Positions come from prefix sums over the pieces between matches, in
two levels, so that a text of m matches costs about m ** 1.5 steps.  Texts are
read twice (spans and surroundings; document frequencies of terms) and never
shuffled; equal texts are known by their SHA-256 and count as one surrounding.
Terms are counted map-side before they are shuffled; joins on a pair or on a
text are salted, so that an address in a third of all texts, or a text with
thousands of copies, is spread.

Defined results: a null or empty text has no spans; repeated rows and repeated
or null ids give each row its spans; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuecards.llm.common import free_name, stage
from cuecards.llm.expressions import let, prefix_sums, running_max

KINDS = ["email", "ip", "card", "phone", "term"]

# The base patterns, loops made possessive (what follows a loop never matches inside it).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){15}[0-9]", "phone": "+"}
#: A term: a run of letters and digits that begins with a letter, three code points at least.
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
#: Copies of the smaller side of a join on a key that many rows may share.
SALTS = 16

_SPAN = "struct<kind: string, start: int, end: int>"


def matches(text: Column, pattern: str) -> Column:
    """All matches: ``(value, start, end, before, after)``, the last two being
    the text between this match and its neighbours."""
    def placed(x: Column) -> Column:
        hits, gaps = x["hits"], x["gaps"]
        lengths = F.flatten(F.transform(hits, lambda h, i: F.array(F.char_length(F.get(gaps, i)), F.char_length(h))))
        return let(prefix_sums(lengths), lambda at: F.transform(hits, lambda h, i: F.struct(
            h.alias("value"), F.get(at, 2 * i + 1).alias("start"), F.get(at, 2 * i + 2).alias("end"),
            F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"))))

    return let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                        F.split(text, pattern, -1).alias("gaps")), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def doubled(d: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(values, doubled), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = F.char_length(_digits(value))
    if kind == "phone":
        return digits.between(8, 15)
    return F.when(digits.between(16, 19), _luhn(_digits(value))).otherwise(False)


def _entity(kind: str, value: Column) -> Column:
    same = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(f"{kind}:"), same)


def _surroundings(hit: Column, reach: int) -> Column:
    """``(term, start, end)`` of the whole terms within reach of a match, up to
    the next match of its kind on either side; a token that the reach cuts is
    left out, and so are tokens with an ``@``."""
    left = F.right(hit["before"], F.lit(reach + 1))
    left = F.when(F.char_length(hit["before"]) > reach + 1, F.regexp_replace(left, r"^\S+", "")).otherwise(left)
    right = F.left(hit["after"], F.lit(reach + 1))
    right = F.when(F.char_length(hit["after"]) > reach + 1, F.regexp_replace(right, r"\S+$", "")).otherwise(right)

    def terms(piece: Column, at: Column) -> Column:
        found = matches(piece, rf"\S*@\S*|{TERM}")
        return F.transform(F.filter(found, lambda m: ~m["value"].contains("@")),
                           lambda m: F.struct(F.lower(m["value"]).alias("term"), (at + m["start"]).alias("start"), (at + m["end"]).alias("end")))

    return F.concat(let(left, lambda p: terms(p, hit["start"] - F.char_length(p))), let(right, lambda p: terms(p, hit["end"])))


def _found(text: Column, kind: str, reach: int) -> Column:
    """The valid matches of a kind with their entity and surrounding terms."""
    near = "array<struct<term: string, start: int, end: int>>"
    none = F.array().cast(f"array<struct<kind: string, start: int, end: int, entity: string, near: {near}>>")
    hint = text.rlike(_HINTS[kind]) if kind in ("ip", "card") else text.contains(_HINTS[kind])
    hits = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
    return F.when(hint, F.transform(hits, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        _entity(kind, m["value"]).alias("entity"), _surroundings(m, reach).alias("near")))).otherwise(none)


def _salted(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left`` joined with ``right`` (one row per key), the rows of one key dealt to ``SALTS`` tasks."""
    salt = free_name(left, "salt")
    spread = left.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return spread.join(copies, [*keys, salt], how).drop(salt)


def _spans(found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 60, support: int = 3,
                  bits: float = 4.0, generalise: float = 1.0, remove: float = 0.25) -> DataFrame:
    """Per row ``doc``, ``text_key`` (SHA-256, null without personal data), the
    ``base`` spans by kind and start, and the disclosing ``terms`` by start:
    ``(kind, start, end)`` in code points, end exclusive, terms with their ``action``."""
    text = F.col("text")
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = src.select("doc", "text", *[_found(text, k, reach).alias(k) for k in KINDS[:4]])
    found = found.select("doc", "text", F.concat(*KINDS[:4]).alias("found"))
    held = F.size("found") > 0
    rows = stage(found.select("doc", "found", F.when(held, F.sha2(text, 256)).alias("text_key")), "pii-spans")

    # every surrounding once per different text; df(e) counts rows, as df(t) does
    near = (rows.where("text_key is not null").select("doc", "text_key", F.explode("found").alias("f"))
            .select("text_key", F.col("f.entity").alias("entity"), F.col("f.near").alias("near")))
    copies = rows.where("text_key is not null").groupBy("text_key").agg(F.count("*").alias("rows"))
    pairs = near.select("text_key", "entity", F.explode("near").alias("t")).select("text_key", "entity", "t.*").distinct()
    pairs = stage(pairs, "pii-near")
    shown = pairs.select("text_key", "entity", "term").distinct().join(copies, "text_key")
    shown = (shown.groupBy("entity", "term").agg(F.count("*").alias("texts"), F.sum("rows").alias("both"))
             .where(F.col("texts") >= support))
    entities = near.select("text_key", "entity").distinct().join(copies, "text_key").groupBy("entity").agg(F.sum("rows").alias("df_e"))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0)))
    terms = src.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    total = src.agg(F.count("*").alias("all_rows")).scalar()
    unknown = F.greatest(F.lit(0.0), F.log2(F.col("df_t") / F.col("both")))
    pmi = F.log2(total / F.col("df_e")) - unknown
    telling = (shown.join(terms, "term").join(entities, "entity")
               .where((pmi >= bits) & (unknown <= generalise))
               .select("entity", "term", F.when(unknown <= remove, "remove").otherwise("generalise").alias("action")))
    span = F.struct(F.col("start"), F.col("end"), F.col("action"))
    flagged = (_salted(pairs, telling, ["entity", "term"], "inner").groupBy("text_key", "start", "end")
               .agg(F.max("action").alias("action"))  # remove rather than generalise
               .groupBy("text_key").agg(F.sort_array(F.collect_list(span)).alias("flagged")))
    with_terms = _salted(rows.where("text_key is not null").select("doc", "text_key", _spans(F.col("found")).alias("base")),
                         flagged, ["text_key"], "left")
    none = F.array().cast("array<struct<start: int, end: int, action: string>>")
    plain = rows.where("text_key is null").select("doc", "text_key", _spans(F.col("found")).alias("base"), none.alias("flagged"))
    both = with_terms.unionByName(plain)
    return both.select("doc", "text_key", F.coalesce("base", F.array().cast(f"array<{_SPAN}>")).alias("base"), F.transform(
        F.coalesce("flagged", none), lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"),
                                                        t["end"].alias("end"), t["action"].alias("action"))).alias("terms"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span of ``spans`` ``(start, end, mark)`` replaced by
    its mark; of overlapping spans the first gives the mark for them all."""
    def cut(x: Column) -> Column:
        spans, chars, before = x["spans"], x["chars"], x["before"]

        def piece(a: Column, b: Column) -> Column:
            return F.array_join(F.slice(chars, a + 1, F.greatest(F.lit(0), b - a)), "")

        parts = F.transform(spans, lambda s, i: F.concat(
            piece(F.get(before, i), s["start"]), F.when(s["start"] >= F.get(before, i), s["mark"]).otherwise("")))
        end = F.greatest(F.element_at(before, -1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(parts, ""), piece(end, F.size(chars)))

    def prepared(s: Column) -> Column:
        return let(F.struct(s.alias("spans"), F.split(text, "").alias("chars"),
                            running_max(F.transform(s, lambda m: m["end"])).alias("before")), cut)

    return let(F.sort_array(spans), lambda s: F.when(F.size(s) == 0, text).otherwise(prepared(s)))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the column ``text_col`` sanitised: base spans become their
    kind (``[EMAIL]``), disclosing terms their class (``[Name]`` with a capital,
    else ``[word]``) or nothing.  Rows without personal data are unchanged."""
    found = find_personal(docs, id_col, text_col, **how).where("text_key is not null")
    spans = F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"),
                                               F.concat(F.lit("["), F.upper(b["kind"]), F.lit("]")).alias("mark"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"),
                                                F.when(t["action"] == "remove", "").otherwise("[?]").alias("mark"))))
    # equal texts have equal spans: one row per text is joined, and only texts that may hold a span are shuffled
    marks = found.select("text_key", spans.alias("pii_spans")).dropDuplicates(["text_key"])
    text = F.col(text_col).cast("string")
    hinted = F.lit(False)
    for kind, hint in _HINTS.items():
        hinted = hinted | F.coalesce(text.rlike(hint) if kind in ("ip", "card") else text.contains(hint), F.lit(False))
    names = {c: free_name(docs, f"pii_{c}") for c in ("key", "spans")}
    marks = marks.select(F.col("text_key").alias(names["key"]), F.col("pii_spans").alias(names["spans"]))
    out = _salted(docs.where(hinted).withColumn(names["key"], F.sha2(text, 256)), marks, [names["key"]], "left")
    spans = F.transform(names["spans"], lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.when(s["mark"] == "[?]", F.when(F.substring(text, s["start"] + 1, F.lit(1)).rlike(r"\p{Lu}"), "[Name]").otherwise("[word]"))
        .otherwise(s["mark"]).alias("mark")))
    changed = F.when(F.col(names["spans"]).isNull(), text).otherwise(redact(text, spans))
    out = out.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    return out.unionByName(docs.where(~hinted).withColumn(text_col, text))
