"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuecards.llm.ann import nearest
from cuecards.llm.chat import format_chats, loss_mask, masked_text, read_chats
from cuecards.llm.collocations import collocations
from cuecards.llm.common import table
from cuecards.llm.decontam import decontaminate
from cuecards.llm.htmltext import extract
from cuecards.llm.langid import identify
from cuecards.llm.minhash import near_duplicates
from cuecards.llm.mixing import mix
from cuecards.llm.pii import find_personal
from cuecards.llm.secrets import find_secrets
from cuecards.llm.sharding import shard
from cuecards.llm.spelling import spelling_variants
from cuecards.llm.suffix import remove_repeats


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = read_chats(format_chats(turns)).withColumn("mask", loss_mask(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = masked_text(F.col("formatted"), F.col("mask"))
    return out.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), n_shards=16)
    return out.select(F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "place")


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return out.select(F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def _listed(spans):
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(F.col("doc").alias("doc_id"), count("assign"), count("access"), count("hex"),
                      F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_copies=3)
    return out.select(F.col("doc").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select(F.col("page").alias("page_id"), "url", "text",
                      F.char_length("text").cast("long").alias("n_chars"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_personal(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = F.concat(F.col("base"), F.transform("terms", lambda t: F.struct(t["kind"], t["start"], t["end"])))
    return out.select(F.col("doc").alias("doc_id"), count("email"), count("ip"), count("card"), count("phone"),
                      F.sha2(_listed("base"), 256).alias("base_sha256"), _listed(every).alias("spans"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), support=100, longest=5, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_ann_search": op5_ann_search,
    "op6_decontaminate": op6_decontaminate,
    "op7_mix_sources": op7_mix_sources,
    "op8_html_text": op8_html_text,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_pii": op11_pii,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}

#: The twin works from the turns themselves; only ``formatted_chars`` restates
#: the template (tag lengths, one separator per merged turn, one backslash per
#: control string).
_OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         length(regexp_replace(text, '([\[<])(\\*)(/?SYS\]|/?INST\]|OUT\]|\+\]|/?ROLE[ \]]|/s>)',
                               '\1\2\\\3', 'g')) AS chars FROM turns),
sized AS (
  SELECT *, chars + CASE
    WHEN before = role THEN 5
    WHEN role = 'system' THEN 13 WHEN role = 'user' THEN 15 WHEN role = 'assistant' THEN 11
    ELSE 16 + length(replace(replace(role, '%', '%25'), ']', '%5D')) END AS shown FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(length(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
            ORDER BY turn NULLS FIRST, role, text), '')) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
            ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All shared shingles counted, links closed by a recursive query.
_OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
cut AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM words WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
           GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM both_ways
          UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

#: Every window of every document joined with every window of the items.
_OP6 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_cut AS (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item_words WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS s, least(10, len(w)) AS l FROM item_cut),
lengths AS (SELECT DISTINCT l FROM phrases),
cut AS (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM words, lengths WHERE len(w) >= l),
hits AS (SELECT doc_id, i, cut.l, item_id FROM cut JOIN phrases ON s = array_to_string(w[i:i + cut.l - 1], ' ') AND phrases.l = cut.l),
marked AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + l - 1)) AS pos FROM hits),
n_marked AS (SELECT doc_id, count(*) AS n FROM marked GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_marked.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(found.items, '')) AS items_sha256, coalesce(n_marked.n, 0) > 0 AS contaminated
FROM words LEFT JOIN n_marked USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: Every phrase counted, the longer ones searched for the shorter as strings.
_OP13 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cut AS (SELECT lang, m, w, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM words, (VALUES (1), (2), (3), (4), (5)) lengths(m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS p, count(*) AS n FROM cut GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, m, p, n AS a, string_split(p, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM cand)),
scored AS (SELECT c.lang, c.p, c.a, k, x.n AS l, y.n AS r, t.n AS n,
                  CAST(1000::HUGEINT * c.a * t.n // (x.n::HUGEINT * y.n) AS BIGINT) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = head JOIN f y ON y.lang = c.lang AND y.p = tail
           JOIN total t ON t.lang = c.lang),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS o FROM scored),
kept AS (SELECT * FROM weakest b WHERE o = 1 AND NOT EXISTS (
  SELECT 1 FROM cand q WHERE q.lang = b.lang AND len(q.p) > len(b.p) AND 100 * q.a >= 100 * b.a
                         AND contains(' ' || q.p || ' ', ' ' || b.p || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": _OP1,
    "op6_decontaminate": _OP6,
    "op2_chat_format": _OP2,
    "op13_collocations": _OP13,
}
