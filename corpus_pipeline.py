"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``docs``.  Every stage judges all the rows it is given; decisions
are joined back null-safely on the id and a hash of the text, so rows without an
id, and rows that repeat an id, are judged like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuecards.llm.common import free_name, stage, table
from cuecards.llm.decontam import decontaminate
from cuecards.llm.langid import identify
from cuecards.llm.minhash import near_duplicates
from cuecards.llm.mixing import mix
from cuecards.llm.sharding import shard


def _text_key() -> F.Column:
    return F.xxhash64(F.col("text").cast("string"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not among ``gone (doc, text_key)``."""
    d, t = free_name(docs, "gone_doc"), free_name(docs, "gone_text")
    gone = gone.select(F.col("doc").alias(d), F.col("text_key").alias(t))
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (_text_key() == F.col(t)), "left_anti")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the language models reject go."""
    found = identify(docs)
    return _without(docs, found.where("rejected").select("doc", "text_key").distinct())


def _nodes(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a node id: the document's own id, so that small ids lead
    their groups.  All but one text of an id that several texts share get an id
    above 2**62 made from the id and the text, rows without an id one above those."""
    tk = F.coalesce(_text_key(), F.lit(0))
    doc = F.col("doc_id").cast("long")
    made = F.shiftrightunsigned(F.xxhash64(doc.isNull(), doc, F.col("text").cast("string")), 3)
    made = made + F.when(doc.isNull(), F.lit(3 << 61)).otherwise(F.lit(1 << 62))
    o, t = free_name(docs, "shared_id"), free_name(docs, "shared_text")
    shared = (docs.where("doc_id is not null").groupBy(doc.alias(o)).agg(F.min(tk).alias(t), F.max(tk).alias("last"))
              .where(F.col(t) < F.col("last")).select(o, t))
    shared = stage(shared, "pipeline-shared")
    if shared.isEmpty():
        return docs.withColumn(name, F.coalesce(doc, made))
    out = docs.join(shared, doc == F.col(o), "left")
    return out.withColumn(name, F.when(doc.isNull() | (tk != F.col(t)), made).otherwise(doc)).drop(o, t)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the
    smallest id (see ``_nodes``), rows without id last.  A node is an id with a text, so rows
    that share an id but hold different texts are judged apart, and rows without
    an id like any other; of rows equal in both one stays.  Documents without
    words are linked with nothing and stay."""
    k = free_name(docs, "near_node")
    keyed = _nodes(docs, k)
    found = stage(near_duplicates(keyed, id_col=k).select(F.col("doc").alias(k), "n_shingles", "kept"), "pipeline-groups")
    out = keyed.join(found.where("kept").select(k).distinct(), k, "left_semi")
    again = found.where("n_shingles > 0").groupBy(k).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(k)
    if not again.isEmpty():  # rows equal in id and text
        out = out.join(again, k, "left_anti").unionByName(out.join(again, k, "left_semi").dropDuplicates([k]))
    return out.drop(k)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated").select("doc", "text_key").distinct())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it; documents that
    it does not take go."""
    d, t, s, n = (free_name(docs, x) for x in ("mix_doc", "mix_text", "mix_source", "mix_copies"))
    copies = (mix(docs).where("copies > 0").select(
        F.col("doc").alias(d), F.col("text_key").alias(t), F.col("source").alias(s), F.col("copies").alias(n)).distinct())
    taken = docs.join(copies, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (_text_key() == F.col(t))
                      & F.col("source").cast("string").eqNullSafe(F.col(s)))
    return (taken.withColumn(n, F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return shard(docs, n_shards=16).select(F.col("doc").alias("doc_id"), "size", "text_crc32", "place", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("minhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("hilbert_shards", assign_shards),
]

#: Model fitting, dependent rounding and the curve have no SQL form: tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
