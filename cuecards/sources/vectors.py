"""Word vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def read_vectors(spark: SparkSession, path: str, dim: int = 300) -> DataFrame:
    """Text vectors: one header line, then ``token f1 ... f<dim>`` per line.

    The header has two fields, so keeping rows with exactly ``dim + 1``
    fields drops it (and any damaged line) without needing line numbers;
    ``damaged_vectors`` returns the lines that are lost by that.
    """
    parts = F.split(F.trim(F.col("value")), " ")
    return (
        spark.read.text(path)
        .select(parts.alias("p"))
        .where(F.size("p") == dim + 1)
        .select(F.get("p", 0).alias("token"),
                F.transform(F.slice("p", 2, dim), lambda x: x.try_cast("float")).alias("vec"))
    )


def damaged_vectors(spark: SparkSession, path: str, dim: int = 300) -> DataFrame:
    """``(line, token, n_fields, bad_values)``: the lines of a vector file that ``read_vectors``
    leaves out for their number of fields, or reads with a null for a value
    that is no number.  A line of two fields, a count and ``dim``, is a header."""
    parts = F.split(F.trim(F.col("value")), " ")
    header = F.trim(F.col("value")).rlike(rf"^[0-9]+ {dim}$") & (F.lit(dim) != 1)
    bad = F.size(F.filter(F.slice("p", 2, dim), lambda x: x.try_cast("float").isNull()))
    return (
        spark.read.text(path).where(~header)
        .select(F.col("value").alias("line"), parts.alias("p"))
        .select("line", F.get("p", 0).alias("token"), F.size("p").alias("n_fields"), bad.alias("bad_values"))
        .where((F.col("n_fields") != dim + 1) | (F.col("bad_values") > 0))
    )


def fallback_vector(token: Column, dim: int, seed: int) -> Column:
    """Uniform [0, 1) vector derived from md5(seed|token|i): reproducible anywhere."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), token, i.cast("string"))), 1, 8), 16, 10)
                   .cast("double") / F.lit(4294967296.0)).cast("float"),
    )


def lookup_vectors(vocab: DataFrame, vectors: DataFrame, dim: int = 300, seed: int = 0) -> DataFrame:
    """``(token, token_id)`` vocabulary -> ``(token, token_id, vec, found)``.

    Tokens are unique in the vocabulary, so the join has no hot key and needs no
    broadcast hint; Spark broadcasts the vocabulary when its measured size
    allows.  Duplicate tokens in the vector file resolve to the greatest vector,
    deterministically.
    """
    hits = (
        vectors.join(vocab.select("token").distinct(), "token", "left_semi")
        .groupBy("token").agg(F.max("vec").alias("vec"))
    )
    return (
        vocab.join(hits, "token", "left")
        .select("token", "token_id",
                F.coalesce(F.col("vec"), fallback_vector(F.col("token"), dim, seed)).alias("vec"),
                F.col("vec").isNotNull().alias("found"))
    )
