"""Delimited-file readers and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuecards.functions.labels import format_scores, parse_scores
from cuecards.sources.order import number_rows, quoted_records

LABELED_FIELDS = ["id", "content", "character", "emotions"]
UNLABELED_FIELDS = ["id", "content", "character"]


def _csv(spark: SparkSession, sep: str):
    # escape='"' makes a doubled quote inside a quoted field one literal quote.
    return (
        spark.read.option("header", True).option("sep", sep).option("quote", '"')
        .option("escape", '"').option("multiLine", False)
    )


def line_schema(labeled: bool = True) -> T.StructType:
    """The line fields plus ``_raw``: the whole text of a row whose field count
    is not the header's, null for the others (see ``apply_line_rule``)."""
    fields = LABELED_FIELDS if labeled else UNLABELED_FIELDS
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields + ["_raw"]])


#: Read options that make Spark keep the text of rows with another field count,
#: whichever columns a query reads.
LINE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw", "columnPruning": "false"}


def field_count(raw: Column, sep: str = "\t") -> Column:
    """Number of fields of a raw row: separators outside quoted fields, plus one."""
    plain = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "q")
    return F.char_length(plain) - F.char_length(F.replace(plain, F.lit(sep), F.lit(""))) + 1


def escape_breaks(text: Column) -> Column:
    """Line breaks (and the backslash) as two characters, so that a row is one line."""
    t = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(t, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_breaks(text: Column) -> Column:
    """The inverse of ``escape_breaks``: a marker takes the escaped backslashes
    out of the way (its own occurrences are doubled first)."""
    t = F.replace(text, F.lit("\x1a"), F.lit("\x1a0"))
    t = F.replace(t, F.lit("\\\\"), F.lit("\x1a1"))
    t = F.replace(F.replace(t, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(F.replace(t, F.lit("\x1a1"), F.lit("\\")), F.lit("\x1a0"), F.lit("\x1a"))


def apply_line_rule(raw: DataFrame, labeled: bool = True, null_tokens=(), skip_bad: bool = True,
                    sep: str = "\t", escaped: bool = False) -> DataFrame:
    """Over-long rows dropped (or flagged ``_too_long``), short rows kept with
    nulls, ``null_tokens`` read as null; works on batch and streaming reads.
    Rows are judged by their field count, so an empty surplus field counts."""
    fields = LABELED_FIELDS if labeled else UNLABELED_FIELDS
    # Spark refuses to read ``_raw`` alone, so the condition also reads the id (no text is shorter than 0)
    too_long = (F.coalesce(field_count(F.col("_raw"), sep) > len(fields), F.lit(False))
                | F.coalesce(F.char_length(fields[0]) < 0, F.lit(False)))
    if skip_bad:
        out = raw.where(~too_long).drop("_raw")
    else:
        out = raw.withColumn("_too_long", too_long).drop("_raw")
    if escaped:
        for f in fields:
            out = out.withColumn(f, unescape_breaks(F.col(f)))
    tokens = list(null_tokens)
    if tokens:
        for f in fields[1:]:
            out = out.withColumn(f, F.when(~F.col(f).isin(tokens), F.col(f)))
    return out


def read_lines(spark: SparkSession, path: str, labeled: bool = True, null_tokens=(),
               skip_bad: bool = True, sep: str = "\t", multi_line: bool = False, escaped: bool = False,
               ordinal: str | None = None) -> DataFrame:
    """Read a line table with header: ``id, content, character[, emotions]``.

    Rows with *more* fields than the header are dropped when ``skip_bad``
    (the reference's reader skips them silently); rows with *fewer* fields are
    kept with nulls.  Rows are judged by their field count, empty fields
    included, and alike under any projection.  ``escaped`` reads files that
    ``write_table(escape=True)`` wrote: line breaks inside fields are spelled
    out there.  ``multi_line`` allows quoted fields with real line breaks; such
    files are split as well (see ``quoted_records``).  ``ordinal`` names a column for the row's place in the files.
    Strings listed in ``null_tokens`` (e.g. ``"NA"``) read as null in every column but ``id``.  With
    ``skip_bad=False`` every row is kept and ``_too_long`` flags the bad ones.
    """
    if multi_line:
        options = {**LINE_OPTIONS, "sep": sep, "quote": '"', "escape": '"'}
        records = quoted_records(spark, path).where(~F.col("first"))
        text = F.regexp_replace("record", r"\r$", "")
        raw = records.where(text != "").select("ordinal", F.from_csv(text, line_schema(labeled).simpleString()[7:-1].replace(":", " "), options).alias("r"))
        raw = raw.select("r.*", *([F.col("ordinal").alias(ordinal)] if ordinal else []))
    else:
        raw = _csv(spark, sep).options(**LINE_OPTIONS).schema(line_schema(labeled)).csv(path)
        if ordinal:
            raw = number_rows(raw, ordinal)
    return apply_line_rule(raw, labeled, null_tokens, skip_bad, sep, escaped)


def _source_name(name_from: str):
    """The input's name: its file name, or the folder that holds it (Spark
    sinks write folders of part files)."""
    if name_from == "dir":
        return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return F.col("_metadata.file_name")


def read_ranked(spark: SparkSession, path: str, name_from: str = "file") -> DataFrame:
    """Ranked-guess CSV files ``key_id, word`` -> ``(file, key_id, words)``.

    ``key_id`` is a quoted 16-digit number: read as text, cast to bigint.  The
    file name identifies each input so files can carry weights.
    """
    schema = "key_id string, word string"
    df = _csv(spark, ",").schema(schema).csv(path)
    return df.select(
        _source_name(name_from).alias("file"),
        F.col("key_id").try_cast("bigint").alias("key_id"),
        F.split(F.trim(F.col("word")), " ").alias("words"),
    )


def read_predictions(spark: SparkSession, path: str, sep: str = "\t", name_from: str = "file") -> DataFrame:
    """Every prediction file under a glob -> long form ``(model, id, scores)``.

    One scan for all files; the file name becomes ``model``.  Rows are keyed
    by id, never by position.
    """
    df = _csv(spark, sep).schema("id string, emotion string").csv(path)
    return df.select(
        _source_name(name_from).alias("model"),
        F.col("id"),
        parse_scores("emotion").alias("scores"),
    )


def write_table(df: DataFrame, path: str, sep: str = "\t", digits: int = 6,
                order_by=None, mode: str = "overwrite", escape: bool = False, partition_by: str | None = None) -> None:
    """Header-ed delimited sink.

    Array columns are written as comma-joined fixed-decimal text (Spark's own
    float text, e.g. ``1.0E-5``, differs from Python's).  ``order_by`` sorts
    only here, at the sink.  ``escape`` spells out line breaks in text columns.
    ``partition_by`` names a column whose values become folders, so that many
    files are written in one pass.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            if isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
                cols.append(format_scores(f.name, digits).alias(f.name))
            else:
                cols.append(F.array_join(F.col(f.name).cast("array<string>"), ",").alias(f.name))
        elif escape and isinstance(f.dataType, T.StringType):
            cols.append(escape_breaks(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    out = df.select(*cols)
    if order_by:
        out = out.orderBy(*order_by)
    writer = out.write.partitionBy(partition_by) if partition_by else out.write
    # Spark trims fields on writing unless told not to
    writer.mode(mode).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("header", True).option("sep", sep).option("quote", '"') \
        .option("escape", '"').csv(path)
