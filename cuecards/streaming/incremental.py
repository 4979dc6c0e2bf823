"""S10 as Structured Streaming: process line files as they arrive.

The reference resumes a slow line-by-line job by reading its output and
skipping the ids already written.  A file-source stream does the same with
guarantees: the checkpoint records which input files were committed, the file
sink is exactly-once, and a restarted job continues after the last committed
batch.  Only row-level stages (parsing, labels, templates, batched scoring,
rewriting of copies) are streamable; whole-table orders (context, splits) stay batch jobs.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cuecards.operators.rebalance import rewrite_copies
from cuecards.session import checkpoint_dir
from cuecards.sources.files import LINE_OPTIONS, apply_line_rule, line_schema
from cuecards.sources.stages import committed, plan_identity, stage_path


def process_new_files(spark: SparkSession, source: str, out: str, transform: Callable[[DataFrame], DataFrame],
                      labeled: bool = True, name: str = "lines", checkpoint: str | None = None,
                      sep: str = "\t", max_files_per_batch: int | None = None,
                      wait: bool = True, null_tokens=()) -> StreamingQuery:
    """Run ``transform`` over every not-yet-processed line file under ``source``
    and append the result to Parquet at ``out``.

    Uses ``availableNow``: everything present is processed (in batches of at
    most ``max_files_per_batch`` files), then the query stops; the next call
    picks up only new files.  Rows follow ``read_lines``: over-long rows are
    dropped, short rows kept with nulls, ``null_tokens`` read as null.
    """
    reader = (spark.readStream.schema(line_schema(labeled)).option("header", True).option("sep", sep)
              .option("quote", '"').option("escape", '"').options(**LINE_OPTIONS))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    # the batch reader's row rule: over-long rows dropped, short rows kept
    stream = transform(apply_line_rule(reader.csv(source), labeled, null_tokens, sep=sep))
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{name}"
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def _nullable(schema: StructType) -> StructType:
    return StructType.fromJson({**schema.jsonValue(), "fields": [{**f, "nullable": True} for f in schema.jsonValue()["fields"]]})


def rewrite_resumable(rebalanced: DataFrame, fn, root: str | None = None, name: str = "rewrite",
                      identity: str | None = None, rows_per_file: int = 100_000,
                      files_per_batch: int = 64) -> DataFrame:
    """G3 with S10: ``rewrite_copies`` as a job that can fail and go on.

    The rows are written once to a queue of files of at most ``rows_per_file``
    rows; a stream takes ``files_per_batch`` of them at a time, ``fn(pdf) -> pdf``
    rewrites the copies, and the batch is committed as a whole.  If ``fn``, an
    executor or the driver fails, the error is raised; calling this again for the same
    rows goes on behind the last committed batch, also with a mended ``fn``: no row is lost,
    repeated or rewritten twice once its batch was committed.  A finished job's
    rows are read, not made again.  Rows equal in all columns all stay.

    A job belongs to its rows: its folder is named by the analysed plan and the input files
    (see ``materialise``; ``identity`` vouches for rows made on the driver), and
    not by ``fn``.  Returns the rows written; after an error, ``rewritten_rows``
    reads those committed so far.
    """
    spark, schema = rebalanced.sparkSession, _nullable(rebalanced.schema)
    job = rewrite_job(rebalanced, root, name, identity)
    if not committed(spark, f"{job}/queue"):
        (rebalanced.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(f"{job}/queue"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{job}/queue"))
    q = (rewrite_copies(stream, fn).writeStream.format("parquet").option("path", f"{job}/rows")
         .option("checkpointLocation", f"{job}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return rewritten_rows(spark, job, schema)


def rewrite_job(rebalanced: DataFrame, root: str | None = None, name: str = "rewrite", identity: str | None = None) -> str:
    """The folder of the job that rewrites these rows."""
    root = root or f"{checkpoint_dir(rebalanced.sparkSession)}/jobs"
    return stage_path(root, name, {"_query": identity or plan_identity(rebalanced)})


def rewritten_rows(spark: SparkSession, job: str, schema: StructType) -> DataFrame:
    """The rows of the batches that a rewriting job has committed."""
    return spark.read.schema(schema).parquet(f"{job}/rows")
