"""Incremental (streaming) runs of the row-level stages."""

from cuecards.streaming.incremental import (  # noqa: F401
    process_new_files, rewrite_job, rewrite_resumable, rewritten_rows)
