"""cuecards: Spark-native operators for labelling dialogue and screenplay lines.

Every public operator takes and returns Spark DataFrames (or Columns for the
scalar helpers in ``cuecards.functions``).  Nothing is collected to the
driver; random choices are hash orders so results are identical on any
cluster layout and after task retries.
"""

from cuecards.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
