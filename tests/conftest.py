import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = (
        SparkSession.builder.master("local[4]").appName("cuecards-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from cuecards.session import checkpoint_dir

    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", ckpt)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def lines_df(spark):
    """A tiny hand-made line table: three scripts, the middle one two lines."""
    rows = [
        ("100_0001_A_1", "first line is long enough", "a", "0,0,0,0,0,0"),
        ("100_0001_A_2", "hi", "b", "1,0,0,0,0,3"),
        ("100_0002_A_3", "ok", None, None),
        ("101_0001_A_1", "x", "c", "0,2,0,0,0,0"),
        ("101_0001_A_2", "y", "d", "0,0,0,0,0,0"),
        ("102_0001_A_1", "z", "e", "0,0,3,0,0,0"),
        ("102_0001_A_2", "exactly10!", "e", "0,0,0,1,0,0"),
    ]
    return spark.createDataFrame(rows, "id string, content string, character string, emotions string")
