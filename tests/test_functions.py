from pyspark.sql import functions as F

from cuecards.functions import (
    binarize, bucketize, clamp, decode_levels, format_scores, one_hot_levels, parse_labels, parse_line_id,
    quarantine_ids, render_labels, sigmoid, smooth, strip_punctuation,
)
from cuecards.functions.text import make_text


def one(df, col):
    return df.select(col.alias("x")).first()["x"]


def test_parse_line_id(spark):
    df = spark.createDataFrame([("34170_0002_A_12",), ("bad",)], "id string")
    p = parse_line_id(df)
    good, bad = quarantine_ids(p)
    r = good.first()
    assert (r.jb_id, r.cc_id, r.ids, r.id_t) == (34170, 2, 12, "34170_0002_A")
    assert [x.id for x in bad.collect()] == ["bad"]


def test_render_labels(spark):
    df = spark.createDataFrame([([0, 0, 0, 0, 0, 0],), ([1, 0, 0, 0, 0, 3],)], "l array<int>")
    got = [r.x for r in df.select(render_labels("l").alias("x")).collect()]
    assert got == ["无", "有点热爱极度哀伤"]


def test_level_encoding_round_trip(spark):
    df = spark.createDataFrame([([2, 0, 1, 3, 0, 0],)], "l array<int>")
    hot = one(df, one_hot_levels("l"))
    assert hot[:4] == [0, 0, 1, 0] and hot[4:8] == [0, 0, 0, 0]
    assert one(df, decode_levels(one_hot_levels("l"))) == [2, 0, 1, 3, 0, 0]
    blocks = spark.createDataFrame([([1, 0, 0, 0] + [0, 1, 0, 1] + [0] * 16,)], "h array<int>")
    assert one(blocks, decode_levels("h"))[:2] == [0, 3]  # slot 0 means 0; last set slot wins
    bad = spark.createDataFrame([([99],)], "l array<int>")
    assert one(bad, one_hot_levels("l")) is None


def test_clamp_bucket_binarize(spark):
    df = spark.createDataFrame([([-0.1, 3.2, 0.5, 1.5, 2.5, 0.49],)], "s array<double>")
    assert one(df, clamp("s")) == [0.0, 3.0, 0.5, 1.5, 2.5, 0.49]
    assert one(df, bucketize("s")) == [0, 3, 1, 2, 3, 0]
    assert one(df, binarize("s", 0.5)) == [0, 1, 1, 1, 1, 0]
    assert one(df, format_scores(clamp("s"), 2)) == "0.00,3.00,0.50,1.50,2.50,0.49"
    sm = one(df, smooth("s", 0.1, 2))
    assert abs(sm[0] - (-0.1 * 0.9 + 0.05)) < 1e-12
    assert abs(one(df, sigmoid("s"))[2] - 1 / (1 + 2.718281828459045 ** -0.5)) < 1e-12


def test_parse_labels_tolerates_junk(spark):
    df = spark.createDataFrame([("0, 1,x,3",)], "e string")
    assert one(df, parse_labels("e")) == [0, 1, None, 3]


def test_templates_and_punctuation(spark):
    df = spark.createDataFrame([("1_0001_A_1", "1_0001_A", None, "你好，世界！")],
                               "id string, id_t string, character string, content string")
    assert make_text(df, "id_char_content").first().text == "1_0001_A:nan:你好，世界！"
    assert make_text(df, "content_role").first().text == "你好，世界！ 角色: nan"
    assert make_text(df, "described").first().text == "（描述角色：nan ）你好，世界！"
    assert one(df, strip_punctuation("content", "short")) == "你好世界"
    assert one(df, strip_punctuation(F.lit("a: b."), "long")) == "ab"
