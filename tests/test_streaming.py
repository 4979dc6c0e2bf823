import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cuecards.functions import parse_line_id
from cuecards.functions.text import make_text
from cuecards.streaming import process_new_files, rewrite_job, rewrite_resumable, rewritten_rows


def prep(df):
    return make_text(parse_line_id(df), "id_char_content")


def test_resume_processes_each_file_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    header = "id\tcontent\tcharacter\temotions\n"
    (src / "a.tsv").write_text(header + "1_0001_A_1\thello\tx\t0,0,0,0,0,0\n", encoding="utf-8")
    process_new_files(spark, str(src), str(out), prep, checkpoint=str(ck))
    assert spark.read.parquet(str(out)).count() == 1
    (src / "b.tsv").write_text(header + "1_0001_A_2\tagain\ty\t1,0,0,0,0,0\n1_0002_A_3\tmore\tz\t0,0,0,0,0,0\n",
                               encoding="utf-8")
    process_new_files(spark, str(src), str(out), prep, checkpoint=str(ck))
    got = spark.read.parquet(str(out))
    assert got.count() == 3 and got.select("id").distinct().count() == 3
    assert got.where(F.col("id") == "1_0002_A_3").first().text == "1_0002_A:z:more"


def test_stream_keeps_short_rows_and_drops_long_ones(spark, tmp_path):
    # same row rule as the batch reader: fewer fields -> nulls, more -> dropped
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    body = ("id\tcontent\tcharacter\temotions\n"
            "1_0001_A_1\tfull\tx\t0,0,0,0,0,0\n"
            "1_0001_A_2\tshort\ty\n"
            "1_0001_A_3\tlong\tz\t0,0,0,0,0,0\tspill\n")
    (src / "a.tsv").write_text(body, encoding="utf-8")
    process_new_files(spark, str(src), str(out), lambda d: d, checkpoint=str(ck))
    got = {r.id: r.emotions for r in spark.read.parquet(str(out)).collect()}
    assert got == {"1_0001_A_1": "0,0,0,0,0,0", "1_0001_A_2": None}


ROWS = [(i, 1 + i % 2, f"t{i}") for i in range(40)] + [(None, 2, None), (3, 2, "t3"), (3, 2, "t3")]


def test_failed_rewriting_goes_on_without_loss_or_repeat(spark, tmp_path):
    src, calls = str(tmp_path / "src"), tmp_path / "calls"
    calls.mkdir()
    spark.createDataFrame(ROWS, "id int, copy_no int, content string").coalesce(1).write.parquet(src)
    df, root, seen = spark.read.parquet(src), str(tmp_path / "jobs"), str(calls)

    def rewriter(broken):
        def fn(pdf):
            if broken and (pdf["id"] == 39).any():
                raise RuntimeError("not available")
            with open(f"{seen}/log", "a") as log:
                log.writelines(f"{x}\n" for x in pdf["content"])
            return pdf.assign(content="~" + pdf["content"])
        return fn

    args = dict(root=root, rows_per_file=3, files_per_batch=1)
    with pytest.raises(StreamingQueryException):
        rewrite_resumable(df, rewriter(True), **args)
    part = rewritten_rows(spark, rewrite_job(df, root), df.schema).collect()
    assert 0 < len(part) < len(ROWS)
    done = sorted((calls / "log").read_text().split())
    want = sorted(((i, c, x if c == 1 or x is None else "~" + x) for i, c, x in ROWS), key=repr)
    got = rewrite_resumable(df, rewriter(False), **args).collect()
    assert sorted(map(tuple, got), key=repr) == want
    after = sorted((calls / "log").read_text().split())
    assert after == sorted(str(x) for _, c, x in ROWS if c == 2)  # committed batches were not rewritten again
    assert done and len(done) < len(after)
    assert sorted(map(tuple, rewrite_resumable(df, rewriter(True), **args).collect()), key=repr) == want  # finished
    other = rewrite_resumable(df.where("id < 4"), rewriter(False), **args)  # other rows: a job of its own
    assert other.count() == 6
    assert rewrite_resumable(df.where("id < 0"), rewriter(False), **args).count() == 0
