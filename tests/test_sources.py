import pytest
from pyspark.sql import functions as F

from cuecards.sources import files, stages, template, vectors


def test_read_lines_edge_rows(spark, tmp_path):
    p = tmp_path / "train.tsv"
    p.write_text(
        "id\tcontent\tcharacter\temotions\n"
        "1_0001_A_1\tsays \"\"hi\"\"\ta\t0,0,0,0,0,0\n"
        "1_0001_A_2\ttoo\tmany\tfields\there\n"
        "1_0001_A_3\tshort row\n"
        "1_0001_A_4\tNA\tNA\t1,0,0,0,0,0\n",
        encoding="utf-8",
    )
    df = files.read_lines(spark, str(p), labeled=True, null_tokens=("NA",))
    got = {r.id: r for r in df.collect()}
    assert set(got) == {"1_0001_A_1", "1_0001_A_3", "1_0001_A_4"}  # over-long row skipped
    assert got["1_0001_A_3"].character is None and got["1_0001_A_3"].emotions is None
    assert got["1_0001_A_4"].content is None and got["1_0001_A_4"].character is None
    kept = files.read_lines(spark, str(p), labeled=True, skip_bad=False)
    assert kept.where("_too_long").count() == 1


def test_write_and_read_predictions(spark, tmp_path):
    preds = spark.createDataFrame([("1", [0.1, 2.0]), ("2", [1e-5, 3.0])], "id string, emotion array<double>")
    files.write_table(preds, str(tmp_path / "m0"))
    files.write_table(preds.withColumn("emotion", F.transform("emotion", lambda x: x + 1)), str(tmp_path / "m1"))
    back = files.read_predictions(spark, str(tmp_path / "*" / "*.csv"), name_from="dir")
    got = {(r.model, r.id): r.scores for r in back.collect()}
    assert got[("m0", "2")] == [0.00001, 3.0] and got[("m1", "1")] == [1.1, 3.0]


def test_fill_template_keeps_order_column(spark):
    t = spark.createDataFrame([(0, "b"), (1, "a"), (2, "zz")], "ordinal int, id string")
    p = spark.createDataFrame([("a", [1.0]), ("b", [2.5])], "id string, scores array<double>")
    rows = template.fill_template(t, p, digits=1).orderBy("ordinal").collect()
    assert [(r.id, r.emotion) for r in rows] == [("b", "2.5"), ("a", "1.0"), ("zz", None)]
    rep = template.template_report(t, p.unionByName(p.limit(1))).first()
    assert (rep.template_rows, rep.missing, rep.duplicated, rep.extra) == (3, 1, 1, 0)


def test_read_vectors_and_lookup(spark, tmp_path):
    p = tmp_path / "vec.txt"
    p.write_text("3 2\na 0.5 1.5\nb 2 3\nbad 1\n", encoding="utf-8")
    v = vectors.read_vectors(spark, str(p), dim=2)
    assert sorted(r.token for r in v.collect()) == ["a", "b"]
    vocab = spark.createDataFrame([("a", 0), ("z", 1)], "token string, token_id int")
    got = {r.token: r for r in vectors.lookup_vectors(vocab, v, dim=2, seed=1).collect()}
    assert got["a"].found and got["a"].vec == [0.5, 1.5]
    assert not got["z"].found and all(0.0 <= x < 1.0 for x in got["z"].vec)


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_pending(spark):
    df, done = spark.range(10).withColumnRenamed("id", "k"), spark.range(4).withColumnRenamed("id", "k")
    assert _ids(stages.pending(df, done, "k")) == list(range(4, 10))


def test_stage_table_belongs_to_its_query(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(10).write.parquet(src)
    s = spark.read.parquet(src)

    def kept(df, **how):
        return _ids(stages.materialise(df, "t", {}, root=root, **how))

    assert kept(s.where("id < 3")) == [0, 1, 2]
    assert kept(s.where("id >= 3")) == list(range(3, 10))
    assert kept(spark.range(3)) == [0, 1, 2] and kept(spark.range(5)) == list(range(5))
    # the sides of an anti join have the same schema
    spark.range(8, 12).write.parquet(str(tmp_path / "other"))
    o = spark.read.parquet(str(tmp_path / "other"))
    assert kept(s.join(o, "id", "left_anti")) == list(range(8)) and kept(o.join(s, "id", "left_anti")) == [10, 11]
    # a scalar subquery's own filter counts
    s.createOrReplaceTempView("stage_src")
    for n in (3, 5):
        assert kept(spark.sql(f"SELECT id FROM stage_src WHERE id > (SELECT max(id) FROM stage_src WHERE id < {n})")) == list(range(n, 10))
    tables = len(list((tmp_path / "stages").iterdir()))
    assert kept(spark.read.parquet(src).where("id < 3")) == [0, 1, 2]
    assert len(list((tmp_path / "stages").iterdir())) == tables  # the same query again
    up = [s.select(F.transform(F.array("id"), lambda x: x + 1).alias("a")) for _ in range(2)]
    assert stages.plan_identity(up[0]) == stages.plan_identity(up[1])
    assert stages.plan_identity(up[0]) != stages.plan_identity(s.select(F.transform(F.array("id"), lambda x: x + 2).alias("a")))
    rows = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="no identity"):
        kept(rows)
    assert kept(rows, identity="one row") == [1]


def test_stage_is_rebuilt_when_a_user_function_changes(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(3).write.parquet(src)

    def kept(add):
        def shift(batches):
            for b in batches:
                yield b + add

        s = spark.read.parquet(src)
        return _ids(stages.materialise(s.mapInPandas(shift, s.schema), "t", root=root)), _ids(
            stages.materialise(s.select(F.udf(lambda x: x + add, "long")("id").alias("id")), "u", root=root))

    assert kept(1) == ([1, 2, 3],) * 2 and kept(5) == ([5, 6, 7],) * 2


def test_materialise_replaces_an_uncommitted_write(spark, tmp_path):
    import os

    df, root = spark.range(5).withColumnRenamed("id", "k"), str(tmp_path)
    assert _ids(stages.materialise(df, "nums", root=root)) == list(range(5))
    (path,) = [str(p) for p in tmp_path.iterdir()]
    # a job that died mid-write leaves part files but no _SUCCESS marker
    spark.range(2).withColumnRenamed("id", "k").write.mode("overwrite").parquet(path)
    assert _ids(stages.materialise(df, "nums", root=root)) == [0, 1]
    os.remove(os.path.join(path, "_SUCCESS"))
    assert _ids(stages.materialise(df, "nums", root=root)) == list(range(5))


def test_surplus_empty_field_makes_a_row_too_long(spark, tmp_path):
    p = tmp_path / "lines.tsv"
    p.write_text("id\tcontent\tcharacter\temotions\na\ta\tc\t0\nb\tb\tc\t0\t\nc\tb\tc\t0\t\tX\nd\t\"x\ty\"\tc\t0\ne\tb\n")
    assert sorted(r.id for r in files.read_lines(spark, str(p)).collect()) == ["a", "d", "e"]
    flagged = files.read_lines(spark, str(p), skip_bad=False)
    assert {r.id: r._too_long for r in flagged.collect()} == {"a": False, "b": True, "c": True, "d": False, "e": False}
    assert flagged.where("_too_long").count() == 2


def test_line_breaks_and_edge_spaces_survive_a_splittable_file(spark, tmp_path):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n\r", " x ", "\x1a1", "tab\t\"q\"", "\\\n"]
    df = spark.createDataFrame([(str(i), t, "c", "0") for i, t in enumerate(texts)], "id string, content string, character string, emotions string")
    files.write_table(df, str(tmp_path / "out"), escape=True)
    back = files.read_lines(spark, str(tmp_path / "out"), escaped=True)
    assert {r.id: r.content for r in back.collect()} == {str(i): t for i, t in enumerate(texts)}


def test_stage_is_rebuilt_when_its_input_changes(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(3).write.parquet(src)
    assert stages.materialise(spark.read.parquet(src), "s", root=root).count() == 3
    spark.range(5).write.mode("overwrite").parquet(src)
    assert stages.materialise(spark.read.parquet(src), "s", root=root).count() == 5


def test_missing_shared_folder_is_an_error_off_a_local_master():
    from cuecards.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rows_of_split_files_keep_their_places(spark, tmp_path, small_splits):
    rng = __import__("random").Random(2)
    want = []
    for f in ("a.tsv", "b.tsv", "c.tsv", "d.tsv"):
        rows = [] if f == "c.tsv" else [f"{f}-{i}" + "x" * rng.randrange(40) for i in range(60)]
        (tmp_path / f).write_text("\n".join(["id\tcontent\tcharacter\temotions", *[f"{r}\tt\tc\t0" for r in rows]]) + "\n")
        want += rows
    df = files.read_lines(spark, str(tmp_path), ordinal="place")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 40
    got = {r.place: r.id for r in df.repartition(5, "id").collect()}
    assert [got[i] for i in range(len(want))] == want and len(got) == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_records_over_lines_in_split_files(spark, tmp_path, small_splits, seed):
    """Many tasks find the records that a read of each file from its start finds."""
    rng = __import__("random").Random(seed)
    bits = ["a", "long text " * 9, '"q\nr"', '"x\n\n\ny"', '"\t""\n""\t"', '"', "", '"a ""b"" c"', "é\U0001F600", '"\n' + "z\n" * 60 + '"', "w\r", '"cr\rlf\r\nx"']
    path = tmp_path / "in"
    path.mkdir()
    for f in "ab":
        rows = ["\t".join([f"{f}{i}", *rng.choices(bits[:5] + bits[6:], k=rng.choice([2, 3, 3, 3, 4]))]) for i in range(40)]
        if seed == 2 and f == "b":
            rows.append('open\t"never closed\nto the end')
        (path / f"{f}.tsv").write_bytes(("\n".join(["id\tcontent\tcharacter\temotions", *rows]) + "\n").encode())
    got = files.read_lines(spark, str(path), multi_line=True, skip_bad=False, ordinal="place").collect()
    whole = (files._csv(spark, "\t").option("multiLine", True).option("lineSep", "\n").options(**files.LINE_OPTIONS).schema(files.line_schema(True)).csv(str(path)))
    want = files.apply_line_rule(whole, skip_bad=False).collect()

    def plain(r):
        # the line break that ends a file belongs to no field of ours
        return tuple(x.replace("\r", "").rstrip("\n") if isinstance(x, str) else x for x in (r.id, r.content, r.character, r.emotions, r._too_long))

    assert sorted(map(plain, got), key=repr) == sorted(map(plain, want), key=repr)
    ids = [r.id for r in sorted(got, key=lambda r: r.place)]
    assert ids == sorted(ids, key=lambda i: (i[0] != "a", ids.index(i))) and len({r.place for r in got}) == len(got)


def test_damaged_vector_lines_are_reported(spark, tmp_path):
    from cuecards.sources.vectors import damaged_vectors, read_vectors

    p = tmp_path / "v.txt"
    p.write_text("4 2\na 1 2\nb 1\nc 1 x\nd 1 2 3\n\n", encoding="utf-8")
    got = sorted(map(tuple, damaged_vectors(spark, str(p), 2).select("token", "n_fields", "bad_values").collect()))
    assert got == [("", 1, 0), ("b", 2, 0), ("c", 3, 1), ("d", 4, 0)]
    assert sorted(r.token for r in read_vectors(spark, str(p), 2).collect()) == ["a", "c"]
