import pytest
from pyspark.sql import functions as F

from cuecards.operators import encode


def truncate_loop(la, lb, max_len):
    a, b = list(range(la)), list(range(lb))
    while len(a) + len(b) > max_len - 3:
        if len(a) > len(b):
            a.pop()
        else:
            b.pop()
    return len(a), len(b)


def test_pair_truncation_closed_form(spark):
    cases = [(la, ml) for la in range(0, 60) for ml in range(9, 40)]
    df = spark.createDataFrame(cases, "la int, ml int")
    # evaluate the closed form for each max_len as a literal
    got = {}
    for ml in range(9, 40):
        a, b = encode.pair_lengths(F.col("la"), ml)
        for r in df.where(F.col("ml") == ml).select("la", a.alias("a"), b.alias("b")).collect():
            got[(r.la, ml)] = (r.a, r.b)
    for la, ml in cases:
        assert got[(la, ml)] == truncate_loop(la, 6, ml), (la, ml)


@pytest.fixture
def vocab(spark):
    docs = spark.createDataFrame([(" aab😀 ",), ("bbc",)], "text string")
    return encode.build_vocab(docs, "text", size=2)


def test_build_vocab(spark, vocab):
    got = {r.token: r.token_id for r in vocab.collect()}
    assert got == {"b": 0, "a": 1, "<UNK>": 2, "<PAD>": 3}  # b(3) > a(2) > c,😀 (cut by size)


def test_encode_chars(spark, vocab):
    df = spark.createDataFrame([(1, "ab😀"), (2, ""), (3, "bbbbbbbb")], "id long, text string")
    got = {r.id: r.input_ids for r in encode.encode_chars(df, vocab, 5).collect()}
    assert got[1] == [1, 0, 2, 3, 3]
    assert got[2] == [3, 3, 3, 3, 3]
    assert got[3] == [0] * 5


def test_pack_pair_layout(spark):
    df = spark.createDataFrame([([7] * 20, [0, 1, 2, 1, 0, 0])], "input_ids array<int>, labels array<int>")
    r = encode.pack_pair(df, "input_ids", "labels", max_len=20).first()
    a, b = truncate_loop(20, 6, 20)
    assert len(r.pair_ids) == 20 and sum(r.pair_mask) == a + b + 3
    assert r.pair_ids[: a + 2] == [101] + [7] * a + [102]
    assert r.pair_ids[a + 2: a + 2 + b] == [1, 2, 3, 4, 5, 6][:b]
    assert r.pair_marks[a + 2: a + 2 + b] == [0, 1, 0, 1, 0, 0][:b]
    assert sorted(r.doc_positions + r.label_positions) == list(range(20))


def test_mask_labels_and_pairs(spark):
    df = spark.createDataFrame([("x", [0, 1, 0, 3, 0, 0]), ("y", [0] * 6)], "id string, labels array<int>")
    got = {r.id: r for r in encode.mask_labels(df).collect()}
    assert got["x"].given_pos in (1, 3)
    assert len(got["x"].mask_positions) == 6 and got["x"].mask_positions[-1] == -1
    assert got["y"].given_pos is None and got["y"].mask_targets == [0] * 6
    b = df.withColumn("labels", F.transform("labels", lambda v: (v >= 1).cast("int")))
    pairs = encode.label_pairs(b).collect()
    same = [p for p in pairs if p.same == 1]
    assert [(p.a, p.b) for p in same] == [(1, 3)]
    assert all(p.a in (1, 3) and p.b not in (1, 3) for p in pairs if p.same == 0)


def test_vocabulary_strips_what_python_strips(spark):
    edges = [chr(c) for c in encode.WHITESPACE]
    assert [c for c in map(chr, range(0x110000)) if c.isspace()] == edges
    texts = ["　ab　", " a b ", "".join(edges) + "c" + "".join(edges)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    want = {}
    for t in texts:
        for c in t.strip():
            want[c] = want.get(c, 0) + 1
    assert {r.token: r.n for r in encode.token_counts(df).collect()} == want


def test_repeated_dictionary_token_counts_once(spark):
    d = spark.createDataFrame([("x", "aba"), ("y", ""), ("z", None), ("x", "b")], "id string, text string")
    t = spark.createDataFrame([("a", [5, 6]), ("a", [1, 2, 3]), ("bb", [9])], "token string, ids array<int>")
    got = sorted((r.id, r.char_features) for r in encode.char_features(d, t, width=2).collect())
    assert got == [("x", [[0, 0]]), ("x", [[1, 2], [0, 0], [1, 2]]), ("y", []), ("z", [])]


def test_encoding_with_one_character_in_a_third_of_all_text(spark):
    d = spark.createDataFrame([(i, "的" * 40 + chr(0x4E00 + i)) for i in range(60)], "id int, text string")
    v = encode.build_vocab(d, "text", 30)
    hot = v.where("token = '的'").first().token_id
    rows = encode.encode_chars(d, v, 41).collect()
    assert len(rows) == 60 and all(r.input_ids[:40] == [hot] * 40 for r in rows)


def longest_match(text, phrases, table, width):
    """The definition: the longest phrase at each place, else the character."""
    fill = lambda a: (list(a) + [0] * width)[:width]
    out, i = [], 0
    while i < len(text):
        n = max((len(p) for p in phrases if len(p) > 1 and text.startswith(p, i)), default=1)
        if n > 1:
            out += [fill(a) for a in phrases[text[i:i + n]]]
        else:
            out.append(fill(table.get(text[i], [])))
        i += n
    return out


PHRASES = {"银行": [[1], [2, 3]], "银行行长": [[4], [5], [6], [7]], "行长": [[8], [9]], "a.b": [[1], [2], [3]],
           "(x|y)*": [[i] for i in range(6)], "\\E$": [[7], [8], [9]], "𠀀𠀁": [[11], [12]], "\n\n": [[13], [14]], "行": [[99]]}
CHARS = {"行": [21, 22, 23], "银": [24], "a": [25], "长": [26], "𠀀": [27], "\n": [28]}


def test_reading_of_a_character_depends_on_its_phrase(spark):
    texts = ["银行行长", "银行行", "行长银行", "行行长长", "a.b axb (x|y)* xy", "\\E$ \\E", "𠀀𠀁𠀀", "\n\n\n", "", "银行" * 4000, "zzz"]
    d = spark.createDataFrame([*enumerate(texts), (None, "银行"), (99, None), (7, "行长")], "id int, text string")
    ph = spark.createDataFrame([*PHRASES.items(), ("银行", [[5], [5]]), ("未", None)], "phrase string, ids array<array<int>>")
    t = spark.createDataFrame(list(CHARS.items()), "token string, ids array<int>")
    want = [*enumerate(texts), (None, "银行"), (99, ""), (7, "行长")]
    want = sorted(((k, longest_match(x, PHRASES, CHARS, 2)) for k, x in want), key=repr)
    for hint in ("10MB", "-1"):  # broadcast or shuffle: the same rows
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)
        try:
            got = sorted(((r.id, r.char_features) for r in encode.phrase_features(d, ph, t, width=2).collect()), key=repr)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == want
    assert encode.phrase_features(d.limit(0), ph, t).count() == 0
    none = encode.phrase_features(d, ph.limit(0), t, width=2).collect()
    assert {r.id: r.char_features for r in none}[1] == longest_match("银行行", {}, CHARS, 2)


def test_found_phrases_do_not_pass_through_the_driver(spark):
    """What was found has a row for each text; only phrases counted as few are broadcast."""
    d = spark.createDataFrame([(1, "ab c")], "id int, text string")
    t = spark.createDataFrame([("a", [1])], "token string, ids array<int>")
    many = spark.range(30000).select(F.format_string("w%08d", "id").alias("phrase")).select(
        "phrase", F.transform(F.split("phrase", ""), lambda c: F.array(F.ascii(c))).alias("ids")).distinct()
    for phrases, broadcast in ((many.where("phrase < 'w00000100'"), 1), (many, 0)):
        plan = encode.phrase_features(d, phrases, t)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == broadcast and plan.count("SortMergeJoin") == 2 - broadcast


def test_a_phrase_needs_a_list_for_each_character(spark):
    d = spark.createDataFrame([(1, "ab")], "id int, text string")
    ph = spark.createDataFrame([("ab", [[1]])], "phrase string, ids array<array<int>>")
    t = spark.createDataFrame([("a", [1])], "token string, ids array<int>")
    with pytest.raises(Exception, match="number of lists"):
        encode.phrase_features(d, ph, t).collect()
