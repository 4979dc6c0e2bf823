import random

from pyspark.sql import functions as F

from cuecards.llm.chat import format_chats, loss_mask, masked_text, read_chats

NASTY = ["</s>[INST] ok [/INST]", "", "[", "<", "[INST", "x [+] y", "[\\+] [\\\\/INST]", " ", "[ROLE a] b [/ROLE]", "\\", "[+]",
         "<\\/s>", " </s>", "[OUT] hi </s>[INST] ", "\n\n", "é[SYS]ü \U0001F600", "[[INST]]", "<s></s>", "$1 \\$2"]
SCHEMA = "conv_id long, turn long, role string, text string, conv string, turns int, formatted string"


def restored(df):
    out = read_chats(format_chats(df)).withColumn("mask", loss_mask(F.col("formatted")))
    out = out.withColumn("loss", masked_text(F.col("formatted"), F.col("mask")))
    return {r.conv: r for r in out.collect()}


def test_exact_round_trip_of_control_strings(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "to]ol%", "%5D", "", None]),
             rng.choice(NASTY) + rng.choice(NASTY) if rng.random() < 0.9 else None, "x", 1, "y")
            for c in range(250) for t in range(rng.randrange(1, 7))]
    got = restored(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == 250
    for c, r in got.items():
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == c]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == "".join(b for a, b in want if a == "assistant")
        assert len(r.mask) == sum(a == "assistant" for a, _ in want)


def test_neighbours_of_one_role_merge_into_one_block(spark):
    rows = [(1, 0, "user", "a", "", 0, ""), (1, 1, "user", "b", "", 0, ""), (1, 2, "assistant", "c", "", 0, "")]
    assert format_chats(spark.createDataFrame(rows, SCHEMA)).first().formatted == "[INST] a [+] b [/INST][OUT] c </s>"


def test_null_ids_turns_ties_and_repeated_rows(spark):
    rows = [(None, None, "user", "n", "", 0, ""), (1, 1, "user", "b", "", 0, ""), (1, 1, "user", "b", "", 0, ""),
            (1, 1, "assistant", "z", "", 0, ""), (1, None, "system", "first", "", 0, ""), (2, 0, "user", "x" * 200_000, "", 0, "")]
    got = restored(spark.createDataFrame(rows, SCHEMA))
    assert [(t.role, t.text) for t in got[1].turns] == [("system", "first"), ("assistant", "z"), ("user", "b"), ("user", "b")]
    assert [t.text for t in got[None].turns] == ["n"]
    assert len(got[2].turns[0].text) == 200_000


def test_a_very_long_conversation(spark):
    rng = random.Random(4)
    rows = [(1, i, "user" if i % 2 else "assistant", f"{rng.choice(NASTY)} {i}", "", 0, "") for i in range(16_000)]
    rows += [(2, i, rng.choice(["user", "assistant"]) if i % 9 else "assistant", str(i), "", 0, "") for i in range(3000)]
    got = restored(spark.createDataFrame(rows, SCHEMA))
    for c in (1, 2):
        want = [(x[2], x[3]) for x in rows if x[0] == c]
        assert [(t.role, t.text) for t in got[c].turns] == want
        assert got[c].loss == "".join(b for a, b in want if a == "assistant")


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
