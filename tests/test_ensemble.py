import pytest
from pyspark.sql import functions as F

from cuecards.operators import ensemble
from cuecards.sources.files import read_ranked


def test_rank_vote_hand_rows(spark):
    # B, A, C files with weights 2, 1.8, 1.6; ranks weigh 5/4/3
    rows = [
        ("B", 1, ["radio", "stereo", "snorkel"]), ("A", 1, ["radio", "stereo", "alarm_clock"]),
        ("C", 1, ["radio", "stereo", "stove"]),
        ("B", 2, ["hockey_puck", "bottlecap", "sandwich"]), ("A", 2, ["hockey_puck", "bottlecap", "pool"]),
        ("C", 2, ["hockey_puck", "bottlecap", "steak"]),
        ("B", 5, ["fireplace", "campfire", "fire_hydrant"]), ("A", 5, ["fireplace", "campfire", "leaf"]),
        ("C", 5, ["fireplace", "campfire", "fire_hydrant"]),
        ("B", 6, ["fence", "jail", "spreadsheet"]), ("A", 6, ["fence", "spreadsheet", "jail"]),
        ("C", 6, ["fence", "jail", "spreadsheet"]),
    ]
    df = spark.createDataFrame(rows, "file string, key_id long, words array<string>")
    got = {r.key_id: (r.word, r.totals) for r in ensemble.rank_vote(df, [("B", 2), ("A", 1.8), ("C", 1.6)]).collect()}
    assert got[1][0] == "radio stereo snorkel"
    assert got[2][0] == "hockey_puck bottlecap sandwich"
    assert got[5][0] == "fireplace campfire fire_hydrant"
    assert got[6] == ("fence jail spreadsheet", [27.0, 19.8, 18.0])


def test_weighted_vote_ties(spark):
    p = spark.createDataFrame([
        ("a", 1, [1]), ("b", 1, [2]), ("c", 1, [2]),
        ("a", 2, [0]), ("b", 2, [1]), ("c", 2, [2]),
    ], "model string, id long, scores array<int>")
    got = {r.id: r.scores for r in ensemble.weighted_vote(p, [("a", 2), ("b", 1.8), ("c", 1.6)], n=1).collect()}
    assert got == {1: [2], 2: [0]}
    eq = {r.id: r.scores for r in ensemble.weighted_vote(
        p.where("model != 'c'"), [("a", 1), ("b", 1)], n=1).collect()}
    assert eq == {1: [1], 2: [0]}  # equal weights: first file wins


def test_means(spark):
    p = spark.createDataFrame([("a", 1, [0.0, 4.0]), ("b", 1, [1.0, 2.0])], "model string, id long, scores array<double>")
    assert ensemble.mean_ensemble(p, 2).first().scores == [0.5, 3.0]
    w = ensemble.weighted_mean(p, {"a": 3.0, "b": 1.0}, 2).first().scores
    assert w == [0.25, 3.5]
    assert ensemble.fold_mean(p, 0.0, 3.0, 2).first().scores == [0.5, 2.5]  # clamp before mean


def test_read_ranked_csv(spark, tmp_path):
    for name, body in {"B": "radio stereo snorkel", "A": "radio stereo alarm_clock"}.items():
        (tmp_path / f"{name}.csv").write_text(f'"key_id",word\n"9000003627287624",{body}\n')
    df = read_ranked(spark, str(tmp_path / "*.csv"))
    got = sorted((r.file, r.key_id, tuple(r.words)) for r in df.collect())
    assert got[0] == ("A.csv", 9000003627287624, ("radio", "stereo", "alarm_clock"))
    vote = ensemble.rank_vote(df, [("B.csv", 2), ("A.csv", 1.8)]).first()
    assert vote.word == "radio stereo snorkel"


def test_model_corr_diagonal(spark):
    p = spark.createDataFrame([("a", i, [float(i), float(i * i)]) for i in range(5)]
                              + [("b", i, [float(-i), float(i)]) for i in range(5)],
                              "model string, id long, scores array<double>")
    got = {(r.model_a, r.model_b): r.corr for r in ensemble.model_corr(p, ["a", "b"], 2).collect()}
    assert got[("a", "a")] == 1.0 and got[("a", "b")] == got[("b", "a")]


def test_model_corr_of_many_files(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    ids, files, n = 40, 500, 3
    x = rng.normal(size=(files, ids, n)) + 5 * rng.normal(size=(1, ids, n))
    rows = [(f"f{k}", i, x[k, i].tolist()) for k in range(files) for i in range(ids)]
    rows += [("f0", 900, [1.0, 2.0, 3.0]), ("other", 1, [0.0, 0.0, 0.0])]  # not in every file, not listed
    rows = [(m, i, None if (m, i) == ("f7", 3) else [None, *s[1:]] if (m, i) == ("f8", 4) else s) for m, i, s in rows]
    p = spark.createDataFrame(rows, "model string, id long, scores array<double>")
    got = ensemble.model_corr(p, [f"f{k}" for k in range(files)], n).toPandas()
    keep = np.ones((ids, n), bool)
    keep[3], keep[4, 0] = False, False
    want = np.corrcoef(x[:, keep])
    assert len(got) == files * files
    at = [got["model_a"].str[1:].astype(int), got["model_b"].str[1:].astype(int)]
    assert np.abs(got["corr"].to_numpy() - want[at[0], at[1]]).max() < 2e-9


def test_model_corr_of_no_cells_equal_scores_and_repeats(spark):
    schema = "model string, id long, scores array<double>"
    few = spark.createDataFrame([("a", 1, [1.0]), ("b", 1, [2.0]), ("a", 2, [1.0])], schema)
    assert [r["corr"] for r in ensemble.model_corr(few, ["a", "b"], 1).collect()] == [None] * 4
    assert [r["corr"] for r in ensemble.model_corr(few.limit(0), ["a"], 1).collect()] == [None]
    flat = spark.createDataFrame([(m, i, [1.0 if m == "a" else float(i)]) for m in "ab" for i in range(4)], schema)
    got = {(r.model_a, r.model_b): r["corr"] for r in ensemble.model_corr(flat, ["a", "b"], 1).collect()}
    assert got["b", "b"] == 1.0 and str(got["a", "b"]) == "nan"
    twice = flat.unionAll(flat.where("model = 'b' and id = 2"))
    with pytest.raises(Exception, match="b: repeated id 2"):
        ensemble.model_corr(twice, ["a", "b"], 1).collect()


def _brute_vote(rows, weights, n):
    order = {m: i for i, (m, _) in enumerate(weights)}
    wt = dict(weights)
    out = {}
    for key in {r[1] for r in rows}:
        res = []
        for p in range(n):
            tot, first = {}, {}
            for m, k, s in rows:
                if k == key and m in wt and s[p] is not None:
                    tot[s[p]] = tot.get(s[p], 0.0) + wt[m]
                    first[s[p]] = min(first.get(s[p], 99), order[m])
            res.append(min(tot, key=lambda v: (-round(tot[v], 9), first[v], v)) if tot else None)
        out[key] = res
    return out


def _brute_rank(rows, weights, top, base=5):
    order = {m: i for i, (m, _) in enumerate(weights)}
    wt = dict(weights)
    out = {}
    for key in {r[1] for r in rows}:
        tot, first = {}, {}
        for f, k, words in rows:
            if k == key and f in wt:
                for r, t in enumerate(words):
                    tot[t] = tot.get(t, 0.0) + (base - r) * wt[f]
                    first[t] = min(first.get(t, (99, 99)), (order[f], r))
        best = sorted(tot, key=lambda t: (-round(tot[t], 9), first[t], t))[:top]
        out[key] = " ".join(best)
    return out


def test_votes_with_a_hot_key(spark):
    # one id / key holds most rows (files repeat it): results stay exact
    import random
    rnd = random.Random(7)
    weights = [("a", 2.0), ("b", 1.8), ("c", 1.6)]
    rows = [(rnd.choice("abc"), 0 if i % 3 else rnd.randrange(1, 40), [rnd.randrange(4) for _ in range(3)])
            for i in range(1500)]
    p = spark.createDataFrame(rows, "model string, id long, scores array<int>").repartition(7)
    got = {r.id: r.scores for r in ensemble.weighted_vote(p, weights, n=3).collect()}
    assert got == _brute_vote(rows, weights, 3)

    words = ["w%02d" % i for i in range(60)]
    ranked = [(f, k, rnd.sample(words, 3)) for f, k, _ in rows]
    df = spark.createDataFrame(ranked, "file string, key_id long, words array<string>").repartition(7)
    got = {r.key_id: r.word for r in ensemble.rank_vote(df, weights).collect()}
    assert got == _brute_rank(ranked, weights, 3)


def test_votes_invariant_under_file_order_without_ties(spark):
    # weights whose subset sums are all distinct leave no ties, so the file
    # order (which only breaks ties) cannot change the result
    import itertools
    import random
    rnd = random.Random(11)
    files = ["a", "b", "c"]
    preds = [(m, i, [rnd.randrange(4) for _ in range(6)]) for m in files for i in range(60)]
    p = spark.createDataFrame(preds, "model string, id long, scores array<int>")
    words = ["w%d" % i for i in range(8)]
    ranked = [(m, i, rnd.sample(words, 3)) for m in files for i in range(60)]
    r = spark.createDataFrame(ranked, "file string, key_id long, words array<string>")
    vote_w = {"a": 1.0, "b": 2.0, "c": 4.0}
    rank_w = {"a": 1.0, "b": 100.0, "c": 10000.0}
    seen_vote, seen_rank = set(), set()
    for order in itertools.permutations(files):
        v = ensemble.weighted_vote(p, [(f, vote_w[f]) for f in order])
        seen_vote.add(tuple(sorted((x.id, tuple(x.scores)) for x in v.collect())))
        k = ensemble.rank_vote(r, [(f, rank_w[f]) for f in order])
        seen_rank.add(tuple(sorted((x.key_id, x.word) for x in k.collect())))
    assert len(seen_vote) == 1 and len(seen_rank) == 1


def _files(spark, rows):
    return spark.createDataFrame(rows, "model string, id int, scores array<double>")


@pytest.mark.parametrize("op", [
    lambda p, n: ensemble.mean_ensemble(p, n), lambda p, n: ensemble.fold_mean(p, n=n),
    lambda p, n: ensemble.weighted_mean(p, {"a": 1, "b": 1}, n), lambda p, n: ensemble.weighted_vote(p, {"a": 1, "b": 1}, n=n)])
def test_score_width_is_kept_or_rejected(spark, op):
    wide = _files(spark, [("a", 1, [1.0] * 24), ("b", 1, [1.0] * 24)])
    assert len(op(wide, 24).first().scores) == 24
    with pytest.raises(Exception, match="expected 6 scores, found 24"):
        op(wide, 6).collect()


def test_align_rejects_and_lists_repeated_ids(spark):
    p = _files(spark, [("a", 1, [1.0, 9.0]), ("a", 1, [2.0, 0.0]), ("b", 1, [0.0, 0.0])])
    assert [tuple(r) for r in ensemble.duplicate_ids(p).collect()] == [("a", 1, 2)]
    with pytest.raises(Exception, match="repeated id 1"):
        ensemble.align(p, ["a", "b"], 2).collect()


def test_weighted_mean_leaves_null_scores_out(spark):
    p = _files(spark, [("a", 1, [1.0, None, None]), ("b", 1, [None, 4.0, None])])
    assert ensemble.weighted_mean(p, {"a": 1.0, "b": 3.0}, 3).first().scores == [1.0, 4.0, None]


def test_label_weights_change_a_vote(spark):
    # position 1 is worth nothing, so its tie goes to the first file
    p = _files(spark, [("a", 1, [1.0, 1.0]), ("b", 1, [2.0, 2.0])])
    assert ensemble.weighted_vote(p, [("a", 1.0), ("b", 3.0)], [1.0, 0.0], 2).first().scores == [2.0, 1.0]
