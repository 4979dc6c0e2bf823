"""Registered queries: one per operator of the inventory, on the driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame with scalar
columns only (arrays are rendered as comma-joined text, doubles with fixed
decimals), so an independent SQL engine can produce byte-identical rows; the
matching SQL lives in ``cuecards.plans.oracle``.  Every query reads whole
tables: no id subsets, prefixes or row caps except where the cap is the
operator (top-k vocabulary, the unlabelled sample).
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from cuecards.functions.ids import parse_line_id, text_len
from cuecards.functions.labels import (
    binarize, bucketize, clamp, decode_levels, format_scores, ints_text, one_hot_levels, parse_labels,
    render_labels, sigmoid, smooth,
)
from cuecards.functions.text import fill_nulls, make_text, strip_punctuation
from cuecards.constants import EXAMPLE_FILE_WEIGHTS, SENTINEL
from cuecards.operators import blockfit, context, encode, ensemble, labelops, metrics, models, rebalance, splits
from cuecards.plans.prepare import label_columns, prepare_lines
from cuecards.session import checkpoint_dir
from cuecards.sources import adapters, files, order, stages, template, vectors
from cuecards.streaming import incremental

# Parameters of the registered queries (FIXTURES.md): conversation texts are
# long, so the short-line threshold is 200 code points here; the library
# default stays 70.
THRESHOLD = 200
MAX_LEN = 110
SHORT_PAIR_LEN = 12
SEED = 2021
MODELS = adapters.MODELS
FILE_WEIGHTS = dict(zip(MODELS, EXAMPLE_FILE_WEIGHTS))
RANK_WEIGHTS = {str(i): w for i, w in enumerate(EXAMPLE_FILE_WEIGHTS)}
HOLDOUT = [30001, 30004, 30009]
VOCAB = 10000
VEC_DIM = 300
PHRASE_PATTERNS = ["[a-z]{2,12}", "[a-z]{2,5} [a-z]{2,5}"]
STACK_FEATURES = [f"x{i}" for i in range(16)]
SHORT_LINE = 300  # where q_materialise cuts
# The fits' twins solve their normal equations in SQL, so these are narrow; the library's default is 2**14.
FIT_WIDTH, FIT_WIDE, REG = 8, 32, 0.01
LABEL_WEIGHTS = [1.0, 0.5, 2.0, 1.0, 1.5, 0.25]
VEC_SEED = 7


# -- inputs ------------------------------------------------------------------

def _lines(spark, sf):
    return adapters.lines_from_conversations(spark, sf)


def _parsed(spark, sf):
    return parse_line_id(_lines(spark, sf))


def _labelled(spark, sf):
    return parse_line_id(labelops.labelled(_lines(spark, sf))).withColumn("labels", parse_labels("emotions"))


def _filled(spark, sf):
    return label_columns(fill_nulls(_parsed(spark, sf), null_character=SENTINEL, null_labels=SENTINEL))


def _preds(spark, sf):
    return adapters.preds_from_embeddings(spark, sf)


def _truth(spark, sf):
    return adapters.truth_from_embeddings(spark, sf)


def _documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")


def _labels_table(spark, sf):
    return (spark.read.parquet(f"{sf}/labels.parquet")
            .select(F.col("doc_id").alias("id"), F.concat_ws("-", "quality", "toxic").alias("cls")))


def _scratch(spark, name):
    """A fresh folder: a query never reads what an earlier run wrote."""
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


# -- preparation (entry 1) -----------------------------------------------------

PREPARED_COLS = ["id", "jb_id", "cc_id", "ids", "id_t", "character", "emotions", "labels_text", "content",
                 "text_len", "text"]


def q_prepare_lines(spark, sf):
    prepared, _bad = prepare_lines(_lines(spark, sf), threshold=THRESHOLD)
    return prepared.select(*PREPARED_COLS)


def q_parse_ids(spark, sf):
    return _parsed(spark, sf).select("id", "jb_id", "cc_id", "ids", "id_t", text_len("content").alias("text_len"))


def q_label_encodings(spark, sf):
    d = _labelled(spark, sf).withColumn("label24", one_hot_levels("labels"))
    return d.select("id", render_labels("labels").alias("labels_text"), ints_text("label24").alias("label24_s"),
                    ints_text(decode_levels("label24")).alias("decoded"), ints_text("labels").alias("labels_s")) \
        .withColumnRenamed("labels_s", "labels").withColumnRenamed("label24_s", "label24")


def q_score_transforms(spark, sf):
    p = _preds(spark, sf)
    return p.select(
        "model", "id",
        format_scores(clamp("scores")).alias("clamped"),
        ints_text(bucketize("scores")).alias("bucket"),
        ints_text(binarize("scores", 0.5)).alias("binary"),
        format_scores(smooth("scores", 0.1, 2)).alias("smoothed"),
        format_scores(sigmoid("scores")).alias("sigmoid"),
    )


def q_text_templates(spark, sf):
    d = _parsed(spark, sf)
    for name, tpl in [("text_a", "content_role"), ("text_b", "char_content"), ("text_c", "id_char_content"),
                      ("text_d", "described")]:
        d = make_text(d, tpl, out=name)
    return d.select("id", "text_a", "text_b", "text_c", "text_d",
                    strip_punctuation("content", "short").alias("strip_short"),
                    strip_punctuation("content", "long").alias("strip_long"))


def q_attach_context(spark, sf):
    d = context.attach_context(_parsed(spark, sf), threshold=THRESHOLD)
    return d.select("id", "content", "text_len")


def q_attach_context_labelled(spark, sf):
    d = context.attach_context_labelled(_filled(spark, sf), threshold=THRESHOLD)
    return d.select("id", "content", "text_len")


def q_drop_sentinel(spark, sf):
    d = labelops.drop_sentinel(context.attach_context(_filled(spark, sf), threshold=THRESHOLD))
    return d.select("id", "text_len")


def q_position_in_scene(spark, sf):
    return context.position_in_scene(_parsed(spark, sf)).select("id", "pos", "scene_rows")


def q_encode_combos(spark, sf):
    return context.encode_combos(_labelled(spark, sf)).select("id", "combo")


def q_sort_lines(spark, sf):
    """The order itself: the position that each row of the sorted table has.
    A sorted table comes in ordered partitions, so a row's place is its
    partition and its number in it; counts per partition give the rest."""
    return _positions(context.sort_lines(_parsed(spark, sf)).select("id", "jb_id", "cc_id", "ids"))


def _positions(ordered):
    """``position`` (1-based) of every row of a sorted table, read from where
    the rows actually are."""
    placed = (ordered.withColumn("_part", F.spark_partition_id())
              .withColumn("_n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = _written(placed)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn("position", F.col("_start") + F.col("_n") + 1).drop("_part", "_n", "_start"))


def _written(df):
    """Written once and read back: partition numbers are facts from then on."""
    path = _scratch(df.sparkSession, "placed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- label counts, filters, rebalancing ---------------------------------------

def q_scene_counts(spark, sf):
    return labelops.scene_counts(_parsed(spark, sf))


def q_bucket_counts(spark, sf):
    return labelops.bucket_counts(_labelled(spark, sf))


def q_explode_buckets(spark, sf):
    return labelops.explode_buckets(_labelled(spark, sf)).select("id", "bucket")


def q_bucket_filter(spark, sf):
    """Every bucket in one scan; ``with_bucket`` says for each exploded row
    whether the single-bucket filter takes it too."""
    d = labelops.explode_buckets(_labelled(spark, sf))
    return d.select("id", "bucket", labelops.in_bucket("bucket").alias("in_bucket"))


def _rewritten(content):
    """A deterministic rewrite for checks: the text reversed, with a mark."""
    return F.concat(F.lit("~"), F.reverse(content))


def q_rebalance(spark, sf):
    return (rebalance.rebalance(_labelled(spark, sf), rewrite=_rewritten)
            .select("id", "bucket", "copy_no", "content"))


def _reverse_batch(pdf):
    return pdf.assign(content="~" + pdf["content"].str[::-1])


def q_rewrite_copies(spark, sf):
    """The copies rewritten by a batch function, then the union."""
    r = rebalance.rebalance(_labelled(spark, sf)).select("id", "bucket", "copy_no", "content")
    return rebalance.rewrite_copies(r, _reverse_batch)


def q_rewrite_resume(spark, sf):
    """G3 with S10: the first run of the job fails at one line, the second goes on."""
    r = rebalance.rebalance(_labelled(spark, sf)).select("id", "bucket", "copy_no", "content")
    root, stop = _scratch(spark, "rewrite"), r.where("copy_no > 1").agg(F.max("id")).first()[0]

    def fails(pdf):
        if (pdf["id"] == stop).any():
            raise RuntimeError("the rewriter is not available")
        return _reverse_batch(pdf)

    if stop is not None:
        try:
            incremental.rewrite_resumable(r, fails, root, rows_per_file=10_000)
        except StreamingQueryException:
            pass
        else:
            raise AssertionError("the first run was to fail")
    return incremental.rewrite_resumable(r, _reverse_batch, root, rows_per_file=10_000)


def q_sample_unlabelled(spark, sf):
    return rebalance.sample_unlabelled(_labelled(spark, sf), 20, SEED).select("id")


def q_holdout(spark, sf):
    train, dev = labelops.holdout(_parsed(spark, sf), HOLDOUT)
    return train.select("id", F.lit("train").alias("part")).unionByName(dev.select("id", F.lit("dev").alias("part")))


# -- splits --------------------------------------------------------------------

def q_split_random(spark, sf):
    return splits.split_random(_parsed(spark, sf), 0.2, SEED).select("id", "is_dev")


def q_split_scene(spark, sf):
    return splits.split_scene(_parsed(spark, sf), 0.2, SEED).select("id", "is_dev")


def q_fold_scene(spark, sf):
    return splits.fold_scene(_parsed(spark, sf), 5, SEED).select("id", "fold")


def q_fold_stratified(spark, sf):
    return splits.fold_stratified(_labels_table(spark, sf), "cls", 5, SEED).select("id", "cls", "fold")


def q_fold_plain(spark, sf):
    return splits.fold_plain(_labels_table(spark, sf), 5, 42).select("id", "fold")


def q_fold_view(spark, sf):
    train, dev = splits.fold_view(splits.fold_scene(_parsed(spark, sf), 5, SEED), 0)
    return train.select("id", F.lit("train").alias("part")).unionByName(dev.select("id", F.lit("dev").alias("part")))


def q_shuffle_rows(spark, sf):
    return _positions(splits.shuffle_rows(_parsed(spark, sf).select("id"), SEED))


# -- encodings -------------------------------------------------------------------

def _vocab(spark, sf, size=VOCAB):
    return encode.build_vocab(spark.read.parquet(f"{sf}/documents.parquet"), "text", size)


def q_build_vocab(spark, sf):
    return _vocab(spark, sf).select("token", "token_id", "n")


def q_encode_chars(spark, sf):
    enc = encode.encode_chars(_documents(spark, sf), _vocab(spark, sf), MAX_LEN)
    return enc.select("id", ints_text("input_ids").alias("input_ids"))


def q_pack_single(spark, sf):
    enc = encode.encode_chars(_documents(spark, sf), _vocab(spark, sf), MAX_LEN, pad=False)
    p = encode.pack_single(enc, "input_ids", MAX_LEN)
    return p.select("id", ints_text("packed_ids").alias("packed_ids"), ints_text("attention_mask").alias("attention_mask"),
                    ints_text("token_type_ids").alias("token_type_ids"))


def _pair(spark, sf, max_len):
    d = _labelled(spark, sf)
    enc = encode.encode_chars(d.select("id", F.col("content").alias("text"), "labels"), _vocab(spark, sf), MAX_LEN,
                              pad=False, carry=["labels"])
    p = encode.pack_pair(enc, "input_ids", "labels", max_len)
    cols = ["pair_ids", "pair_mask", "pair_segments", "pair_marks", "doc_positions", "label_positions"]
    return p.select("id", *[ints_text(c).alias(c) for c in cols])


def q_pack_pair(spark, sf):
    return _pair(spark, sf, MAX_LEN)


def q_pack_pair_short(spark, sf):
    return _pair(spark, sf, SHORT_PAIR_LEN)


def q_mask_labels(spark, sf):
    d = encode.mask_labels(_labelled(spark, sf), "labels", SEED)
    return d.select("id", "given_pos", ints_text("mask_positions").alias("mask_positions"),
                    ints_text("mask_targets").alias("mask_targets"))


def q_label_pairs(spark, sf):
    d = _labelled(spark, sf).withColumn("labels", F.transform("labels", lambda x: (x >= 1).cast("int")))
    return encode.label_pairs(d, "labels", SEED)


def _vector_file(spark, sf):
    """The benchmark vectors as a text file: a header line, then a token and
    its values per line."""
    path = _scratch(spark, "vectors")
    v = _bench_vectors(spark, sf).where(encode.strip_ws("token") != "")
    head = spark.range(1).select(F.lit(f"0 {VEC_DIM}").alias("value"))
    rows = v.select(F.concat_ws(" ", "token", F.transform("vec", lambda x: x.cast("string"))).alias("value"))
    head.unionByName(rows).write.text(path)
    return path


def q_read_vectors(spark, sf):
    """The vector file read back."""
    v = vectors.read_vectors(spark, _vector_file(spark, sf), VEC_DIM)
    return v.select("token", format_scores("vec").alias("vec"))


def q_damaged_vectors(spark, sf):
    """S8 on a file where, by a digit of the token's hash, a line lacks its last
    value or its last value is no number."""
    path = _scratch(spark, "damaged")
    lines = spark.read.text(_vector_file(spark, sf))
    kind = F.substring(F.md5(F.concat(F.lit("d"), F.split("value", " ")[0])), 1, 1)
    cut = F.regexp_replace("value", " [^ ]*$", "")
    header = F.col("value") == f"0 {VEC_DIM}"
    lines.select(F.when(header | (kind >= "6"), F.col("value")).when(kind < "3", cut)
                 .otherwise(F.concat(cut, F.lit(" x"))).alias("value")).write.text(path)
    return vectors.damaged_vectors(spark, path, VEC_DIM).select("token", "n_fields", "bad_values")


def _bench_vectors(spark, sf):
    """Vectors for every character of the benchmark texts: ``dim`` values
    ``(md5('v|token|i') mod 1000) / 1000`` as float."""
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    toks = b.select(F.explode(encode.chars("text")).alias("token")).distinct()
    vec = F.transform(
        F.sequence(F.lit(0), F.lit(VEC_DIM - 1)),
        lambda i: ((F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("v"), F.col("token"), i.cast("string"))), 1, 8), 16, 10)
                    .cast("long") % 1000) / F.lit(1000.0)).cast("float"))
    # a table, as a vector file would be: made once, not once per character that the lookup reads
    return _written(toks.select("token", vec.cast("array<float>").alias("vec")))


def q_lookup_vectors(spark, sf):
    v = vectors.lookup_vectors(_vocab(spark, sf), _bench_vectors(spark, sf), VEC_DIM, VEC_SEED)
    return v.select("token", "token_id", "found", format_scores("vec").alias("vec"))


def _char_table(spark, sf):
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    toks = b.select(F.explode(encode.chars("text")).alias("token")).distinct()
    cp = F.ascii("token")
    return toks.select("token", F.array(cp % 97, cp % 89, F.floor(cp / 7) % 50).cast("array<int>").alias("ids"))


def q_char_features(spark, sf):
    d = _parsed(spark, sf).select("id", F.col("content").alias("text"))
    f = encode.char_features(d, _char_table(spark, sf), width=8)
    return f.select("id", F.array_join(F.transform("char_features", lambda a: ints_text(a)), ";").alias("features"))


def _phrase_table(spark, sf):
    """The words and the pairs of short words of the benchmark texts."""
    b = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in PHRASE_PATTERNS])
    code = F.transform(encode.chars("phrase"), lambda c, i: F.array(
        (F.ascii(c) * 7 + i) % 97, F.char_length("phrase") % 50).cast("array<int>"))
    return b.select(F.explode(found).alias("phrase")).distinct().select("phrase", code.alias("ids"))


def q_phrase_features(spark, sf):
    """J6, where a character's list depends on its phrase."""
    d = _parsed(spark, sf).select("id", F.col("content").alias("text"))
    f = encode.phrase_features(d, _phrase_table(spark, sf), _char_table(spark, sf), width=8)
    return f.select("id", F.array_join(F.transform("char_features", lambda a: ints_text(a)), ";").alias("features"))


# -- ensembles ------------------------------------------------------------------

def q_mean_ensemble(spark, sf):
    return ensemble.mean_ensemble(_preds(spark, sf)).select("id", format_scores("scores").alias("scores"), "n_files")


def q_weighted_mean(spark, sf):
    return ensemble.weighted_mean(_preds(spark, sf), FILE_WEIGHTS).select("id", format_scores("scores").alias("scores"))


def q_weighted_vote(spark, sf):
    p = _preds(spark, sf).withColumn("scores", bucketize("scores"))
    return ensemble.weighted_vote(p, FILE_WEIGHTS).select("id", ints_text("scores").alias("scores"))


def q_weighted_vote_labels(spark, sf):
    """A12 with a weight per label position."""
    p = _preds(spark, sf).withColumn("scores", bucketize("scores"))
    return ensemble.weighted_vote(p, FILE_WEIGHTS, LABEL_WEIGHTS).select("id", ints_text("scores").alias("scores"))


def q_rank_vote(spark, sf):
    return ensemble.rank_vote(adapters.ranked_from_events(spark, sf), RANK_WEIGHTS).select("key_id", "word")


def q_fold_mean(spark, sf):
    return ensemble.fold_mean(_preds(spark, sf)).select("id", format_scores("scores").alias("scores"))


def q_model_corr(spark, sf):
    return ensemble.model_corr(_preds(spark, sf), MODELS)


def q_align_files(spark, sf):
    a = ensemble.align(_preds(spark, sf), MODELS)
    return a.select("id", *[format_scores(m).alias(m) for m in MODELS])


def _template(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("id"))


def q_fill_template(spark, sf):
    mean = ensemble.mean_ensemble(_preds(spark, sf))
    return template.fill_template(_template(spark, sf), mean).select("id", "emotion")


def q_restore_order(spark, sf):
    """A template written to files and read back; filled after a shuffle, its
    rows stand in the files' order again."""
    path = _scratch(spark, "template")
    files.write_table(_template(spark, sf).orderBy(F.md5(F.col("id").cast("string")), "id"), path)
    t = order.number_rows(spark.read.option("header", True).option("sep", "\t").schema("id long").csv(path))
    filled = template.fill_template(t.repartition("id"), ensemble.mean_ensemble(_preds(spark, sf)))
    return _positions(filled.orderBy("ordinal").select("id", "emotion"))


def q_template_report(spark, sf):
    return template.template_report(_template(spark, sf), ensemble.mean_ensemble(_preds(spark, sf)))


# -- metrics --------------------------------------------------------------------

def _all_pairs(spark, sf):
    """Every file's predictions with the gold labels, per file."""
    p = _preds(spark, sf).join(_truth(spark, sf), "id")
    return p.groupBy("model")


def q_metrics_rmse(spark, sf):
    flat, per = metrics.rmse_expr("flat"), metrics.rmse_expr("per_label")
    return _all_pairs(spark, sf).agg(
        F.round(flat, 6).alias("rmse_flat"), F.round(F.lit(1.0) / (F.lit(1.0) + flat), 6).alias("score_flat"),
        F.round(per, 6).alias("rmse_per_label"), F.round(F.lit(1.0) / (F.lit(1.0) + per), 6).alias("score_per_label"))


def q_metrics_losses(spark, sf):
    return _all_pairs(spark, sf).agg(
        F.round(metrics.exact_match_expr(), 6).alias("exact_match"),
        F.round(metrics.mse_expr(), 6).alias("mse"),
        F.round(metrics.bce_expr(), 6).alias("bce"))


def q_evaluate(spark, sf):
    e = metrics.evaluate(_preds(spark, sf), _truth(spark, sf), by=["model"])
    return e.select("model", "rows", *[F.round(c, 6).alias(c) for c in
                                        ("rmse_flat", "rmse_per_label", "score", "exact_match", "mse")])


def q_length_histogram(spark, sf):
    return metrics.length_histogram(spark.read.parquet(f"{sf}/documents.parquet"), "text", 500)


def q_cut_share(spark, sf):
    c = metrics.cut_share(spark.read.parquet(f"{sf}/documents.parquet"), "text")
    return c.select(*[F.round(x, 6).alias(x) for x in c.columns])


# -- sources, sinks, stages -------------------------------------------------------

def q_materialise(spark, sf):
    """Two filters of one source under one stage name are two tables."""
    prepared, _ = prepare_lines(_lines(spark, sf), threshold=THRESHOLD)
    root, cut = _scratch(spark, "stages"), F.col("text_len") < SHORT_LINE
    parts = [stages.materialise(prepared.select(*PREPARED_COLS).where(c), "prepared", {"threshold": THRESHOLD}, root=root)
             .select(*PREPARED_COLS, F.lit(name).alias("part")) for name, c in (("short", cut), ("long", ~cut))]
    return parts[0].unionByName(parts[1])


def q_pending(spark, sf):
    lines = _parsed(spark, sf)
    done = splits.split_random(lines, 0.2, SEED).where("is_dev").select("id")
    return stages.pending(lines, done, "id").select("id")


def q_tsv_roundtrip(spark, sf):
    path = _scratch(spark, "lines")
    files.write_table(_lines(spark, sf), path, escape=True)
    return files.read_lines(spark, path, labeled=True, escaped=True).select("id", "content", "character", "emotions")


def q_line_rule(spark, sf):
    """S1 on rows with missing and surplus fields: by a digit of the id's hash,
    a line lacks its last field, has one too many (empty or not), or is right;
    the text is quoted and holds line breaks."""
    path = _scratch(spark, "ragged")
    lines = _lines(spark, sf)
    kind = F.substring(F.md5(F.concat(F.lit("r"), F.col("id"))), 1, 1)
    text = F.concat(F.lit('"'), F.replace(F.col("content"), F.lit('"'), F.lit('""')), F.lit('\n""x""\n"'))
    fields = [F.col("id"), text, F.coalesce("character", F.lit("x"))]
    last = F.coalesce("emotions", F.lit("x"))
    row = (F.when(kind < "3", F.concat_ws("\t", *fields))
           .when(kind < "6", F.concat_ws("\t", *fields, last, F.lit("")))
           .when(kind < "9", F.concat_ws("\t", *fields, last, F.lit(""), F.lit("y")))
           .otherwise(F.concat_ws("\t", *fields, last)))
    # a partition is a file: each begins with its header
    head = F.lit("id\tcontent\tcharacter\temotions")
    placed = lines.select(row.alias("value"), F.spark_partition_id().alias("_p"))
    heads = placed.select("_p").distinct().select(head.alias("value"), "_p", F.lit(0).alias("_o"))
    placed.withColumn("_o", F.lit(1)).unionByName(heads).repartition("_p").sortWithinPartitions("_p", "_o").drop("_o").write.partitionBy("_p").text(path)
    back = files.read_lines(spark, f"{path}/*/*.txt", labeled=True, skip_bad=False, multi_line=True)
    return back.select("id", "character", "emotions", F.col("_too_long").alias("too_long"), F.md5("content").alias("content_md5"))


def q_quarantine(spark, sf):
    """The rows that preparation sets aside, of lines whose ids are damaged by a
    digit of their hash."""
    kind = F.substring(F.md5(F.concat(F.lit("q"), F.col("id"))), 1, 1)
    bad = _lines(spark, sf).withColumn("id", F.when(kind < "2", F.replace("id", F.lit("_"), F.lit("-")))
                                       .otherwise(F.col("id")))
    bad = bad.withColumn("content", F.when(kind != "f", F.col("content")))
    prepared, quarantined = prepare_lines(bad, threshold=THRESHOLD)
    return (prepared.select("id", F.lit("prepared").alias("part"))
            .unionByName(quarantined.select("id", F.lit("quarantined").alias("part"))))


def q_split_scene_bad_ids(spark, sf):
    """D2 and W4 on lines of which some have no scene or sequence number: no row
    is lost, rows without a scene are a group of their own."""
    kind = F.substring(F.md5(F.concat(F.lit("n"), F.col("id"))), 1, 1)
    d = (_parsed(spark, sf).withColumn("cc_id", F.when(kind >= "2", F.col("cc_id")))
         .withColumn("ids", F.when(kind != "7", F.col("ids"))))
    d = splits.split_scene(d, 0.2, SEED)
    return context.position_in_scene(d).select("id", "is_dev", "pos", "scene_rows")


def q_fold_stratified_null(spark, sf):
    """D4 with rows of a null class."""
    d = _labels_table(spark, sf).withColumn("cls", F.when(F.col("id") % 7 != 0, F.col("cls")))
    return splits.fold_stratified(d, "cls", 5, SEED).select("id", "cls", "fold")


def q_context_script(spark, sf):
    """W1 restarting at every script."""
    return context.attach_context(_parsed(spark, sf), threshold=THRESHOLD, scope="script").select("id", "content", "text_len")


def q_context_scene(spark, sf):
    """W1 restarting at every scene."""
    return context.attach_context(_parsed(spark, sf), threshold=THRESHOLD, scope="scene").select("id", "content", "text_len")


def _preds24(spark, sf):
    """Two files of 24 scores: the 24-wide label vector's logits."""
    emb = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    return emb.select("id", F.explode(F.array(*[
        F.struct(F.lit(f"m{k}").alias("model"), F.array(*[
            F.get("embedding", 24 * k + i).cast("double") * 8 for i in range(24)]).alias("scores"))
        for k in range(2)])).alias("p")).select("p.model", "id", "p.scores")


def q_decode24(spark, sf):
    """The 24-slot chain: mean of the files, sigmoid, threshold 0.5, levels."""
    mean = ensemble.mean_ensemble(_preds24(spark, sf), n=24)
    hot = mean.withColumn("slots", binarize(sigmoid("scores"), 0.5))
    return hot.select("id", F.size("scores").alias("width"), ints_text("slots").alias("label24"),
                      ints_text(decode_levels("slots")).alias("levels"))


def q_predictions_roundtrip(spark, sf):
    root = _scratch(spark, "preds")
    # one folder per model, as the reference keeps its files, in one pass
    files.write_table(_preds(spark, sf).select("model", "id", F.col("scores").alias("emotion")), root, partition_by="model")
    back = files.read_predictions(spark, f"{root}/*/*.csv", name_from="dir")
    return back.select(F.substring_index("model", "=", -1).alias("model"), F.col("id").cast("long").alias("id"), format_scores("scores").alias("scores"))


def q_ranked_roundtrip(spark, sf):
    root = _scratch(spark, "ranked")
    out = adapters.ranked_from_events(spark, sf).select("file", "key_id", F.array_join("words", " ").alias("word"))
    out.write.partitionBy("file").option("header", True).option("quoteAll", True).csv(root)
    back = files.read_ranked(spark, f"{root}/*/*.csv", name_from="dir")
    back = back.withColumn("file", F.substring_index("file", "=", -1))
    return ensemble.rank_vote(back, RANK_WEIGHTS).select("key_id", "word")


# -- model jobs --------------------------------------------------------------------

def _stub_predict_fn():
    import numpy as np

    def predict(x):
        return x[:, 0:6].astype(np.float64) * 8.0 + 1.0

    return predict


def q_score_table(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    scored = models.score_table(emb, _stub_predict_fn, ["embedding"], batch_size=128, input_shapes=[[64]])
    return scored.select("id", format_scores("scores").alias("scores"))


def _train_dev(spark, sf):
    """The prepared lines, written once (the fits read them many times), split."""
    prepared, _ = prepare_lines(_lines(spark, sf), threshold=THRESHOLD)
    d = _written(splits.split_random(prepared.select("id", "jb_id", "cc_id", "text", "labels"), 0.2, SEED))
    return d.where(~F.col("is_dev")), d.where("is_dev")


def _columns(scores, n=6, digits=4):
    return [F.round(F.get(scores, i), digits).alias(f"s{i}") for i in range(n)]


def _first_order(train, model, labels, n):
    """What only the minimum of a penalised linear fit satisfies, per bucket and
    label: the mean of prediction times count, plus the penalty's share, is the
    mean of label times count."""
    rows = blockfit.hashed_ngrams(train, ["id"], "text", model.width)
    long = rows.join(model.predict(train), "id").select(
        F.explode(F.arrays_zip("idx", "cnt")).alias("x"), "scores").select("x.*", "scores")
    total = train.count()
    sums = long.groupBy(F.col("idx").alias("bucket")).agg(
        (F.sum("cnt") / total).alias("m"), (F.sum(F.col("cnt") * F.col("cnt")) / total).alias("mm"),
        F.array(*[F.sum(F.col("cnt") * F.get("scores", i)) / total for i in range(n)]).alias("p"))
    w = train.sparkSession.createDataFrame(
        [(int(j), [float(x) for x in row]) for j, row in zip(model.fit.active, model.fit.weights)], "bucket int, w array<double>")
    var = F.col("mm") - F.col("m") * F.col("m")
    both = sums.where(var > 1e-9).join(w, "bucket").select("bucket", F.posexplode(F.zip_with(
        "p", "w", lambda p, x: p + x * var * REG)).alias("label", "moment"))
    return both.select("bucket", "label", F.round("moment", 4).alias("moment"))


def q_train_regressor(spark, sf):
    """M2: predictions of the held-out lines, against the normal equations solved in SQL."""
    train, dev = _train_dev(spark, sf)
    model = models.train_regressor(train, num_features=FIT_WIDTH, reg=REG)
    return model.predict(dev, lo=0.0, hi=3.0).select("id", *_columns("scores"))


def q_train_regressor_fit(spark, sf):
    train, _ = _train_dev(spark, sf)
    return _first_order(train, models.train_regressor(train, num_features=FIT_WIDE, reg=REG), "labels", 6)


def q_train_classifier(spark, sf):
    """M3 with six binary labels."""
    train, _ = _train_dev(spark, sf)
    return _first_order(train, models.train_classifier(train, num_features=FIT_WIDTH, reg=REG), "labels", 6)


def q_train_classifier24(spark, sf):
    """M3 with the 24 slots of the level encoding."""
    train, _ = _train_dev(spark, sf)
    train = train.withColumn("labels", one_hot_levels("labels"))
    return _first_order(train, models.train_classifier(train, n=24, num_features=FIT_WIDTH, reg=REG), "labels", 24)


def q_train_evaluate(spark, sf):
    """Train, predict and score the held-out lines (M2, M6)."""
    train, dev = _train_dev(spark, sf)
    e = metrics.evaluate(models.train_regressor(train, num_features=FIT_WIDTH, reg=REG).predict(dev), dev)
    return e.select("rows", *[F.round(c, 4).alias(c) for c in ("rmse_flat", "score", "exact_match", "mse")])


def q_cv_ensemble(spark, sf):
    """M4: clamped and averaged predictions of the five fold models."""
    train, dev = _train_dev(spark, sf)
    out = models.cv_ensemble(train, dev, k=5, seed=SEED, num_features=FIT_WIDTH, reg=REG)
    return out.select("id", *_columns("scores"), "n_files")


def _stack_input(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    h = F.md5(F.col("vec_id").cast("string"))
    d = emb.select(F.col("vec_id").alias("id"), *[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(STACK_FEATURES)],
                   (F.substring(h, 1, 1) >= "a").cast("int").alias("label"))
    return splits.split_random(d, 0.2, 42)


def q_stack(spark, sf):
    """M5: the linear column against SQL; forests average labels, so they stay inside 0..1."""
    d = _stack_input(spark, sf)
    out = models.stack(d.where(~F.col("is_dev")), d.where("is_dev"), STACK_FEATURES, "label", k=5)
    return out.select("id", F.round("lr", 6).alias("lr"), F.col("rf").between(0, 1).alias("rf_in_range"),
                      F.col("prediction").between(0, 1).alias("in_range"))


def q_stack_oof(spark, sf):
    """M5 level 1: every training row's out-of-fold linear prediction."""
    d = _stack_input(spark, sf)
    oof = models.out_of_fold(d.where(~F.col("is_dev")), STACK_FEATURES, "label", k=5)
    return oof.select("id", F.round("lr", 6).alias("lr"), F.col("rf").between(0, 1).alias("rf_in_range"))


QUERIES = {
    "prepare_lines": q_prepare_lines,
    "parse_ids": q_parse_ids,
    "label_encodings": q_label_encodings,
    "score_transforms": q_score_transforms,
    "text_templates": q_text_templates,
    "attach_context": q_attach_context,
    "attach_context_labelled": q_attach_context_labelled,
    "drop_sentinel": q_drop_sentinel,
    "position_in_scene": q_position_in_scene,
    "encode_combos": q_encode_combos,
    "sort_lines": q_sort_lines,
    "scene_counts": q_scene_counts,
    "bucket_counts": q_bucket_counts,
    "explode_buckets": q_explode_buckets,
    "bucket_filter": q_bucket_filter,
    "rebalance": q_rebalance,
    "sample_unlabelled": q_sample_unlabelled,
    "holdout": q_holdout,
    "split_random": q_split_random,
    "split_scene": q_split_scene,
    "fold_scene": q_fold_scene,
    "fold_stratified": q_fold_stratified,
    "fold_plain": q_fold_plain,
    "fold_view": q_fold_view,
    "shuffle_rows": q_shuffle_rows,
    "build_vocab": q_build_vocab,
    "encode_chars": q_encode_chars,
    "pack_single": q_pack_single,
    "pack_pair": q_pack_pair,
    "pack_pair_short": q_pack_pair_short,
    "mask_labels": q_mask_labels,
    "label_pairs": q_label_pairs,
    "lookup_vectors": q_lookup_vectors,
    "char_features": q_char_features,
    "phrase_features": q_phrase_features,
    "mean_ensemble": q_mean_ensemble,
    "weighted_mean": q_weighted_mean,
    "weighted_vote": q_weighted_vote,
    "rank_vote": q_rank_vote,
    "fold_mean": q_fold_mean,
    "model_corr": q_model_corr,
    "align_files": q_align_files,
    "fill_template": q_fill_template,
    "template_report": q_template_report,
    "metrics_rmse": q_metrics_rmse,
    "metrics_losses": q_metrics_losses,
    "evaluate": q_evaluate,
    "length_histogram": q_length_histogram,
    "cut_share": q_cut_share,
    "materialise": q_materialise,
    "pending": q_pending,
    "tsv_roundtrip": q_tsv_roundtrip,
    "predictions_roundtrip": q_predictions_roundtrip,
    "ranked_roundtrip": q_ranked_roundtrip,
    "score_table": q_score_table,
    "train_regressor": q_train_regressor,
    "train_classifier": q_train_classifier,
    "train_classifier24": q_train_classifier24,
    "cv_ensemble": q_cv_ensemble,
    "stack": q_stack,
    "stack_oof": q_stack_oof,
    "train_regressor_fit": q_train_regressor_fit,
    "train_evaluate": q_train_evaluate,
    "rewrite_copies": q_rewrite_copies,
    "rewrite_resume": q_rewrite_resume,
    "read_vectors": q_read_vectors,
    "damaged_vectors": q_damaged_vectors,
    "weighted_vote_labels": q_weighted_vote_labels,
    "restore_order": q_restore_order,
    "line_rule": q_line_rule,
    "quarantine": q_quarantine,
    "split_scene_bad_ids": q_split_scene_bad_ids,
    "fold_stratified_null": q_fold_stratified_null,
    "context_script": q_context_script,
    "context_scene": q_context_scene,
    "decode24": q_decode24,
}
