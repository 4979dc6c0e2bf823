"""Independent DuckDB SQL for every registered query that SQL can express.

Written from the operator definitions, not from the Spark code: global
windows (``lag``, ``row_number``) where the Spark plans avoid them, plain
joins and ``unnest``.  The driver tables are pre-registered views.  Linear
fits are solved here by Gauss-Jordan elimination of their normal equations;
wider and logistic ones are checked by the equations that hold at the minimum
alone.  Forests are checked by rows and ranges.
"""

from __future__ import annotations

from cuecards.constants import (
    BUCKET_LETTERS, CLS_ID, DESCRIBE_CLOSE, DESCRIBE_OPEN, DOUBLED_BUCKETS, EMOTION_NAMES, LEVEL_WORDS,
    NO_LABEL_TEXT, PAD_ID, PUNCT_LONG, PUNCT_SHORT, ROLE_MARK, SEP_ID,
)

THRESHOLD = 200
MAX_LEN = 110
SHORT_PAIR_LEN = 12
SEED = 2021
SHORT_LINE = 300
FIT_WIDTH, FIT_WIDE, REG, STACK_DIM = 8, 32, 0.01, 16
N = 6


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _digit(h: str, k: int) -> str:
    c = f"substr({h}, {k}, 1)"
    return f"(CASE WHEN {c} < 'a' THEN 0 WHEN {c} < 'd' THEN 1 WHEN {c} < 'f' THEN 2 ELSE 3 END)"


_EMO = ", ".join(f"CAST({_digit('md5(id)', k)} AS VARCHAR)" for k in range(3, 3 + N))

LINES = f"""
lines0 AS (
  SELECT printf('%d_%04d_A_%d', 30000 + (conv_id // 8), conv_id, turn) AS id, text AS content, role
  FROM conversations),
lines AS (
  SELECT id, content,
         CASE WHEN substr(md5(id), 1, 1) < '2' THEN NULL ELSE role END AS character,
         CASE WHEN substr(md5(id), 2, 1) < '2' THEN NULL ELSE concat_ws(',', {_EMO}) END AS emotions
  FROM lines0),
parsed AS (
  SELECT *, TRY_CAST(split_part(id, '_', 1) AS INTEGER) AS jb_id,
         TRY_CAST(split_part(id, '_', 2) AS INTEGER) AS cc_id,
         TRY_CAST(split_part(id, '_', 4) AS INTEGER) AS ids,
         regexp_replace(id, '_[^_]*$', '') AS id_t
  FROM lines),
labelled AS (
  SELECT *, list_transform(string_split(emotions, ','), lambda x: TRY_CAST(trim(x) AS INTEGER)) AS labels
  FROM parsed WHERE emotions IS NOT NULL)"""


def _labels_text(col: str = "labels") -> str:
    pieces = []
    for i, name in enumerate(EMOTION_NAMES):
        whens = " ".join(f"WHEN {lv + 1} THEN {_q(word + name)}" for lv, word in enumerate(LEVEL_WORDS))
        pieces.append(f"(CASE {col}[{i + 1}] {whens} ELSE '' END)")
    return f"coalesce(nullif(concat({', '.join(pieces)}), ''), {_q(NO_LABEL_TEXT)})"


FILLED = f"""
filled AS (
  SELECT id, content, coalesce(character, '99') AS character, coalesce(emotions, '99') AS emotions,
         jb_id, cc_id, ids, id_t,
         list_transform(string_split(coalesce(emotions, '99'), ','), lambda x: TRY_CAST(trim(x) AS INTEGER)) AS labels
  FROM parsed WHERE jb_id IS NOT NULL AND cc_id IS NOT NULL AND ids IS NOT NULL AND content IS NOT NULL),
filled_t AS (SELECT *, {_labels_text()} AS labels_text FROM filled)"""


def _ctx(src: str, t: int = THRESHOLD) -> str:
    return f"""
ctx AS (
  SELECT *, CASE WHEN length(content) < {t} AND lag(content, 3) OVER w IS NOT NULL
                 THEN content || lag(content, 1) OVER w || lag(content, 2) OVER w || lag(content, 3) OVER w
                 ELSE content END AS content2
  FROM {src} WINDOW w AS (ORDER BY jb_id, cc_id, ids, id))"""


def _ints(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


def _fmt(expr: str) -> str:
    return f"printf('%.6f', ({expr}) + 0.0)"


def _fmt_list(exprs: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(_fmt(e) for e in exprs) + ")"


def _s(k: int, i: int) -> str:
    return f"(CAST(embedding[{6 * k + i + 1}] AS DOUBLE) * 8 + 1)"


PREDS = "\n".join([
    "preds AS (",
    "\nUNION ALL\n".join(
        f"  SELECT 'm{k}' AS model, {k} AS file_order, vec_id AS id, " + ", ".join(f"{_s(k, i)} AS s{i}" for i in range(N))
        + " FROM embeddings" for k in range(3)),
    ")",
])
WEIGHTS = "weights AS (SELECT * FROM (VALUES ('m0', 2.0::DOUBLE), ('m1', 1.8::DOUBLE), ('m2', 1.6::DOUBLE)) w(model, w))"
TRUTH = ("truth AS (SELECT vec_id AS id, "
         + ", ".join(f"{_digit('md5(CAST(vec_id AS VARCHAR))', i + 1)} AS t{i}" for i in range(N))
         + " FROM embeddings)")


def _hash(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def _hint(*parts: str) -> str:
    return f"CAST(('0x' || substr({_hash(*parts)}, 1, 8)) AS BIGINT)"


# What Python's str.strip() removes, as a regular expression class.  Fixed values.
_WS = ("[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}"
       "\\x{3000}]")
VOCAB = f"""
vtok AS (SELECT unnest(regexp_extract_all(regexp_replace(text, '\\A{_WS}+|{_WS}+\\z', '', 'g'), '(?s).')) AS token
         FROM documents),
vcnt AS (SELECT token, count(*) AS n FROM vtok GROUP BY token),
vtop AS (SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 AS INTEGER) AS token_id
         FROM vcnt ORDER BY n DESC, token LIMIT {{size}}),
vocab AS (SELECT token, token_id, n FROM vtop
          UNION ALL SELECT '<UNK>', CAST(count(*) AS INTEGER), 0 FROM vtop
          UNION ALL SELECT '<PAD>', CAST(count(*) + 1 AS INTEGER), 0 FROM vtop)"""


def _vocab(size: int = 10000) -> str:
    return VOCAB.replace("{size}", str(size))


def _encode(src: str, max_len: int = MAX_LEN) -> str:
    """``enc(id, l)``: unpadded id lists of the first ``max_len`` characters."""
    return f"""
ech AS (SELECT id, list_slice(regexp_extract_all(text, '(?s).'), 1, {max_len}) AS c FROM {src}),
etok AS (SELECT id, unnest(generate_series(1, len(c))) AS pos, unnest(c) AS token FROM ech),
eids AS (SELECT e.id, e.pos, coalesce(v.token_id, (SELECT token_id FROM vocab WHERE token = '<UNK>')) AS tid
         FROM etok e LEFT JOIN (SELECT token, token_id FROM vocab WHERE token NOT IN ('<UNK>', '<PAD>')) v
         ON v.token = e.token),
enc AS (SELECT ech.id, coalesce((SELECT list(tid ORDER BY pos) FROM eids WHERE eids.id = ech.id), []) AS l
        FROM ech)"""


def _rep(value: str, n: str) -> str:
    return f"list_transform(generate_series(1, {n}), lambda x: {value})"


def _pair_sql(max_len: int) -> str:
    m = max_len - 3
    # the truncation as the loop that it is: pop the longer side, the label side on a tie
    return f"""
WITH RECURSIVE {LINES},
{_vocab()},
src AS (SELECT id, content AS text FROM labelled),
{_encode('src')},
ab AS (
  SELECT enc.id, enc.l, lb.labels, len(enc.l) AS tl FROM enc JOIN labelled lb ON lb.id = enc.id),
pops(tl, a, b) AS (
  SELECT DISTINCT tl, tl, 6::BIGINT FROM ab
  UNION ALL
  SELECT tl, CASE WHEN a > b THEN a - 1 ELSE a END, CASE WHEN a > b THEN b ELSE b - 1 END FROM pops WHERE a + b > {m}),
ab3 AS (SELECT ab.*, pops.a, pops.b FROM ab JOIN pops USING (tl) WHERE pops.a + pops.b <= {m}),
ab4 AS (SELECT *, {max_len} - (a + b + 3) AS rest FROM ab3)
SELECT id,
  {_ints(f"list_concat([{CLS_ID}], list_slice(l, 1, a), [{SEP_ID}], list_slice([1,2,3,4,5,6], 1, b), [{SEP_ID}], {_rep(str(PAD_ID), 'rest')})")} AS pair_ids,
  {_ints(f"list_concat({_rep('1', 'a + b + 3')}, {_rep('0', 'rest')})")} AS pair_mask,
  {_ints(f"list_concat({_rep('0', 'a + 2')}, {_rep('1', 'b')}, {_rep('0', 'rest + 1')})")} AS pair_segments,
  {_ints(f"list_concat({_rep('0', 'a + 2')}, list_transform(list_slice(labels, 1, b), lambda t: coalesce(CAST(t = 1 AS INTEGER), 0)), {_rep('0', 'rest + 1')})")} AS pair_marks,
  {_ints(f"list_concat(generate_series(0, a + 1), generate_series(a + b + 2, {max_len - 1}))")} AS doc_positions,
  {_ints("CASE WHEN b > 0 THEN generate_series(a + 2, a + b + 1) ELSE [] END")} AS label_positions
FROM ab4"""


def _ranked_events() -> str:
    return """
ev AS (SELECT CAST(event_id % 3 AS INTEGER) AS file, user_id AS key_id, event_type, count(*) AS c
       FROM events GROUP BY ALL),
ranked AS (SELECT file, key_id, event_type AS token,
                  row_number() OVER (PARTITION BY file, key_id ORDER BY c DESC, event_type) - 1 AS r
           FROM ev QUALIFY r < 3)"""


RANK_VOTE = f"""
WITH {_ranked_events()},
fw AS (SELECT * FROM (VALUES (0, 2.0::DOUBLE), (1, 1.8::DOUBLE), (2, 1.6::DOUBLE)) t(file, w)),
sc AS (SELECT key_id, token, round(sum((5 - r) * w), 9) AS total, min(file * 100 + r) AS first
       FROM ranked JOIN fw USING (file) GROUP BY key_id, token),
top AS (SELECT *, row_number() OVER (PARTITION BY key_id ORDER BY total DESC, first) AS rn FROM sc QUALIFY rn <= 3)
SELECT key_id, string_agg(token, ' ' ORDER BY rn) AS word FROM top GROUP BY key_id"""


def _grams(width: int) -> str:
    """``x (id, j, c)``: the count of every bucket (1-based) of every row of ``pt (id, text)``."""
    return f"""
codes AS (SELECT id, list_transform(regexp_extract_all(text, '(?s).'), lambda c: CAST(unicode(c) AS BIGINT)) AS cs FROM pt),
grams AS (
  SELECT id, unnest(cs) % {width} AS j FROM codes
  UNION ALL
  SELECT id, {width} + (cs[i] * 7919 + cs[i + 1]) % {width} AS j
  FROM (SELECT id, cs, unnest(generate_series(1, len(cs) - 1)) AS i FROM codes)),
found AS (SELECT id, j, CAST(count(*) AS DOUBLE) AS c FROM grams GROUP BY ALL),
x AS (SELECT pt.id, CAST(t.j + 1 AS BIGINT) AS j, coalesce(c, 0) AS c
      FROM pt CROSS JOIN generate_series(0, {2 * width - 1}) t(j) LEFT JOIN found ON found.id = pt.id AND found.j = t.j)"""


def _solved(d: int, n: int, reg: float) -> str:
    """Least squares with a penalty on standardised weights for every ``k`` of
    ``tr (k, id, y)`` on ``x (id, j, c)``: ``sol (k, m)`` with weight ``m[i][d + l]``,
    ``mu (k, means)``, ``ym (k, y)`` and ``dense (id, f)``."""
    return f"""
dense AS (SELECT id, list(c ORDER BY j) AS f FROM x GROUP BY id),
obs AS (SELECT k, f, y FROM tr JOIN dense USING (id)),
wide AS (SELECT k, f, y, unnest(generate_series(1, {d})) AS i FROM obs),
mean_x AS (SELECT k, i, avg(f[i]) AS m FROM wide GROUP BY ALL),
mu AS (SELECT k, list(m ORDER BY i) AS means FROM mean_x GROUP BY k),
mean_y AS (SELECT k, l, avg(y[l]) AS m FROM (SELECT k, y, unnest(generate_series(1, {n})) AS l FROM obs) GROUP BY ALL),
ym AS (SELECT k, list(m ORDER BY l) AS y FROM mean_y GROUP BY k),
cov AS (SELECT w.k, w.i, j, avg((f[w.i] - a.means[w.i]) * (f[j] - a.means[j])) AS v
        FROM (SELECT *, unnest(generate_series(1, {d})) AS j FROM wide) w JOIN mu a ON a.k = w.k GROUP BY ALL),
cross_y AS (SELECT w.k, w.i, l, avg((f[w.i] - a.means[w.i]) * y[l]) AS v
            FROM (SELECT *, unnest(generate_series(1, {n})) AS l FROM wide) w JOIN mu a ON a.k = w.k GROUP BY ALL),
cells AS (SELECT k, i, j AS c, CASE WHEN i <> j THEN v WHEN v < 1e-12 THEN 1 ELSE v * (1 + {reg}) END AS v FROM cov
          UNION ALL SELECT k, i, {d} + l, v FROM cross_y),
lines_of AS (SELECT k, i, list(v ORDER BY c) AS r FROM cells GROUP BY ALL),
gj AS (
  SELECT k, 1 AS step, list(r ORDER BY i) AS m FROM lines_of GROUP BY k
  UNION ALL
  SELECT k, step + 1, list_transform(m, lambda r, i: CASE
           WHEN i = step THEN list_transform(r, lambda v: v / r[step])
           ELSE list_transform(r, lambda v, c: v - r[step] / m[step][step] * m[step][c]) END)
  FROM gj WHERE step <= {d}),
sol AS (SELECT k, m FROM gj WHERE step = {d + 1})"""


def _score(d: int, label: int) -> str:
    return (f"(ym.y[{label}] + list_sum(list_transform(generate_series(1, {d}), "
            f"lambda i: (f[i] - means[i]) * m[i][{d} + {label}])))")


def _fits(prep_body: str, h: str) -> dict[str, str]:
    """Twins of the fits: the prepared lines split as the queries split them."""
    q = {}
    lab = "list_transform(string_split(emotions, ','), lambda v: CAST(trim(v) AS INTEGER))"
    pt = f"""
prep AS ({prep_body}),
pt AS (SELECT id, text, jb_id, cc_id, {lab} AS labels, list_transform({lab}, lambda v: CAST(v AS DOUBLE)) AS y,
              row_number() OVER (ORDER BY {h}, id) <= ceil(count(*) OVER () * 0.2) AS is_dev FROM prep)"""
    d = 2 * FIT_WIDTH
    one = f"WITH RECURSIVE {pt},\n{_grams(FIT_WIDTH)},\ntr AS (SELECT 0 AS k, id, y FROM pt WHERE NOT is_dev),\n{_solved(d, N, REG)},"
    join = "FROM pt JOIN dense USING (id) CROSS JOIN sol JOIN mu USING (k) JOIN ym USING (k) WHERE is_dev"
    raw = ", ".join(f"{_score(d, i + 1)} AS p{i}" for i in range(N))
    clamped = ", ".join(f"greatest(0, least(3, {_score(d, i + 1)})) AS p{i}" for i in range(N))
    q["train_regressor"] = f"""{one}
scored AS (SELECT pt.id, {clamped} {join})
SELECT id, {', '.join(f'round(p{i}, 4) AS s{i}' for i in range(N))} FROM scored"""
    near = " + ".join(f"pow(p{i} - labels[{i + 1}], 2)" for i in range(N))
    hit = " AND ".join(f"((labels[{i + 1}] >= 1) = (p{i} >= 0.5))" for i in range(N))
    q["train_evaluate"] = f"""{one}
scored AS (SELECT pt.id, labels, {clamped} {join}),
total AS (SELECT count(*) AS rows, sum({near}) / (count(*) * {N}) AS mse, avg(CASE WHEN {hit} THEN 1.0 ELSE 0.0 END) AS exact_match FROM scored)
SELECT rows, round(sqrt(mse), 4) AS rmse_flat, round(1 / (1 + sqrt(mse)), 4) AS score, round(exact_match, 4) AS exact_match,
       round(mse, 4) AS mse FROM total"""
    q["cv_ensemble"] = f"""WITH RECURSIVE {pt},
{_grams(FIT_WIDTH)},
folds AS (SELECT id, y, CASE WHEN count(*) OVER (PARTITION BY jb_id, cc_id) >= 5
                 THEN (row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY {h}, id) - 1) % 5 END AS fold
          FROM pt WHERE NOT is_dev),
tr AS (SELECT k, id, y FROM folds, generate_series(0, 4) t(k) WHERE fold IS NULL OR fold <> k),
{_solved(d, N, REG)},
scored AS (SELECT pt.id, {clamped} {join})
SELECT id, {', '.join(f'round(avg(p{i}), 4) AS s{i}' for i in range(N))}, count(*) AS n_files FROM scored GROUP BY id"""

    def moments(width: int, y: str, n: int) -> str:
        return f"""WITH {pt},
{_grams(width)},
tr AS (SELECT id, {y} AS y FROM pt WHERE NOT is_dev),
used AS (SELECT j, y, c, max(c) OVER (PARTITION BY j) > min(c) OVER (PARTITION BY j) AS varies FROM x JOIN tr USING (id))
SELECT CAST(j - 1 AS INTEGER) AS bucket, CAST(l AS INTEGER) AS label, round(avg(c * y[l + 1]), 4) AS moment
FROM used, generate_series(0, {n - 1}) t(l) WHERE varies GROUP BY j, l"""

    q["train_regressor_fit"] = moments(FIT_WIDE, "y", N)
    q["train_classifier"] = moments(FIT_WIDTH, "list_transform(y, lambda v: CASE WHEN v >= 1 THEN 1.0 ELSE 0.0 END)", N)
    slots = ", ".join(f"CASE WHEN labels[{i + 1}] = {k} AND {k} > 0 THEN 1.0 ELSE 0.0 END" for i in range(N) for k in range(4))
    q["train_classifier24"] = moments(FIT_WIDTH, f"[{slots}]", 24)

    stack = f"""
r AS (SELECT vec_id AS id, embedding, row_number() OVER (ORDER BY {_hash_order('vec_id', 42)}, vec_id) <= ceil(count(*) OVER () * 0.2) AS is_dev,
             CASE WHEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 1) >= 'a' THEN 1.0 ELSE 0.0 END AS label FROM embeddings),
x AS (SELECT id, j, CAST(embedding[j] AS DOUBLE) AS c FROM r, generate_series(1, {STACK_DIM}) t(j)),
folds AS (SELECT id, label, (row_number() OVER (ORDER BY {_hash_order('id', 42)}, id) - 1) % 5 AS fold FROM r WHERE NOT is_dev),
tr AS (SELECT k, id, [label] AS y FROM folds, generate_series(0, 4) t(k) WHERE fold <> k),
{_solved(STACK_DIM, 1, 0)}"""
    q["stack_oof"] = f"""WITH RECURSIVE {stack}
SELECT folds.id, round({_score(STACK_DIM, 1)}, 6) AS lr, true AS rf_in_range
FROM folds JOIN dense USING (id) JOIN sol ON sol.k = fold JOIN mu ON mu.k = fold JOIN ym ON ym.k = fold"""
    q["stack"] = f"""WITH RECURSIVE {stack}
SELECT r.id, round(avg({_score(STACK_DIM, 1)}), 6) AS lr, true AS rf_in_range, true AS in_range
FROM r JOIN dense USING (id) CROSS JOIN sol JOIN mu USING (k) JOIN ym USING (k) WHERE is_dev GROUP BY r.id"""
    return q


def _hash_order(key: str, seed) -> str:
    return f"md5(concat_ws('|', '{seed}', {key}))"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    prep_body = f"""
WITH {LINES},
{FILLED},
{_ctx('filled_t')}
SELECT id, jb_id, cc_id, ids, id_t, character, emotions, labels_text, content2 AS content,
       length(content2) AS text_len, id_t || ':' || character || ':' || content2 AS text
FROM ctx WHERE emotions <> '99'"""
    q["prepare_lines"] = prep_body
    q["materialise"] = f"SELECT *, CASE WHEN text_len < {SHORT_LINE} THEN 'short' ELSE 'long' END AS part FROM ({prep_body})"
    q["parse_ids"] = f"WITH {LINES} SELECT id, jb_id, cc_id, ids, id_t, length(content) AS text_len FROM parsed"

    hot = ", ".join(f"CAST((labels[{i + 1}] > 0 AND labels[{i + 1}] = {k}) AS INTEGER)" for i in range(N) for k in range(4))
    dec = ", ".join(
        "(CASE " + " ".join(f"WHEN labels[{i + 1}] > 0 AND labels[{i + 1}] = {k} THEN {k}" for k in (3, 2, 1)) + " ELSE 0 END)"
        for i in range(N))
    q["label_encodings"] = f"""
WITH {LINES}
SELECT id, {_ints('labels')} AS labels, {_labels_text()} AS labels_text,
       concat_ws(',', {hot}) AS label24, concat_ws(',', {dec}) AS decoded
FROM labelled"""

    m0 = [f"s{i}" for i in range(N)]
    bucket = ", ".join(f"(CASE WHEN {x} < 0.5 THEN 0 WHEN {x} < 1.5 THEN 1 WHEN {x} < 2.5 THEN 2 ELSE 3 END)" for x in m0)
    q["score_transforms"] = f"""
WITH {PREDS}
SELECT model, id,
  {_fmt_list([f"greatest(0.0, least(3.0, {x}))" for x in m0])} AS clamped,
  concat_ws(',', {bucket}) AS bucket,
  concat_ws(',', {', '.join(f"CAST({x} >= 0.5 AS INTEGER)" for x in m0)}) AS binary,
  {_fmt_list([f"{x} * 0.9 + 0.05" for x in m0])} AS smoothed,
  {_fmt_list([f"1.0 / (1.0 + exp(-{x}))" for x in m0])} AS sigmoid
FROM preds"""

    ch = "coalesce(character, 'nan')"
    q["text_templates"] = f"""
WITH {LINES}
SELECT id,
  content || {_q(ROLE_MARK)} || {ch} AS text_a,
  {ch} || content AS text_b,
  id_t || ':' || {ch} || ':' || content AS text_c,
  {_q(DESCRIBE_OPEN)} || {ch} || {_q(DESCRIBE_CLOSE)} || content AS text_d,
  translate(content, {_q(PUNCT_SHORT)}, '') AS strip_short,
  translate(content, {_q(PUNCT_LONG)}, '') AS strip_long
FROM parsed"""

    q["attach_context"] = f"""
WITH {LINES},
{_ctx('parsed')}
SELECT id, content2 AS content, length(content2) AS text_len FROM ctx"""

    for name, part in (("context_script", "jb_id"), ("context_scene", "jb_id, cc_id")):
        q[name] = f"""
WITH {LINES},
{_ctx('parsed').replace("ORDER BY", f"PARTITION BY {part} ORDER BY")}
SELECT id, content2 AS content, length(content2) AS text_len FROM ctx"""

    q["attach_context_labelled"] = f"""
WITH {LINES},
{FILLED},
c2 AS (
  SELECT *,
    CASE WHEN length(content) < {THRESHOLD} AND labels_text <> {_q(NO_LABEL_TEXT)} AND lag(content, 3) OVER w IS NOT NULL
         THEN CASE WHEN lag(labels_text, 1) OVER w <> {_q(NO_LABEL_TEXT)}
                   THEN content || lag(character, 1) OVER w || lag(labels_text, 1) OVER w
                        || lag(content, 1) OVER w || lag(content, 2) OVER w || lag(content, 3) OVER w
                   ELSE content || lag(content, 1) OVER w || lag(content, 2) OVER w || lag(content, 3) OVER w END
         ELSE content END AS content2
  FROM filled_t WINDOW w AS (ORDER BY jb_id, cc_id, ids, id))
SELECT id, content2 AS content, length(content2) AS text_len FROM c2"""

    q["drop_sentinel"] = f"""
WITH {LINES},
{FILLED},
{_ctx('filled_t')}
SELECT id, length(content2) AS text_len FROM ctx WHERE emotions <> '99'"""

    q["position_in_scene"] = f"""
WITH {LINES}
SELECT id, row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY ids, id) AS pos,
       count(*) OVER (PARTITION BY jb_id, cc_id) AS scene_rows
FROM parsed"""

    q["encode_combos"] = f"""
WITH {LINES},
ct AS (SELECT id, '[' || array_to_string(labels, ', ') || ']' AS t FROM labelled)
SELECT id, CAST(dense_rank() OVER (ORDER BY t) - 1 AS INTEGER) AS combo FROM ct"""

    q["sort_lines"] = f"""
WITH {LINES}
SELECT id, jb_id, cc_id, ids, row_number() OVER (ORDER BY jb_id, cc_id, ids, id) AS position FROM parsed"""
    q["scene_counts"] = f"WITH {LINES} SELECT jb_id, cc_id, count(*) AS n FROM parsed GROUP BY jb_id, cc_id"

    bl = ", ".join(f"CASE WHEN labels[{i + 1}] > 0 THEN '{BUCKET_LETTERS[i]}' || CAST(labels[{i + 1}] AS VARCHAR) END"
                   for i in range(N))
    buckets = f"""
bl AS (SELECT id, list_filter([{bl}], lambda x: x IS NOT NULL) AS bs FROM labelled),
ex AS (SELECT id, unnest(CASE WHEN len(bs) > 0 THEN bs ELSE ['none'] END) AS bucket FROM bl)"""
    names = ", ".join(f"('{x}{lv}')" for x in BUCKET_LETTERS for lv in (1, 2, 3)) + ", ('none')"
    q["bucket_counts"] = f"""
WITH {LINES},
{buckets},
allb AS (SELECT * FROM (VALUES {names}) t(bucket))
SELECT a.bucket, count(ex.id) AS n FROM allb a LEFT JOIN ex ON ex.bucket = a.bucket GROUP BY a.bucket"""
    q["explode_buckets"] = f"WITH {LINES},\n{buckets}\nSELECT id, bucket FROM ex"
    one = " UNION ALL ".join(
        f"SELECT id, '{BUCKET_LETTERS[i]}{lv}' AS bucket, true AS in_bucket FROM labelled WHERE labels[{i + 1}] = {lv}"
        for i in range(N) for lv in (1, 2, 3))
    q["bucket_filter"] = f"""
WITH {LINES}
{one}
UNION ALL SELECT id, 'none', true FROM labelled WHERE NOT list_bool_or(list_transform(labels, lambda v: v > 0))"""
    doubled = ", ".join(f"'{b}'" for b in DOUBLED_BUCKETS)
    q["rebalance"] = f"""
WITH {LINES},
{buckets},
cp AS (SELECT id, bucket, CASE WHEN bucket IN ({doubled}) THEN 2 ELSE 1 END AS copies FROM ex),
no AS (SELECT id, bucket, unnest(generate_series(1, copies)) AS copy_no FROM cp)
SELECT no.id, bucket, copy_no,
       CASE WHEN copy_no > 1 THEN '~' || reverse(content) ELSE content END AS content
FROM no JOIN labelled USING (id)"""
    q["rewrite_copies"] = q["rebalance"]
    q["rewrite_resume"] = q["rebalance"]
    q["sample_unlabelled"] = f"""
WITH {LINES}
SELECT id FROM labelled WHERE NOT list_bool_or(list_transform(labels, lambda v: v > 0))
ORDER BY {_hash_order('id', SEED)}, id LIMIT 20"""
    q["holdout"] = f"""
WITH {LINES}
SELECT id, CASE WHEN jb_id IN (30001, 30004, 30009) THEN 'dev' ELSE 'train' END AS part FROM parsed"""

    h = _hash_order("id", SEED)
    q["split_random"] = f"""
WITH {LINES}
SELECT id, row_number() OVER (ORDER BY {h}, id) <= ceil(count(*) OVER () * 0.2) AS is_dev FROM parsed"""
    q["split_scene"] = f"""
WITH {LINES}
SELECT id, row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY {h}, id)
           <= floor(count(*) OVER (PARTITION BY jb_id, cc_id) * 0.2) AS is_dev
FROM parsed"""
    fold_scene = f"""
fs AS (SELECT id, CASE WHEN count(*) OVER (PARTITION BY jb_id, cc_id) >= 5
             THEN CAST((row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY {h}, id) - 1) % 5 AS INTEGER) END AS fold
       FROM parsed)"""
    q["fold_scene"] = f"WITH {LINES},\n{fold_scene}\nSELECT id, fold FROM fs"
    q["fold_view"] = f"""
WITH {LINES},
{fold_scene}
SELECT id, CASE WHEN fold = 0 THEN 'dev' ELSE 'train' END AS part FROM fs"""
    q["fold_stratified"] = f"""
WITH lt AS (SELECT doc_id AS id, concat_ws('-', quality, toxic) AS cls FROM labels)
SELECT id, cls, CAST((row_number() OVER (ORDER BY cls, {_hash_order('id', SEED)}, id) - 1) % 5 AS INTEGER) AS fold
FROM lt"""
    q["fold_stratified_null"] = f"""
WITH lt AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 <> 0 THEN concat_ws('-', quality, toxic) END AS cls FROM labels)
SELECT id, cls, CAST((row_number() OVER (ORDER BY cls NULLS FIRST, {_hash_order('id', SEED)}, id) - 1) % 5 AS INTEGER) AS fold
FROM lt"""
    q["split_scene_bad_ids"] = f"""
WITH {LINES},
bad AS (SELECT id, jb_id, CASE WHEN substr(md5('n' || id), 1, 1) >= '2' THEN cc_id END AS cc_id,
               CASE WHEN substr(md5('n' || id), 1, 1) <> '7' THEN ids END AS ids FROM parsed)
SELECT id, row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY {h}, id)
           <= floor(count(*) OVER (PARTITION BY jb_id, cc_id) * 0.2) AS is_dev,
       row_number() OVER (PARTITION BY jb_id, cc_id ORDER BY ids NULLS FIRST, id) AS pos,
       count(*) OVER (PARTITION BY jb_id, cc_id) AS scene_rows
FROM bad"""
    q |= _fits(prep_body, h)
    q["fold_plain"] = f"""
SELECT doc_id AS id, CAST((row_number() OVER (ORDER BY {_hash_order('doc_id', 42)}, doc_id) - 1) % 5 AS INTEGER) AS fold
FROM labels"""
    q["shuffle_rows"] = f"WITH {LINES} SELECT id, row_number() OVER (ORDER BY {h}, id) AS position FROM parsed"

    q["build_vocab"] = f"WITH {_vocab()} SELECT token, token_id, n FROM vocab"
    q["encode_chars"] = f"""
WITH {_vocab()},
src AS (SELECT doc_id AS id, text FROM documents),
{_encode('src')},
pd AS (SELECT token_id AS pad FROM vocab WHERE token = '<PAD>')
SELECT id, {_ints(f"list_concat(l, {_rep('pad', f'{MAX_LEN} - len(l)')})")} AS input_ids
FROM enc, pd"""
    q["pack_single"] = f"""
WITH {_vocab()},
src AS (SELECT doc_id AS id, text FROM documents),
{_encode('src')},
body AS (SELECT id, list_concat([{CLS_ID}], list_slice(l, 1, {MAX_LEN - 2}), [{SEP_ID}]) AS b FROM enc)
SELECT id, {_ints(f"list_concat(b, {_rep(str(PAD_ID), f'{MAX_LEN} - len(b)')})")} AS packed_ids,
       {_ints(f"list_concat({_rep('1', 'len(b)')}, {_rep('0', f'{MAX_LEN} - len(b)')})")} AS attention_mask,
       {_ints(_rep('0', str(MAX_LEN)))} AS token_type_ids
FROM body"""
    q["pack_pair"] = _pair_sql(MAX_LEN)
    q["pack_pair_short"] = _pair_sql(SHORT_PAIR_LEN)

    q["mask_labels"] = f"""
WITH {LINES},
p AS (SELECT id, labels, list_filter(generate_series(0, 5), lambda i: labels[i + 1] != 0) AS pos FROM labelled),
g AS (SELECT *, CASE WHEN len(pos) > 0 THEN CAST(pos[({_hint("'2021'", 'id', "'given'")} % len(pos)) + 1] AS INTEGER) END AS given_pos FROM p),
m AS (SELECT *, list_filter(generate_series(0, 5), lambda i: given_pos IS NULL OR i != given_pos) AS masked FROM g)
SELECT id, given_pos,
  {_ints(f"list_concat(masked, {_rep('-1', '6 - len(masked)')})")} AS mask_positions,
  {_ints(f"list_concat(list_transform(masked, lambda i: CAST(labels[i + 1] != 0 AS INTEGER)), {_rep('-1', '6 - len(masked)')})")} AS mask_targets
FROM m"""

    q["label_pairs"] = f"""
WITH {LINES},
p AS (SELECT id, list_filter(generate_series(0, 5), lambda i: labels[i + 1] >= 1) AS pos,
             list_filter(generate_series(0, 5), lambda i: NOT (labels[i + 1] >= 1)) AS neg FROM labelled),
p2 AS (SELECT *, CAST(len(pos) * (len(pos) - 1) / 2 AS INTEGER) AS np FROM p),
px AS (SELECT id, unnest(pos) AS a, unnest(generate_series(1, len(pos))) AS ia FROM p2),
pairs AS (SELECT x.id, CAST(x.a AS INTEGER) AS a, CAST(y.a AS INTEGER) AS b, 1 AS same
          FROM px x JOIN px y ON x.id = y.id AND y.ia > x.ia),
dt AS (SELECT id, pos, neg, unnest(generate_series(0, np * 2 - 1)) AS t FROM p2 WHERE np > 0 AND len(neg) > 0),
draws AS (SELECT id, CAST(pos[({_hint("'2021'", 'id', 't', "'r'")} % len(pos)) + 1] AS INTEGER) AS a,
                 CAST(neg[({_hint("'2021'", 'id', 't', "'w'")} % len(neg)) + 1] AS INTEGER) AS b, 0 AS same FROM dt)
SELECT DISTINCT id, a, b, same FROM (SELECT * FROM pairs UNION ALL SELECT * FROM draws)"""

    vec = lambda tok, i: f"CAST((({_hint(chr(39) + 'v' + chr(39), tok, chr(39) + str(i) + chr(39))}) % 1000) / 1000.0 AS FLOAT)"
    fb = lambda tok, i: f"CAST(CAST({_hint(chr(39) + '7' + chr(39), tok, chr(39) + str(i) + chr(39))} AS DOUBLE) / 4294967296.0 AS FLOAT)"
    q["lookup_vectors"] = f"""
WITH {_vocab()},
bt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM benchmark),
bv AS (SELECT token, [{', '.join(vec('token', i) for i in range(300))}] AS vec FROM bt)
SELECT v.token, v.token_id, bv.vec IS NOT NULL AS found,
       concat_ws(',', {', '.join(_fmt(f"coalesce(bv.vec[{i + 1}], {fb('v.token', i)})") for i in range(300))}) AS vec
FROM vocab v LEFT JOIN bv ON bv.token = v.token"""
    q["read_vectors"] = f"""
WITH bt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM benchmark),
bv AS (SELECT token, [{', '.join(vec('token', i) for i in range(300))}] AS vec FROM bt WHERE NOT regexp_matches(token, '{_WS}'))
SELECT token, concat_ws(',', {', '.join(_fmt(f"vec[{i + 1}]") for i in range(300))}) AS vec FROM bv"""

    spoilt = "substr(md5('d' || token), 1, 1)"
    q["damaged_vectors"] = f"""
WITH bt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM benchmark)
SELECT token, CASE WHEN {spoilt} < '3' THEN 300 ELSE 301 END AS n_fields, CASE WHEN {spoilt} < '3' THEN 0 ELSE 1 END AS bad_values
FROM bt WHERE {spoilt} < '6' AND NOT regexp_matches(token, '{_WS}')"""

    q["char_features"] = f"""
WITH {LINES},
bt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM benchmark),
tbl AS (SELECT token, [unicode(token) % 97, unicode(token) % 89, (unicode(token) // 7) % 50] AS ids FROM bt),
c AS (SELECT id, regexp_extract_all(content, '(?s).') AS cs FROM parsed),
ct AS (SELECT id, unnest(generate_series(1, len(cs))) AS pos, unnest(cs) AS token FROM c),
f AS (SELECT ct.id, ct.pos,
             array_to_string(list_concat(list_slice(coalesce(tbl.ids, []), 1, 8),
                             {_rep('0', '8 - len(list_slice(coalesce(tbl.ids, []), 1, 8))')}), ',') AS f
      FROM ct LEFT JOIN tbl ON tbl.token = ct.token)
SELECT c.id, coalesce((SELECT string_agg(f, ';' ORDER BY pos) FROM f WHERE f.id = c.id), '') AS features FROM c"""

    # greedy longest match: the longest phrase at each place, then a walk over the places
    q["phrase_features"] = f"""
WITH RECURSIVE {LINES},
bt AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM benchmark),
tbl AS (SELECT token, concat_ws(',', unicode(token) % 97, unicode(token) % 89, (unicode(token) // 7) % 50, '0,0,0,0,0') AS f FROM bt),
ph AS (SELECT DISTINCT unnest(list_concat(regexp_extract_all(text, '[a-z]{{2,12}}'),
                                          regexp_extract_all(text, '[a-z]{{2,5}} [a-z]{{2,5}}'))) AS phrase FROM benchmark),
sizes AS (SELECT DISTINCT length(phrase) AS l FROM ph),
pl AS (SELECT id, content, length(content) AS n, unnest(generate_series(1, length(content))) AS pos FROM parsed),
hits AS (SELECT id, pos, max(l) AS l FROM pl JOIN sizes ON pos + l - 1 <= n JOIN ph ON phrase = substr(content, pos, l) GROUP BY id, pos),
steps AS (SELECT pl.id, pl.pos, n, coalesce(l, 1) AS l FROM pl LEFT JOIN hits USING (id, pos)),
walk(id, pos, l) AS (
  SELECT id, pos, l FROM steps WHERE pos = 1
  UNION ALL
  SELECT s.id, s.pos, s.l FROM walk w JOIN steps s ON s.id = w.id AND s.pos = w.pos + w.l),
ct AS (SELECT w.id, w.pos, w.l, unnest(generate_series(0, w.l - 1)) AS i FROM walk w),
f AS (SELECT ct.id, ct.pos + i AS pos,
             CASE WHEN l > 1 THEN concat_ws(',', (unicode(substr(content, ct.pos + i, 1)) * 7 + i) % 97, l % 50, '0,0,0,0,0,0')
                  ELSE coalesce(tbl.f, '0,0,0,0,0,0,0,0') END AS f
      FROM ct JOIN parsed USING (id) LEFT JOIN tbl ON tbl.token = substr(content, ct.pos + i, 1))
SELECT p.id, coalesce(string_agg(f, ';' ORDER BY pos), '') AS features FROM parsed p LEFT JOIN f ON f.id = p.id GROUP BY p.id"""

    avg = [f"avg(s{i})" for i in range(N)]
    q["mean_ensemble"] = f"WITH {PREDS} SELECT id, {_fmt_list(avg)} AS scores, count(*) AS n_files FROM preds GROUP BY id"
    q["weighted_mean"] = f"""
WITH {PREDS}, {WEIGHTS}
SELECT id, {_fmt_list([f"sum(w * s{i}) / sum(w)" for i in range(N)])} AS scores
FROM preds JOIN weights USING (model) GROUP BY id"""
    bvals = " UNION ALL ".join(
        f"SELECT id, model, file_order, {i} AS p, CASE WHEN s{i} < 0.5 THEN 0 WHEN s{i} < 1.5 THEN 1 WHEN s{i} < 2.5 THEN 2 ELSE 3 END AS v FROM preds"
        for i in range(N))
    q["weighted_vote"] = f"""
WITH {PREDS}, {WEIGHTS},
votes AS ({bvals}),
tot AS (SELECT id, p, v, round(sum(w), 9) AS total, min(file_order) AS first
        FROM votes JOIN weights USING (model) GROUP BY id, p, v),
win AS (SELECT *, row_number() OVER (PARTITION BY id, p ORDER BY total DESC, first) AS rn FROM tot QUALIFY rn = 1)
SELECT id, string_agg(CAST(v AS VARCHAR), ',' ORDER BY p) AS scores FROM win GROUP BY id"""
    lw = (1.0, 0.5, 2.0, 1.0, 1.5, 0.25)
    q["weighted_vote_labels"] = q["weighted_vote"].replace(
        "round(sum(w), 9)", "round(sum(w * [" + ", ".join(f"{x}::DOUBLE" for x in lw) + "][p + 1]), 9)")
    q["rank_vote"] = RANK_VOTE
    q["ranked_roundtrip"] = RANK_VOTE
    clamped = [f"avg(greatest(0.0, least(3.0, s{i})))" for i in range(N)]
    q["fold_mean"] = f"WITH {PREDS} SELECT id, {_fmt_list(clamped)} AS scores FROM preds GROUP BY id"
    cells = " UNION ALL ".join(f"SELECT model, id, {i} AS p, s{i} AS v FROM preds" for i in range(N))
    q["model_corr"] = f"""
WITH {PREDS},
cells AS ({cells})
SELECT a.model AS model_a, b.model AS model_b, round(corr(a.v, b.v), 9) AS corr
FROM cells a JOIN cells b ON a.id = b.id AND a.p = b.p GROUP BY a.model, b.model"""
    q["align_files"] = f"""
WITH {PREDS}
SELECT a.id, {_fmt_list([f"a.s{i}" for i in range(N)])} AS m0, {_fmt_list([f"b.s{i}" for i in range(N)])} AS m1,
       {_fmt_list([f"c.s{i}" for i in range(N)])} AS m2
FROM preds a JOIN preds b ON a.id = b.id AND b.model = 'm1' JOIN preds c ON a.id = c.id AND c.model = 'm2'
WHERE a.model = 'm0'"""
    mean = f"mean AS (SELECT id, {_fmt_list(avg)} AS emotion FROM preds GROUP BY id)"
    q["fill_template"] = f"""
WITH {PREDS}, {mean}
SELECT l.doc_id AS id, mean.emotion FROM labels l LEFT JOIN mean ON mean.id = l.doc_id"""
    q["restore_order"] = f"""
WITH {PREDS}, {mean}
SELECT l.doc_id AS id, mean.emotion,
       row_number() OVER (ORDER BY md5(CAST(l.doc_id AS VARCHAR)), l.doc_id) AS position
FROM labels l LEFT JOIN mean ON mean.id = l.doc_id"""
    q["template_report"] = f"""
WITH {PREDS}, {mean},
pc AS (SELECT id, count(*) AS n FROM mean GROUP BY id)
SELECT count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS template_rows,
       count(*) FILTER (WHERE l.doc_id IS NOT NULL AND pc.id IS NULL) AS missing,
       count(*) FILTER (WHERE pc.n > 1) AS duplicated,
       count(*) FILTER (WHERE l.doc_id IS NULL) AS extra
FROM labels l FULL JOIN pc ON pc.id = l.doc_id"""

    sq = lambda i: f"pow(s{i} - t{i}, 2)"
    flat = f"sqrt(({' + '.join(f'sum({sq(i)})' for i in range(N))}) / (count(*) * {N}))"
    per = f"(({' + '.join(f'sqrt(avg({sq(i)}))' for i in range(N))}) / {N})"
    pairs = f"WITH {PREDS}, {TRUTH}, pr AS (SELECT * FROM preds JOIN truth USING (id))"
    q["metrics_rmse"] = f"""
{pairs}
SELECT model, round({flat}, 6) AS rmse_flat, round(1.0 / (1.0 + {flat}), 6) AS score_flat,
       round({per}, 6) AS rmse_per_label, round(1.0 / (1.0 + {per}), 6) AS score_per_label
FROM pr GROUP BY model"""
    same = " AND ".join(f"(CAST(t{i} >= 1.0 AS INTEGER) = CAST(s{i} >= 0.5 AS INTEGER))" for i in range(N))
    bce = " + ".join(f"sum(greatest(s{i}, 0.0) - s{i} * CAST(t{i} >= 1 AS DOUBLE) + ln(1 + exp(-abs(s{i}))))" for i in range(N))
    q["metrics_losses"] = f"""
{pairs}
SELECT model, round(avg(CAST({same} AS DOUBLE)), 6) AS exact_match,
       round(({' + '.join(f'sum({sq(i)})' for i in range(N))}) / (count(*) * {N}), 6) AS mse,
       round(({bce}) / (count(*) * {N}), 6) AS bce
FROM pr GROUP BY model"""
    cl = f"WITH {PREDS}, {TRUTH}, pc AS (SELECT model, id, " + ", ".join(
        f"greatest(0.0, least(3.0, s{i})) AS s{i}" for i in range(N)) + " FROM preds), pr AS (SELECT * FROM pc JOIN truth USING (id))"
    q["evaluate"] = f"""
{cl}
SELECT model, count(*) AS rows, round({flat}, 6) AS rmse_flat, round({per}, 6) AS rmse_per_label,
       round(1.0 / (1.0 + {flat}), 6) AS score, round(avg(CAST({same} AS DOUBLE)), 6) AS exact_match,
       round(({' + '.join(f'sum({sq(i)})' for i in range(N))}) / (count(*) * {N}), 6) AS mse
FROM pr GROUP BY model"""

    q["length_histogram"] = "SELECT CAST(floor(length(text) / 500) AS BIGINT) AS bucket, count(*) AS n FROM documents GROUP BY ALL"
    q["cut_share"] = """
SELECT round(avg(CAST(length(text) > 100 AS DOUBLE)), 6) AS cut_100, round(avg(CAST(length(text) > 110 AS DOUBLE)), 6) AS cut_110,
       round(avg(CAST(length(text) > 120 AS DOUBLE)), 6) AS cut_120, round(avg(CAST(length(text) > 128 AS DOUBLE)), 6) AS cut_128,
       round(avg(CAST(length(text) AS DOUBLE)), 6) AS mean_len, max(length(text)) AS max_len
FROM documents"""

    q["pending"] = f"""
WITH {LINES},
r AS (SELECT id, row_number() OVER (ORDER BY {h}, id) <= ceil(count(*) OVER () * 0.2) AS is_dev FROM parsed)
SELECT id FROM r WHERE NOT is_dev"""
    q["tsv_roundtrip"] = f"WITH {LINES} SELECT id, content, character, emotions FROM lines"
    digit = "substr(md5('r' || id), 1, 1)"
    q["line_rule"] = f"""
WITH {LINES}
SELECT id, coalesce(character, 'x') AS character,
       CASE WHEN {digit} >= '3' THEN coalesce(emotions, 'x') END AS emotions,
       {digit} >= '3' AND {digit} < '9' AS too_long,
       md5(content || chr(10) || '"x"' || chr(10)) AS content_md5
FROM lines"""
    broken = "substr(md5('q' || id), 1, 1)"
    q["quarantine"] = f"""
WITH {LINES}
SELECT CASE WHEN {broken} < '2' THEN replace(id, '_', '-') ELSE id END AS id,
       CASE WHEN {broken} < '2' OR {broken} = 'f' THEN 'quarantined' ELSE 'prepared' END AS part
FROM lines WHERE {broken} < '2' OR {broken} = 'f' OR substr(md5(id), 2, 1) >= '2'"""
    logits = [f"(avg(CAST(embedding[k * 24 + {i + 1}] AS DOUBLE) * 8))" for i in range(24)]
    hot24 = [f"CAST(1.0 / (1.0 + exp(-{x})) >= 0.5 AS INTEGER)" for x in logits]
    level = ", ".join("CASE " + " ".join(f"WHEN b{4 * e + lv} = 1 THEN {lv}" for lv in (3, 2, 1)) + " ELSE 0 END"
                      for e in range(N))
    q["decode24"] = f"""
WITH b AS (SELECT vec_id AS id, {', '.join(f'{x} AS b{i}' for i, x in enumerate(hot24))}
           FROM embeddings, generate_series(0, 1) t(k) GROUP BY vec_id)
SELECT id, 24 AS width, concat_ws(',', {', '.join(f'b{i}' for i in range(24))}) AS label24,
       concat_ws(',', {level}) AS levels
FROM b"""
    q["predictions_roundtrip"] = f"WITH {PREDS} SELECT model, id, {_fmt_list([f's{i}' for i in range(N)])} AS scores FROM preds"
    q["score_table"] = f"WITH {PREDS} SELECT id, {_fmt_list([f's{i}' for i in range(N)])} AS scores FROM preds WHERE model = 'm0'"
    return q
