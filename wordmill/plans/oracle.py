"""DuckDB oracle SQL, one statement per registered query (same column names).

The SQL is an independent, textbook formulation (global windows, plain joins) of
what the Spark operators compute in a distributed way.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Shared fragments -------------------------------------------------------------
WORD2 = r"[\p{L}\p{N}_]{2,}"

TFIDF_CTE = rf"""
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
ndoc AS (SELECT count(*) AS n FROM documents),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, df, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM dfs, ndoc),
wt AS (SELECT tf.doc_id, tf.term, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term)),
weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt)
"""

ORACLE["v7_tfidf"] = f"""
WITH {TFIDF_CTE}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""

ORACLE["k1_top_terms_per_doc"] = f"""
WITH {TFIDF_CTE},
ranked AS (SELECT doc_id, term, weight,
                  row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term ASC) AS rank
           FROM weights)
SELECT doc_id, rank, term, round(weight, 6) AS weight FROM ranked WHERE rank <= 20
"""


# ---------------------------------------------------------------- text: T1-T16

from wordmill.functions import fixed  # noqa: E402


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


NONWORD = r"[^\p{L}\p{N}_]+"
WS = (r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
STOP = sql_list(fixed.ENGLISH_STOPWORDS)


def positions(src: str, ids: str, list_expr: str, name: str = "token") -> str:
    return (f"SELECT {ids}, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS {name} "
            f"FROM (SELECT {ids}, {list_expr} AS l FROM {src})")


WORDS_LOWER = f"list_filter(string_split_regex(lower(text), '{NONWORD}'), lambda x: x <> '')"

ORACLE["t1_lower"] = "SELECT doc_id, lower(text) AS text_lower FROM documents"

ORACLE["t2_word_split"] = positions(
    "documents", "doc_id", f"list_filter(string_split_regex(text, '{NONWORD}'), lambda x: x <> '')")

ORACLE["t3_whitespace_tokens"] = positions(
    "documents", "doc_id", f"list_filter(string_split_regex(lower(text), '{WS}'), lambda x: x <> '')")

ORACLE["t4_abbr_or_lower"] = f"""
SELECT doc_id, pos, CASE WHEN regexp_matches(token, '^([A-Z]+[a-z]*){{2,}}') THEN token
                         ELSE lower(token) END AS word
FROM ({positions("documents", "doc_id",
                 f"list_filter(string_split_regex(text, '{NONWORD}'), lambda x: x <> '')")})
"""

ORACLE["t5_strip_non_word"] = f"""
SELECT doc_id, pos, regexp_replace(token, '{NONWORD}', '', 'g') AS word
FROM ({positions("documents", "doc_id",
                 f"list_filter(string_split_regex(text, '{WS}'), lambda x: x <> '')")})
"""

ORACLE["t6_ascii_letter_tokens"] = positions(
    "documents", "doc_id", f"list_filter({WORDS_LOWER}, lambda x: regexp_matches(x, '[a-zA-Z]'))")

ORACLE["t7_alpha_tokens"] = positions(
    "documents", "doc_id", f"list_filter({WORDS_LOWER}, lambda x: regexp_matches(x, '^\\p{{L}}+$'))")

ORACLE["t8_remove_stopwords"] = positions(
    "documents", "doc_id", f"list_filter({WORDS_LOWER}, lambda x: NOT list_contains({STOP}, x))")

DOC_TOKENS = positions("documents", "doc_id", WORDS_LOWER)
PLURAL_LEX = f"""
vocab AS (SELECT DISTINCT token FROM toks),
lex AS (SELECT v.token, substr(v.token, 1, length(v.token) - 1) AS base FROM vocab v
        WHERE regexp_matches(v.token, '[^s]s$') AND length(v.token) > 2
          AND substr(v.token, 1, length(v.token) - 1) IN (SELECT token FROM vocab))
"""

ORACLE["t9_lexicon_join"] = f"""
WITH toks AS ({DOC_TOKENS}), {PLURAL_LEX}
SELECT t.doc_id, t.pos, coalesce(lex.base, t.token) AS token
FROM toks t LEFT JOIN lex ON t.token = lex.token
"""

ORACLE["t10_preprocess"] = f"""
SELECT doc_id, array_to_string(list_filter(string_split_regex(lower(text), '{NONWORD}'),
    lambda x: regexp_matches(x, '[a-zA-Z]') AND regexp_matches(x, '^\\p{{L}}+$')
              AND NOT list_contains({STOP}, x)), ' ') AS tokens
FROM documents
"""

ORACLE["t10_preprocess_stem"] = f"""
WITH toks AS ({DOC_TOKENS}), {PLURAL_LEX},
mapped AS (
  SELECT t.doc_id, t.pos, coalesce(lex.base, t.token) AS token FROM toks t LEFT JOIN lex ON t.token = lex.token
  WHERE regexp_matches(t.token, '[a-zA-Z]') AND NOT list_contains({STOP}, t.token)),
kept AS (SELECT * FROM mapped WHERE NOT list_contains({STOP}, token) AND regexp_matches(token, '^\\p{{L}}+$'))
SELECT d.doc_id, coalesce(k.tokens, '') AS tokens
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS tokens FROM kept GROUP BY doc_id) k
ON d.doc_id = k.doc_id
"""

ORACLE["t10_preprocess_lemma"] = f"""
WITH toks AS ({DOC_TOKENS}), {PLURAL_LEX},
mapped AS (
  SELECT t.doc_id, t.pos, coalesce(lex.base, t.token) AS token0 FROM toks t LEFT JOIN lex ON t.token = lex.token),
cleaned AS (
  SELECT doc_id, pos, CASE WHEN regexp_matches(s, '^([A-Z]+[a-z]*){{2,}}') THEN s ELSE lower(s) END AS token
  FROM (SELECT doc_id, pos, regexp_replace(token0, '{NONWORD}', '', 'g') AS s FROM mapped)),
kept AS (SELECT * FROM cleaned WHERE NOT list_contains({STOP}, token) AND regexp_matches(token, '^\\p{{L}}+$'))
SELECT d.doc_id, coalesce(k.tokens, '') AS tokens
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS tokens FROM kept GROUP BY doc_id) k
ON d.doc_id = k.doc_id
"""

def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"

ORACLE["t11_clean_generated"] = f"""
SELECT conv_id, turn,
       replace(replace(lower({strip_ws('text')}), chr(10), ' '), chr(13), '') AS text_clean
FROM conversations
"""

ORACLE["t12_parse_reply"] = f"""
SELECT conv_id, turn, pos,
       CASE WHEN regexp_matches(r, '^[+-]?[0-9]+$') THEN TRY_CAST(r AS INTEGER) END AS prediction
FROM (SELECT conv_id, turn, pos, lower({strip_ws('reply')}) AS r
      FROM ({positions("conversations", "conv_id, turn",
                       f"list_filter(string_split_regex(text, '{WS}'), lambda x: x <> '')", "reply")}))
"""

BENCH_CLASSES = (f"SELECT item_id, text, unnest({sql_list(fixed.EMOTIONS)}) AS emotion "
                 f"FROM benchmark")
FIRST_WORD = r"SELECT item_id, lower(regexp_extract(text, '[\p{L}\p{N}_]+', 0)) AS emotion FROM benchmark"

ORACLE["t14_json_prompt"] = f"""
SELECT item_id, emotion,
       '{{"instruction": "{fixed.GENERATION_INSTRUCTION}", "emotion": ' || to_json(emotion)::VARCHAR
       || ', "notice": "{fixed.GENERATION_NOTICE}"}}' AS prompt
FROM ({FIRST_WORD})
"""

ORACLE["t15_plain_prompt"] = f"""
SELECT item_id, emotion, printf('{fixed.PLAIN_GENERATION_FORMAT}', emotion) AS prompt
FROM ({FIRST_WORD})
"""

ORACLE["t16_encode_ids"] = f"""
WITH toks AS ({DOC_TOKENS}),
vocab AS (SELECT token, row_number() OVER (ORDER BY token) AS id
          FROM (SELECT DISTINCT token FROM toks)),
ids AS (SELECT t.doc_id, t.pos, v.id FROM toks t JOIN vocab v USING (token) WHERE t.pos < {fixed.MAX_SEQ_LEN}),
grid AS (SELECT doc_id, unnest(generate_series(0, {fixed.MAX_SEQ_LEN - 1})) AS pos FROM documents)
SELECT g.doc_id, g.pos, coalesce(i.id, 0)::BIGINT AS input_id,
       CASE WHEN i.id IS NULL THEN 0 ELSE 1 END AS attention_mask
FROM grid g LEFT JOIN ids i ON g.doc_id = i.doc_id AND g.pos = i.pos
"""


# ---------------------------------------------------------------- sampling: M1-M9

SEED = fixed.BASELINE_SEED
SPLIT_SEED = f"{SEED}/split"


def h(seed, id_expr: str) -> str:
    return f"md5('{seed}:' || {id_expr})"


ORACLE["m1_sample_fraction"] = f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {h(SEED, 'doc_id::VARCHAR')}, doc_id) AS rn
           FROM documents)
SELECT doc_id, lang FROM r WHERE rn <= (SELECT round_even(0.45::DOUBLE * count(*), 0) FROM documents)
"""


def split_sql(src: str, cols: str, id_expr: str, share: float, seed, part_col: str = "part",
              names=("train", "valid")) -> str:
    return f"""
WITH r AS (SELECT {cols}, row_number() OVER (ORDER BY {h(seed, id_expr)}) AS rn FROM {src})
SELECT {cols}, CASE WHEN rn <= (SELECT ceil({share}::DOUBLE * count(*)) FROM {src})
                    THEN '{names[1]}' ELSE '{names[0]}' END AS {part_col}
FROM r
"""


ORACLE["m2_train_valid_split"] = split_sql(
    "(SELECT doc_id, lang AS label FROM documents)", "doc_id, label", "doc_id::VARCHAR",
    fixed.BASELINE_VALID_SHARE, SPLIT_SEED)

ORACLE["m3_split_composite_id"] = split_sql(
    "(SELECT conv_id, turn, role AS label FROM conversations)", "conv_id, turn, label",
    "conv_id::VARCHAR || ':' || turn::VARCHAR", fixed.PROMPT_VALID_SHARE, 7)


def stratified_sql(src: str, cols: str, label: str, id_expr: str, p: float, seed) -> str:
    return f"""
WITH c AS (SELECT {label} AS lab, count(*) AS k FROM {src} GROUP BY {label}),
t AS (SELECT lab, k, sum(k) OVER () AS n FROM c),
m AS (SELECT lab, k, n, n - ceil((1.0::DOUBLE - {p}::DOUBLE) * n) AS m FROM t),
e AS (SELECT lab, m, k * m / n AS ex, floor(k * m / n) AS f FROM m),
l AS (SELECT lab, f, ex - f AS r, m - sum(f) OVER () AS lft FROM e),
q AS (SELECT lab, f + CASE WHEN row_number() OVER (ORDER BY r DESC, lab ASC) <= lft THEN 1 ELSE 0 END AS q FROM l),
r AS (SELECT {cols}, row_number() OVER (PARTITION BY {label} ORDER BY {h(seed, id_expr)}) AS rn FROM {src})
SELECT {cols} FROM r JOIN q ON r.{label} = q.lab WHERE rn <= q.q
"""


ORACLE["m4_stratified_fraction"] = stratified_sql(
    "(SELECT doc_id, lang AS label FROM documents)", "doc_id, label", "label", "doc_id::VARCHAR",
    fixed.STRATIFIED_TEST_SHARE, SEED)

ORACLE["m4_approximate_fraction"] = f"""
SELECT doc_id, lang AS label FROM documents
WHERE ('0x' || substr({h(SEED, 'doc_id::VARCHAR')}, 1, 13))::BIGINT
      < CASE lang WHEN 'de' THEN 0.5::DOUBLE WHEN 'en' THEN 0.1::DOUBLE WHEN 'es' THEN 0.6::DOUBLE
                  WHEN 'fr' THEN 0.4::DOUBLE ELSE 0 END * 4503599627370496
"""

ORACLE["m5_per_class"] = f"""
SELECT vec_id, label FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {h(SEED, 'vec_id::VARCHAR')}) AS rn
  FROM embeddings) WHERE rn <= 32
"""

ORACLE["m6_first_n"] = f"""
SELECT vec_id, label FROM embeddings ORDER BY {h(SEED, 'vec_id::VARCHAR')} LIMIT 50
"""

SHARES = [0.05, 0.25, 0.45, 0.65, 0.85]
LADDER = ", ".join(f"{f}::DOUBLE" for f in SHARES)
ORACLE["m7_nested_ladder"] = f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {h(SEED, 'doc_id::VARCHAR')}) AS rn FROM documents),
f AS (SELECT unnest([{LADDER}]) AS percentage)
SELECT r.doc_id, f.percentage FROM r, f
WHERE rn <= (SELECT round_even(f.percentage * count(*), 0) FROM documents)
"""

ORACLE["m8_seeded_split"] = split_sql(
    "(SELECT doc_id, lang AS label FROM documents)", "doc_id, label", "doc_id::VARCHAR",
    fixed.GENERATED_TEST_SHARE, fixed.GENERATED_SPLIT_SEED, "split", ("train", "test"))

ORACLE["m9_realised_rate"] = f"""
WITH few AS (SELECT count(*) AS k FROM ({ORACLE["m5_per_class"]}))
SELECT round(32.0::DOUBLE / count(*), 6) AS percentage, round(any_value(few.k) / count(*), 6) AS labelled_share
FROM embeddings, few
"""


# ---------------------------------------------------------------- terms: V1-V15, A6, K2

T10_LIST = (f"list_filter(string_split_regex(lower(text), '{NONWORD}'), lambda x: regexp_matches(x, '[a-zA-Z]')"
            f" AND regexp_matches(x, '^\\p{{L}}+$') AND NOT list_contains({STOP}, x))")
CUSTOM = sql_list(fixed.CUSTOM_VOCAB)
VOCAB16 = f"""
t10 AS (SELECT doc_id, {T10_LIST} AS l FROM documents),
top10 AS (SELECT t, count(*) AS c FROM (SELECT unnest(l) AS t FROM t10) GROUP BY t ORDER BY c DESC, t ASC LIMIT 10),
vocab AS (SELECT unnest({CUSTOM}) AS term, unnest(range(0, {len(fixed.CUSTOM_VOCAB)})) AS idx
          UNION ALL
          SELECT t AS term, {len(fixed.CUSTOM_VOCAB) - 1} + row_number() OVER (ORDER BY c DESC, t ASC) AS idx FROM top10)
"""

ORACLE["v1_bag_of_words"] = f"""
WITH {VOCAB16}
SELECT doc_id, idx AS pos, term, len(list_filter(l, lambda x: x = term))::BIGINT AS n FROM t10, vocab
"""

WS_WORDS = f"""
w AS (SELECT unnest(list_filter(string_split_regex(lower(text), '{WS}'), lambda x: x <> '')) AS word FROM documents),
wc AS (SELECT word, count(*) AS n FROM w GROUP BY word),
wt AS (SELECT sum(n)::BIGINT AS total FROM wc)
"""

ORACLE["v2_word_frequency"] = f"""
WITH {WS_WORDS}
SELECT word, n, total FROM wc, wt
"""

V3_SQL = f"""
SELECT unnest({sql_list(fixed.ENGLISH_STOPWORDS + fixed.CONTRACTIONS)}) AS word
UNION
SELECT word FROM wc, wt WHERE n / total > {fixed.FREQUENCY_THRESHOLD}::DOUBLE
"""

ORACLE["v3_frequent_stopwords"] = f"WITH {WS_WORDS} {V3_SQL}"

ORACLE["v3_sketched_stopwords"] = ORACLE["v3_frequent_stopwords"]

ORACLE["v3_heavy_words"] = f"""
WITH {WS_WORDS}
SELECT word, n, total FROM wc, wt WHERE n / total > {fixed.FREQUENCY_THRESHOLD}::DOUBLE
"""

ORACLE["v4_extend_stopwords"] = f"""
WITH {WS_WORDS}
{V3_SQL}
UNION
SELECT unnest(list_filter(string_split_regex(lower(text), '{WS}'), lambda x: x <> '')) AS word FROM benchmark
"""

APOS = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
ORACLE["v6_class_top_words"] = f"""
WITH {WS_WORDS},
stop AS ({V3_SQL}),
words AS (SELECT lang AS label, unnest(list_filter(
             list_transform(regexp_extract_all(lower(text), '{APOS.replace("'", "''")}'), lambda t: regexp_replace(t, '''s$', '')),
             lambda t: NOT regexp_matches(t, '^\\p{{Nd}}+$'))) AS word FROM documents),
counts AS (SELECT label, word, count(*) AS n FROM words WHERE word NOT IN (SELECT word FROM stop) GROUP BY label, word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word ASC) AS rank FROM counts)
SELECT label, word, n, rank, round(n / max(n) OVER (PARTITION BY label), 6) AS weight FROM ranked WHERE rank <= 100
"""


def weights_sql(tf_src: str, idf_src: str, sublinear: bool = False) -> str:
    tfv = "(1 + ln(tf))" if sublinear else "tf"
    return f"""
wt AS (SELECT tf.doc_id, tf.term, {tfv} * idf.idf AS w FROM ({tf_src}) tf JOIN ({idf_src}) idf USING (term)),
weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt)
"""


M8_SPLIT = split_sql("(SELECT doc_id, text FROM documents)", "doc_id, text", "doc_id::VARCHAR",
                     fixed.GENERATED_TEST_SHARE, fixed.GENERATED_SPLIT_SEED, "split", ("train", "test"))
ORACLE["v8_transform_unseen"] = f"""
WITH s AS ({M8_SPLIT}),
toks AS (SELECT doc_id, split, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM s),
tf_all AS (SELECT doc_id, split, term, count(*) AS tf FROM toks GROUP BY ALL),
n AS (SELECT count(*) AS n FROM s WHERE split = 'train'),
idf AS (SELECT term, ln((n + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf_all, n
        WHERE split = 'train' GROUP BY term, n),
{weights_sql("SELECT doc_id, term, tf FROM tf_all WHERE split = 'test'", "SELECT * FROM idf")}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""

V9_CTE = f"""
tl AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{WORD2}'),
                                  lambda x: NOT list_contains({STOP}, x)) AS l FROM documents),
grams AS (SELECT doc_id, unnest(list_concat(l, list_transform(generate_series(1, len(l) - 1),
                                                             lambda i: l[i] || ' ' || l[i + 1]))) AS term FROM tl),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
cf AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
top AS (SELECT term, df FROM cf ORDER BY cf DESC, term ASC LIMIT 10),
ndoc AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM top, ndoc),
{weights_sql("SELECT * FROM tf", "SELECT * FROM idf")}
"""

ORACLE["v9_ngram_top_features"] = f"""
WITH {V9_CTE}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""

ORACLE["v9_sketched_features"] = ORACLE["v9_ngram_top_features"]

V15_SQL = f"""
WITH {V9_CTE},
grid AS (SELECT d.doc_id, t.term FROM documents d, top t)
SELECT g.doc_id, g.term, round(coalesce(w.weight, 0.0), 6) AS weight
FROM grid g LEFT JOIN weights w ON g.doc_id = w.doc_id AND g.term = w.term
"""
ORACLE["v15_melted_matrix"] = V15_SQL

ORACLE["v14_dense_matrix"] = f"""
WITH cells AS ({V15_SQL}),
pos AS (SELECT term, row_number() OVER (ORDER BY term) AS i FROM (SELECT DISTINCT term FROM cells))
SELECT doc_id, {", ".join(f"max(CASE WHEN i = {i} THEN weight END) AS t{i:02d}" for i in range(1, 11))}
FROM cells JOIN pos USING (term) GROUP BY doc_id
"""

V10_CTE = f"""
{VOCAB16},
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM documents),
tf0 AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
ndoc AS (SELECT count(*) AS n FROM documents),
dfs AS (SELECT v.idx, v.term, count(tf0.doc_id) AS df FROM vocab v LEFT JOIN tf0 USING (term) GROUP BY v.idx, v.term),
idf AS (SELECT idx, term, df, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM dfs, ndoc),
{weights_sql("SELECT * FROM tf0", "SELECT term, idf FROM idf")}
"""

ORACLE["v10_fixed_vocab_idf"] = f"""
WITH {V10_CTE}
SELECT idx::INTEGER AS idx, term, df::BIGINT AS df, round(idf, 6) AS idf FROM idf
"""

ORACLE["v10_fixed_vocab_weights"] = f"""
WITH {V10_CTE}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""

ORACLE["v11_pruned_sublinear"] = f"""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
ndoc AS (SELECT count(*) AS n FROM documents),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM dfs, ndoc
        WHERE df >= 2 AND df <= 0.8::DOUBLE * n),
{weights_sql("SELECT * FROM tf", "SELECT * FROM idf", sublinear=True)}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""

ORACLE["v8_merged_idf"] = f"""
WITH {TFIDF_CTE}
SELECT term, df, round(idf, 6) AS idf FROM idf
"""

ORACLE["v12_matrix_shape"] = f"""
WITH {TFIDF_CTE}
SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_terms FROM idf
"""

ORACLE["v13_sorted_vocabulary"] = f"""
WITH {TFIDF_CTE}
SELECT (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx, term FROM idf
"""

ORACLE["a6_term_totals"] = f"""
WITH {TFIDF_CTE}
SELECT term, round(sum(weight), 6) AS total_weight FROM weights GROUP BY term
"""

ORACLE["k2_top_terms_overall"] = f"""
WITH {TFIDF_CTE}
SELECT term, round(sum(weight), 6) AS total_weight FROM weights GROUP BY term
ORDER BY sum(weight) DESC, term ASC LIMIT 20
"""

ORACLE["k2_terms_in_reach"] = ORACLE["k2_top_terms_overall"]


# ---------------------------------------------------------------- metrics: A*, R*, K3, F*

def standin(seed, id_expr: str = "vec_id", label: str = "label") -> str:
    hx = f"('0x' || substr(md5('{seed}:' || {id_expr}::VARCHAR), 1, 8))::BIGINT"
    return (f"CASE WHEN {hx} % 13 = 0 THEN NULL WHEN {hx} % 10 < 6 THEN {label}::INTEGER "
            f"ELSE ({hx} % 10)::INTEGER END")


def weighted_sql(pred_src: str, by: list[str]) -> str:
    """(by..., f1, precision, recall, accuracy, n_invalid) from (by..., label, prediction)."""
    b = ", ".join(by)
    bc = (b + ", ") if by else ""
    on = " AND ".join([f"s.{k} IS NOT DISTINCT FROM x.{k}" for k in by] + ["s.label = x.label"])
    inv_on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM i.{k}" for k in by) or "TRUE"
    return f"""
WITH p AS ({pred_src}),
conf AS (SELECT {bc}label, prediction, count(*) AS c FROM p GROUP BY ALL),
sup AS (SELECT {bc}label, sum(c) AS sup FROM conf GROUP BY ALL),
tp AS (SELECT {bc}label, sum(c) AS tp FROM conf WHERE label = prediction GROUP BY ALL),
prd AS (SELECT {bc}prediction AS label, sum(c) AS prd FROM conf WHERE prediction IS NOT NULL GROUP BY ALL),
pc AS (SELECT s.*, coalesce(x.tp, 0) AS tp, coalesce(y.prd, 0) AS prd FROM sup s
       LEFT JOIN tp x ON {on}
       LEFT JOIN prd y ON {on.replace('x.', 'y.')}),
agg AS (SELECT {bc}sum(sup * 2.0 * tp / (sup + prd)) / sum(sup) AS f1,
               sum(sup * CASE WHEN prd = 0 THEN 0.0 ELSE tp / prd END) / sum(sup) AS precision,
               sum(sup * (tp / sup)) / sum(sup) AS recall,
               sum(tp) / sum(sup) AS accuracy
        FROM pc GROUP BY ALL),
inv AS (SELECT {bc}sum(c) AS n_invalid FROM conf WHERE prediction IS NULL GROUP BY ALL)
SELECT {', '.join('a.' + k for k in by) + ', ' if by else ''}
       round(a.f1, 6) AS f1, round(a.precision, 6) AS precision, round(a.recall, 6) AS recall,
       round(a.accuracy, 6) AS accuracy, coalesce(i.n_invalid, 0)::BIGINT AS n_invalid
FROM agg a LEFT JOIN inv i ON {inv_on}
"""


STANDIN = f"SELECT vec_id, label, {standin('standin')} AS prediction FROM embeddings"

ORACLE["a1_label_distribution"] = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"

ORACLE["a2_distinct_labels"] = f"SELECT DISTINCT label FROM ({ORACLE['m8_seeded_split']})"

ORACLE["a3_confusion"] = f"SELECT label, prediction, count(*) AS n FROM ({STANDIN}) GROUP BY ALL"

ORACLE["a4_weighted_metrics"] = weighted_sql(STANDIN, [])

CURVE_METHODS = ["baseline", "bert"]
POINT_METHODS = ["setfit", "zeroshot"]


def _case(methods) -> str:
    return "CASE " + " ".join(f"WHEN method = '{m}' THEN {standin(m)}" for m in methods) + " END"


CURVE_PREDS = f"""
SELECT vec_id, label, method, percentage, {_case(CURVE_METHODS)} AS prediction FROM (
  SELECT r.vec_id, r.label, f.percentage, unnest({sql_list(CURVE_METHODS)}) AS method
  FROM (SELECT vec_id, label, row_number() OVER (ORDER BY {h(SEED, 'vec_id::VARCHAR')}) AS rn FROM embeddings) r,
       (SELECT unnest([{LADDER}]) AS percentage) f
  WHERE rn <= (SELECT round_even(f.percentage * count(*), 0) FROM embeddings))
UNION ALL
SELECT vec_id, label, method, percentage, {_case(POINT_METHODS)} AS prediction FROM (
  SELECT vec_id, label, 32.0::DOUBLE / (SELECT count(*) FROM embeddings) AS percentage,
         unnest({sql_list(POINT_METHODS)}) AS method FROM embeddings)
"""

RESULTS_WIDE = weighted_sql(CURVE_PREDS, ["method", "percentage"])
ORACLE["a5_metrics_by_method"] = f"""
SELECT method, round(percentage, 6) AS percentage, f1, precision, recall, accuracy, n_invalid
FROM ({RESULTS_WIDE})
"""

RESULTS_LONG = f"""
SELECT method, percentage, metric, value FROM ({RESULTS_WIDE})
UNPIVOT (value FOR metric IN (f1, precision, recall, accuracy))
"""


def r6_long(src: str) -> str:
    return f"SELECT method, round(percentage, 6) AS percentage, metric, round(value, 6) AS value FROM ({src})"


ORACLE["r1_to_long"] = r6_long(RESULTS_LONG)
ORACLE["r3_stack_methods"] = r6_long(RESULTS_LONG)

SCALED = f"""
SELECT method, CASE WHEN max(percentage) OVER (PARTITION BY method) <= 1 THEN percentage * 100.0
                    ELSE percentage END AS percentage, metric, value
FROM ({RESULTS_LONG})
"""
ORACLE["r2_percent_scale"] = r6_long(SCALED)
ORACLE["k3_sort_results"] = r6_long(SCALED)

GRID = ", ".join(f"{float(g)}::DOUBLE" for g in range(0, 101, 10))
ORACLE["r4_extend_single_points"] = r6_long(f"""
WITH s AS (SELECT *, count(*) OVER (PARTITION BY method, metric) AS pts FROM ({SCALED}))
SELECT method, percentage, metric, value FROM s WHERE pts > 1
UNION ALL
SELECT method, unnest([{GRID}]) AS percentage, metric, value FROM s WHERE pts = 1
""")

CONV_WS = WS_WORDS.replace("FROM documents", "FROM conversations")
ORACLE["r5_union_stopwords"] = f"""
WITH {WS_WORDS} {V3_SQL}
UNION
SELECT * FROM (WITH {CONV_WS} {V3_SQL})
"""

ORACLE["a7_max_percentage"] = f"""
SELECT method, round(max(percentage), 6) AS max_percentage FROM ({RESULTS_LONG}) GROUP BY method
"""

ORACLE["a8_metric_names"] = f"SELECT DISTINCT metric FROM ({RESULTS_LONG})"

ORACLE["f6_filter_metric"] = r6_long(f"SELECT * FROM ({RESULTS_LONG}) WHERE metric = 'f1'")

ORACLE["f7_invalid_predictions"] = f"""
SELECT label, sum(CASE WHEN prediction IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_invalid, count(*) AS n
FROM ({STANDIN}) GROUP BY label
"""

ORACLE["f1_rows_of_class"] = "SELECT doc_id, lang AS label FROM documents WHERE lang = 'de'"
ORACLE["f2_declared_classes"] = "SELECT doc_id, lang AS label FROM documents WHERE lang IN ('en', 'de', 'es')"
ORACLE["f3_project_text_label"] = "SELECT doc_id, text, lang AS label FROM documents"

NAMES_MAP = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in fixed.LABEL_NAMES.items()) + "}"
CODES_MAP = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in fixed.EMOTION_CODES.items()) + "}"
ORACLE["f4_code_to_name"] = f"""
SELECT doc_id, quality * 2 + toxic AS code, {NAMES_MAP}[quality * 2 + toxic] AS name FROM labels
"""
ORACLE["f5_name_to_code"] = f"""
SELECT doc_id, name, {CODES_MAP}[name] AS code
FROM (SELECT doc_id, lower({NAMES_MAP}[quality * 2 + toxic]) AS name FROM labels)
"""


# ---------------------------------------------------------------- sources: S1, S2, S4-S8

ORACLE["s1_read_split"] = f"SELECT doc_id, label, split FROM ({ORACLE['m8_seeded_split']}) WHERE split = 'test'"

ORACLE["s2_injected_dataset"] = f"""
SELECT conv_id, turn, label, split FROM ({split_sql(
    "(SELECT conv_id, turn, role AS label FROM conversations)", "conv_id, turn, label",
    "conv_id::VARCHAR || ':' || turn::VARCHAR", fixed.PROMPT_VALID_SHARE, 7, "split", ("train", "test"))})
WHERE split = 'train'
"""

ORACLE["s4_s5_csv_roundtrip"] = ORACLE["r1_to_long"]
ORACLE["s6_materialize"] = ORACLE["a1_label_distribution"]
ORACLE["s7_keyed_output"] = f"SELECT * FROM ({ORACLE['r1_to_long']}) WHERE method = 'bert'"
ORACLE["s8_preview"] = f"""
SELECT doc_id, label FROM ({ORACLE['m8_seeded_split']}) WHERE split = 'train' ORDER BY doc_id LIMIT 5
"""


# ---------------------------------------------------------------- learning and jobs: L6, L7, L10-L12, T13

ORACLE["l1_features"] = f"""
WITH parts AS ({split_sql("(SELECT doc_id, text FROM documents)", "doc_id, text", "doc_id::VARCHAR",
                          fixed.BASELINE_VALID_SHARE, SPLIT_SEED)}),
tr AS (SELECT doc_id, text FROM parts WHERE part = 'train'),
{TFIDF_CTE.replace("FROM documents", "FROM tr")}
SELECT doc_id, term, round(weight, 6) AS weight FROM weights
"""


def curve_parts_sql(src: str, ids: str, id_expr: str, weights: bool = False) -> str:
    """Rows of every share of the ladder in hash order, the first fifth of them (in the
    order of a second hash) for validation."""
    w = ("sum(1.0::DOUBLE) OVER (PARTITION BY " + ids + " ORDER BY percentage) AS weight, ") if weights else ""
    return f"""
WITH r AS (SELECT {ids}, row_number() OVER (ORDER BY {h(SEED, id_expr)}) AS rn, {h(SPLIT_SEED, id_expr)} AS h2,
                  count(*) OVER () AS n FROM {src}),
f AS (SELECT unnest([{LADDER}]) AS percentage),
s AS (SELECT {ids}, percentage, row_number() OVER (PARTITION BY percentage ORDER BY h2) AS rv,
             count(*) OVER (PARTITION BY percentage) AS q FROM r, f WHERE rn <= round_even(percentage * n, 0))
SELECT {ids}, percentage, {w}
       CASE WHEN rv <= ceil({fixed.BASELINE_VALID_SHARE}::DOUBLE * q) THEN 'valid' ELSE 'train' END AS part FROM s
"""


ORACLE["l2_curve_parts"] = curve_parts_sql("(SELECT doc_id FROM documents JOIN labels USING (doc_id))", "doc_id", "doc_id::VARCHAR")
ORACLE["l3_curve_parts"] = curve_parts_sql("conversations", "conv_id, turn", "conv_id::VARCHAR || ':' || turn::VARCHAR")
ORACLE["l9_cumulative_weights"] = curve_parts_sql("documents", "doc_id", "doc_id::VARCHAR", weights=True)

def naive_bayes_sql(train: str, valid: str, by: str = "") -> str:
    """Predictions ``(row, label, predicted, [by])`` for valid ``(row, label, text, [by])`` from
    train ``(label, text, w, [by])``; ``by`` separates models."""
    b, u = (f"{by}, ", f"({by}, ") if by else ("", "(")
    using = f"USING ({by})" if by else "ON TRUE"
    return f"""
SELECT row, label, predicted{", " + by if by else ""} FROM (
WITH tr AS ({train}), va AS ({valid}),
tk AS (SELECT {b}label, w, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM tr),
cn AS (SELECT {b}label, term, sum(w) AS n FROM tk GROUP BY ALL),
vs AS (SELECT {b}count(DISTINCT term) AS v FROM cn {"GROUP BY " + by if by else ""}),
ws AS (SELECT {b}label, sum(w) AS rw FROM tr GROUP BY ALL),
tt AS (SELECT {b}sum(rw) AS total FROM ws {"GROUP BY " + by if by else ""}),
ns AS (SELECT {b}label, sum(n) AS tokens FROM cn GROUP BY ALL),
cl AS (SELECT ws.*, ln(rw / total) AS prior, ln(coalesce(tokens, 0) + v) AS size
       FROM ws JOIN tt {using} JOIN vs {using} LEFT JOIN ns USING {u}label)),
vt AS (SELECT {b}row, term, count(*)::DOUBLE AS tf
       FROM (SELECT {b}row, unnest(regexp_extract_all(lower(text), '{WORD2}')) AS term FROM va) GROUP BY ALL),
kn AS (SELECT DISTINCT {b}term FROM cn),
us AS (SELECT vt.* FROM vt JOIN kn USING {u}term)),
tot AS (SELECT {b}row, sum(tf) AS used FROM us GROUP BY ALL),
gn AS (SELECT {b}row, cn.label AS cls, sum(tf * ln(n + 1)) AS gain FROM us JOIN cn USING {u}term) GROUP BY ALL),
sc AS (SELECT va.row, va.label, {"va." + b if by else ""}cl.label AS cls,
              round(cl.prior + coalesce(gn.gain, 0) - coalesce(tot.used, 0) * cl.size, 6) AS score
       FROM va JOIN cl {using} LEFT JOIN tot USING {u}row)
       LEFT JOIN gn ON gn.row = va.row AND gn.cls = cl.label {f"AND gn.{by} = va.{by}" if by else ""}),
best AS (SELECT *, row_number() OVER (PARTITION BY {b}row ORDER BY score DESC, cls) AS rn FROM sc)
SELECT row, label, cls AS predicted{", " + by if by else ""} FROM best WHERE rn = 1)
"""


def naive_bayes_curve_sql(src: str, ids: str, id_expr: str, cumulative: bool = False) -> str:
    """The metrics of a curve over ``src`` ``(ids, text, label)``."""
    parts = curve_parts_sql(f"(SELECT {ids} FROM {src})", ids, id_expr, weights=True)
    rows = f"SELECT {id_expr} AS row, text, label, percentage, part, weight FROM ({parts}) JOIN {src} USING ({ids})"
    w = "weight" if cumulative else "1.0::DOUBLE"
    preds = naive_bayes_sql(f"SELECT label, text, percentage, {w} AS w FROM ({rows}) WHERE part = 'train'",
                            f"SELECT row, label, text, percentage FROM ({rows}) WHERE part = 'valid'", "percentage")
    wide = weighted_sql(f"SELECT percentage, label, predicted AS prediction FROM ({preds})", ["percentage"])
    return f"""
SELECT round(percentage, 6) AS percentage, metric, round(value, 6) AS value
FROM (SELECT * EXCLUDE (n_invalid) FROM ({wide})) UNPIVOT (value FOR metric IN (f1, precision, recall, accuracy))
"""


QUALITY_DOCS = "(SELECT doc_id, text, quality::VARCHAR AS label FROM documents JOIN labels USING (doc_id))"
ORACLE["l2_curve_naive_bayes"] = naive_bayes_curve_sql(QUALITY_DOCS, "doc_id", "doc_id::VARCHAR")
ORACLE["l3_curve_naive_bayes"] = naive_bayes_curve_sql(
    "(SELECT conv_id, turn, text, role AS label FROM conversations)", "conv_id, turn", "conv_id::VARCHAR || ':' || turn::VARCHAR")
ORACLE["l9_cumulative_naive_bayes"] = naive_bayes_curve_sql(
    "(SELECT doc_id, text, lang AS label FROM documents)", "doc_id", "doc_id::VARCHAR", cumulative=True)
SIDED = "SELECT doc_id AS row, lang AS label, text, 1.0::DOUBLE AS w FROM documents WHERE substr(md5(source), 1, 1)"
ORACLE["l4_naive_bayes_predictions"] = f"""
SELECT row AS doc_id, label, predicted FROM ({naive_bayes_sql(f"{SIDED} < '8'", f"{SIDED} >= '8'")})
"""

ORACLE["l4_sides"] = """
SELECT substr(md5(source), 1, 1) < '8' AS fitted, lang AS label, count(*) AS n FROM documents GROUP BY ALL
"""

HALVES = split_sql("embeddings", "vec_id, label", "vec_id::VARCHAR", fixed.FEW_SHOT_VALID_SHARE, SPLIT_SEED)
ORACLE["l5_few_shot_parts"] = f"""
WITH s AS ({HALVES}),
t AS (SELECT *, row_number() OVER (PARTITION BY label, part ORDER BY {h(SEED, 'vec_id::VARCHAR')}) AS rn FROM s)
SELECT vec_id, label, part FROM t WHERE part = 'valid' OR rn <= 32
"""

ORACLE["l8_stratified_parts"] = " UNION ALL ".join(
    f"SELECT doc_id, label, {f}::DOUBLE AS percentage FROM (" + stratified_sql(
        f"(SELECT doc_id, label FROM ({ORACLE['m8_seeded_split']}) WHERE split = 'train')", "doc_id, label", "label",
        "doc_id::VARCHAR", f, SEED) + ")" for f in SHARES)

ORACLE["l12_disagreement"] = f"""
SELECT {standin('baseline')} AS pred_a, {standin('bert')} AS pred_b, count(*) AS n FROM embeddings GROUP BY ALL
"""

ORACLE["l6_contrastive_pairs"] = f"""
WITH few AS ({ORACLE['m5_per_class']}),
x AS (SELECT vec_id AS id, label AS lab,
             row_number() OVER (PARTITION BY label ORDER BY {h(SEED, 'vec_id::VARCHAR')}) - 1 AS r FROM few),
sz AS (SELECT lab, count(*) AS m FROM x GROUP BY lab),
offs AS (SELECT lab, m, (sum(m) OVER (ORDER BY lab ROWS UNBOUNDED PRECEDING) - m)::BIGINT AS o,
             (sum(m) OVER ())::BIGINT AS n FROM sz),
xx AS (SELECT x.*, m, o, n, o + r AS g FROM x JOIN offs USING (lab)),
pa AS (SELECT *, unnest(generate_series(1, least({fixed.CONTRASTIVE_ITERATIONS}, m - 1))) AS j FROM xx WHERE m > 1),
-- all rows of other classes, counted on from the end of the anchor's own block
other AS (SELECT a.id AS a_id, b.id AS b_id, a.n - a.m AS c, (b.g - a.o - a.m + a.n) % a.n AS p,
                 ('0x' || substr({h(SEED, 'a.id::VARCHAR')}, 1, 8))::BIGINT AS start
          FROM xx a JOIN xx b ON a.lab <> b.lab),
hop AS (SELECT *, (p - start % c + c) % c AS d, greatest(c // {fixed.CONTRASTIVE_ITERATIONS}, 1) AS step FROM other)
SELECT pa.id AS a_id, b.id AS b_id, true AS similar FROM pa JOIN xx b ON b.lab = pa.lab AND b.r = (pa.r + pa.j) % pa.m
UNION ALL
SELECT a_id, b_id, false AS similar FROM hop
WHERE d % step = 0 AND d // step < least({fixed.CONTRASTIVE_ITERATIONS}, c)
"""

ORACLE["l6_pair_properties"] = f"""
WITH few AS ({ORACLE['m5_per_class']}),
sz AS (SELECT label, count(*) AS m, sum(count(*)) OVER () AS n, count(*) OVER () AS c FROM few GROUP BY label)
SELECT vec_id AS a_id, least({fixed.CONTRASTIVE_ITERATIONS}, m - 1)::BIGINT AS positives,
       least({fixed.CONTRASTIVE_ITERATIONS}, n - m)::BIGINT AS negatives, (c - 1)::BIGINT AS classes
FROM few JOIN sz USING (label)
"""

ORACLE["l5_pair_scatter"] = f"""
WITH p AS ({ORACLE["l6_contrastive_pairs"]}),
d AS (SELECT p."similar" AS kind, list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) AS v
      FROM p JOIN embeddings a ON a.vec_id = p.a_id JOIN embeddings b ON b.vec_id = p.b_id)
SELECT kind AS "similar", i::INTEGER AS i, j::INTEGER AS j, round(sum(v[i + 1] * v[j + 1]), 6) AS value
FROM d, range(64) r(i), range(64) s(j) WHERE i <= j GROUP BY kind, i, j
"""

ORACLE["l7_score_model"] = """
WITH cell AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) r(i)),
mean AS (SELECT label AS c, i, avg(x) AS m FROM cell GROUP BY label, i),
score AS (SELECT vec_id, cell.label, c, sum(x * m) AS s FROM cell JOIN mean USING (i) GROUP BY vec_id, cell.label, c)
SELECT vec_id, label, c::INTEGER AS prediction FROM score
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) = 1
"""

ORACLE["l7_score_batches"] = """
SELECT vec_id, label, (list_position(s, list_max(s)) - 1)::INTEGER AS prediction
FROM (SELECT vec_id, label, list_transform(range(0, 10), lambda c:
  list_sum(list_transform(list_filter(range(0, len(embedding)), lambda i: i % 10 = c), lambda i: embedding[i + 1]::DOUBLE))) AS s FROM embeddings)
"""


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


HEADER = "\n\n".join(f"{k}: {v}" for k, v in fixed.PROMPT_BLOCKS)
LANG_CASE = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END"
PROMPTS = f"""
WITH s AS ({split_sql(f"(SELECT doc_id, text, {LANG_CASE} AS label FROM documents)", "doc_id, text, label",
                      "doc_id::VARCHAR", fixed.PROMPT_VALID_SHARE, 7)}),
few AS (SELECT * FROM s WHERE part = 'train' ORDER BY {h(SEED, 'doc_id::VARCHAR')} LIMIT 32),
block AS (SELECT coalesce(string_agg('Text: ' || text || chr(10) || 'Emotion: ' || label::VARCHAR || chr(10) || chr(10),
                                     '' ORDER BY {h(SEED, 'doc_id::VARCHAR')}), '') AS b FROM few),
prompts AS (SELECT doc_id, label,
                   {sql_str(HEADER)} || CASE WHEN b <> '' THEN {sql_str(fixed.PROMPT_EXAMPLES_HEADER)} || b ELSE '' END
                   || {sql_str(fixed.PROMPT_ITEM_FORMAT[0])} || text || {sql_str(fixed.PROMPT_ITEM_FORMAT[1])} AS prompt
            FROM s, block WHERE part = 'valid')
"""

ORACLE["t13_classification_prompt"] = f"{PROMPTS} SELECT doc_id, prompt FROM prompts"

CLASSIFIED = f"""
{PROMPTS},
replies AS (SELECT doc_id, label, CASE WHEN length(prompt) % 9 = 0 THEN 'joy'
                                       ELSE ' ' || (length(prompt) % 7)::VARCHAR || ' ' END AS reply FROM prompts)
SELECT doc_id, label, reply, CAST(NULL AS VARCHAR) AS error,
       CASE WHEN regexp_matches(lower({strip_ws('reply')}), '^[+-]?[0-9]+$')
            THEN TRY_CAST(lower({strip_ws('reply')}) AS INTEGER) END AS prediction
FROM replies
"""
ORACLE["l10_prompt_classify"] = CLASSIFIED
ORACLE["l10_prompt_metrics"] = weighted_sql(f"SELECT label, prediction FROM ({CLASSIFIED})", [])

ORACLE["l11_generate"] = f"""
SELECT item_id, emotion, sample::INTEGER AS sample,
       replace(replace(lower({strip_ws("' ' || text || chr(13) || chr(10) || emotion || ' '")}), chr(10), ' '),
               chr(13), '') AS text,
       emotion AS label, CAST(NULL AS VARCHAR) AS error
FROM ({BENCH_CLASSES}), (SELECT unnest([0, 1]) AS sample)
"""
