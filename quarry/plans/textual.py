"""Registered text queries over ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import text as ops
from quarry.operators.indexing import materialize
from quarry.plans.registry import register
from quarry.sources.tables import load, load_spread


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# DuckDB spelling of the basic English rules (RE2 has no (?U); its \s is enough for
# the driver texts, which hold only spaces and newlines).
_DUCK_RULES = [(p.replace("(?U)", "").replace(r"\/", "/"), r) for p, r in tx.BASIC_ENGLISH_RULES]


def _duck_basic_english(col: str) -> str:
    s = f"lower({col})"
    for p, r in _DUCK_RULES:
        s = f"regexp_replace({s}, {_q(p)}, {_q(r)}, 'g')"
    return f"list_filter(regexp_split_to_array({s}, '\\s+'), lambda x: x <> '')"


def _duck_ws_tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '\\s+'), lambda x: x <> '')"


def _duck_letter_tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), '[^\\p{{L}}]+'), lambda x: x <> '')"


SPECIALS_SQL = ", ".join(f"({_q(t)}, {i})" for i, t in enumerate(ops.SPECIALS))
SPECIALS_IN = ", ".join(_q(t) for t in ops.SPECIALS)


@register("word_count_filter", r"""
SELECT doc_id, word_num, word_num > 10 AS above_10 FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_num
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
WHERE word_num > 1""")
def word_count_filter(spark, sf_dir):
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    r = ops.review_word_counts(d, "doc_id", "text", 1)
    return r.select("doc_id", F.col("word_num").cast("bigint").alias("word_num"),
                    (F.col("word_num") > 10).alias("above_10"))


def _token_freq_sql(where: str = "") -> str:
    return f"""SELECT token, count(*) AS "count" FROM (
  SELECT unnest({_duck_basic_english('text')}) AS token FROM documents {where}) GROUP BY token"""


@register("token_freq", _token_freq_sql())
def token_freq(spark, sf_dir):
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return ops.token_frequencies(d, tx.basic_english_tokens("text"))


def _vocab_sql(where: str = "") -> str:
    return f"""SELECT token, CAST(row_number() OVER (ORDER BY "count" DESC, token) + 3 AS BIGINT) AS idx
FROM ({_token_freq_sql(where)}) f WHERE token NOT IN ({SPECIALS_IN})
UNION ALL SELECT * FROM (VALUES {SPECIALS_SQL}) s(token, idx)"""


@register("vocab", _vocab_sql())
def vocab(spark, sf_dir):
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return ops.build_vocabulary(ops.token_frequencies(d, tx.basic_english_tokens("text")))


@register("vocab_top", f"SELECT token, idx FROM ({_vocab_sql()}) v WHERE idx < 10")
def vocab_top(spark, sf_dir):
    """T4: the first ten vocabulary entries."""
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return ops.vocabulary_head(ops.token_frequencies(d, tx.basic_english_tokens("text")), 10)


def _vocabulary(spark, sf_dir):
    """The vocabulary of all documents, written once: its readers need parts of it."""
    d = load_spread(spark, sf_dir, "documents", "text")
    return materialize(ops.build_vocabulary(ops.token_frequencies(d, tx.basic_english_tokens("text"))), "vocabulary")


_ENCODED_SQL = f"""WITH v AS ({_vocab_sql()}),
t AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
      FROM (SELECT doc_id, {_duck_basic_english('text')} AS toks FROM documents)),
e AS (SELECT t.doc_id, t.pos, coalesce(v.idx, 0) AS idx FROM t LEFT JOIN v USING (token))"""


@register("encode_texts", _ENCODED_SQL + """
SELECT d.doc_id, count(e.pos) AS n_tokens, count(CASE WHEN idx = 0 THEN 1 END) AS n_unknown,
       coalesce(string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY pos), '') AS ids
FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id""")
def encode_texts(spark, sf_dir):
    """J3 + L7: every document encoded with the vocabulary of all documents."""
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return ops.encode(d, "doc_id", tx.basic_english_tokens("text"), _vocabulary(spark, sf_dir))


@register("decode_texts", _ENCODED_SQL + """
SELECT d.doc_id, coalesce(string_agg(v.token, ' ' ORDER BY e.pos), '') AS text
FROM documents d LEFT JOIN e USING (doc_id) LEFT JOIN v USING (idx) GROUP BY d.doc_id""")
def decode_texts(spark, sf_dir):
    """J4 + L7: decode the encoded documents back to tokens."""
    v = _vocabulary(spark, sf_dir)
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    enc = ops.encode(d, "doc_id", tx.basic_english_tokens("text"), v, as_text=False)
    return ops.decode(enc, "doc_id", v)


@register("clean_text", r"""
SELECT doc_id, array_to_string(list_filter(list_transform(
         list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> ''),
         lambda w: regexp_replace(w, '[!-/:-@\[-`{-~]', '', 'g')),
       lambda w: regexp_matches(w, '^\p{L}+$')), ' ') AS clean
FROM documents""")
def clean_text(spark, sf_dir):
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", tx.clean_sentence("text").alias("clean"))


@register("truncate_315", f"""
SELECT doc_id, array_to_string(list_slice(toks, 1, 315), ' ') AS truncated FROM (
  SELECT doc_id, {_duck_ws_tokens('text')} AS toks FROM documents) WHERE len(toks) > 10""")
def truncate_315(spark, sf_dir):
    """T7 + F11: reviews above ten words, cut to their first 315 words."""
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    return (d.where(tx.word_count("text") > 10)
             .select("doc_id", tx.truncate_words("text", 315).alias("truncated")))


_PAIRS_OF = f"""list_transform(range(1, len(c)), lambda i: c[i] * {ops.CODES} + c[i + 1])"""
_CODES_OF = f"""list_transform(list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g'), ''), lambda x: x <> ''),
               lambda x: unicode(x) % {ops.CODES})"""
# per row: the pairs of characters; the model as one list per language; the likeliest
_LANG_SQL = f"""WITH chosen AS (
  SELECT lang, {_CODES_OF} AS c FROM documents
  WHERE lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL AND md5(CAST(doc_id AS VARCHAR))[1] >= '4'
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, text) <= {ops.PER_LANGUAGE}),
counts AS (SELECT lang, pair, count(*) AS n FROM (SELECT lang, unnest({_PAIRS_OF}) AS pair FROM chosen) GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
weights AS (SELECT lang, list(CAST(round(ln((coalesce(n, 0) + 0.5) / (total + {0.5 * ops.CODES ** 2})) * {ops.LOG_SCALE}) AS BIGINT) ORDER BY pair) AS w
  FROM totals CROSS JOIN (SELECT unnest(range({ops.CODES ** 2})) AS pair) LEFT JOIN counts USING (lang, pair) GROUP BY lang),
told AS (SELECT doc_id, lang AS said, n_chars, regexp_matches(text, '\\p{{L}}') AS any_letter, {_CODES_OF} AS c FROM documents),
scored AS (SELECT t.*, w.lang AS language, coalesce(list_sum(list_transform({_PAIRS_OF.replace('c[', 't.c[').replace('len(c)', 'len(t.c)')}, lambda p: w.w[p + 1])), 0) AS s
  FROM told t, weights w),
t AS (SELECT doc_id, said, n_chars, CASE WHEN any_letter THEN language ELSE '{ops.UNDETECTABLE}' END AS language FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, language) = 1)"""


def _tagged(spark, sf_dir, *more):
    """The documents with their language by the trained model."""
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text", "lang", *more)
    model = ops.language_model(load(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return ops.tag_by_model(d, "text", model).drop("text")


@register("lang_tag", _LANG_SQL + "\nSELECT doc_id, language FROM t")
def lang_tag(spark, sf_dir):
    """L1 + D2: the language of every document by character pairs, learned from the labels
    of documents that are not held out."""
    return _tagged(spark, sf_dir).select("doc_id", "language")


@register("lang_counts", _LANG_SQL + """\nSELECT language, count(*) AS "count" FROM t GROUP BY language""")
def lang_counts(spark, sf_dir):
    """L1 + A1: documents per detected language."""
    return lang_tag(spark, sf_dir).groupBy("language").count()


@register("english_only", _LANG_SQL + "\nSELECT doc_id, n_chars FROM t WHERE language = 'en'")
def english_only(spark, sf_dir):
    """L1 + F1: keep the documents tagged English."""
    return _tagged(spark, sf_dir, "n_chars").where(F.col("language") == "en").select("doc_id", "n_chars")


@register("lang_accuracy", _LANG_SQL + """
SELECT said AS lang, md5(CAST(doc_id AS VARCHAR))[1] < '4' AS held_out, count(*) AS docs,
       CAST(sum(CASE WHEN language = said THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       sum(CASE WHEN language = said THEN 1 ELSE 0 END) / count(*) AS accuracy
FROM t GROUP BY ALL""")
def lang_accuracy(spark, sf_dir):
    """L1 measured: per labelled language, held-out and other documents tagged with it."""
    hit = (F.col("language") == F.col("lang")).cast("long")
    return (_tagged(spark, sf_dir).groupBy("lang", ops.held_out_text("doc_id").alias("held_out"))
            .agg(F.count(F.lit(1)).alias("docs"), F.sum(hit).alias("correct"), (F.sum(hit) / F.count(F.lit(1))).alias("accuracy")))


_EN_STOPS_SQL = ", ".join(_q(w) for w in ops.STOP_WORDS["en"])


@register("stop_words_removed", f"""
SELECT doc_id, CAST(len(kept) AS BIGINT) AS n_kept, array_to_string(kept, ' ') AS kept_text FROM (
  SELECT doc_id, list_filter({_duck_letter_tokens('text')}, lambda t: NOT list_contains([{_EN_STOPS_SQL}], t)) AS kept
  FROM documents)""")
def stop_words_removed(spark, sf_dir):
    """L3: letter tokens without the English stop words; repeats of other words kept."""
    d = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    kept = d.select("doc_id", tx.remove_stop_words(tx.letter_tokens("text"), ops.STOP_WORDS["en"]).alias("k"))
    return kept.select("doc_id", F.size("k").cast("bigint").alias("n_kept"),
                       F.array_join("k", " ").alias("kept_text"))


_PAIRS_SQL = """SELECT u.conv_id, u.turn, u.text AS source, a.text AS target
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""


@register("line_pairs", _PAIRS_SQL)
def line_pairs(spark, sf_dir):
    return ops.next_turn_pairs(load(spark, sf_dir, "conversations"))


@register("targets_per_source", f"""
SELECT source, count(DISTINCT target) AS n_targets FROM ({_PAIRS_SQL}) GROUP BY source""")
def targets_per_source(spark, sf_dir):
    """Distinct replies per user text."""
    return ops.targets_per_source(line_pairs(spark, sf_dir))


@register("naive_bayes_counts", f"""
WITH tr AS (SELECT d.doc_id, l.quality AS label, {_duck_letter_tokens('d.text')} AS toks
            FROM documents d JOIN labels l USING (doc_id)),
pri AS (SELECT max(CASE WHEN label = 0 THEN c END) / sum(c) AS p0,
               max(CASE WHEN label = 1 THEN c END) / sum(c) AS p1
        FROM (SELECT label, count(*) AS c FROM tr GROUP BY label)),
tt AS (SELECT label, unnest(toks) AS token FROM tr),
cnt AS (SELECT token, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n0,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n1 FROM tt GROUP BY token),
tot AS (SELECT count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM cnt),
model AS (SELECT token, ln((n0 + 1) / (t0 + v)) AS lp0, ln((n1 + 1) / (t1 + v)) AS lp1 FROM cnt, tot),
st AS (SELECT doc_id, unnest({_duck_letter_tokens('text')}) AS token FROM documents),
sums AS (SELECT doc_id, sum(lp0) AS s0, sum(lp1) AS s1 FROM st JOIN model USING (token) GROUP BY doc_id),
sc AS (SELECT d.doc_id, coalesce(s0, 0) + ln(p0) AS a0, coalesce(s1, 0) + ln(p1) AS a1
       FROM documents d LEFT JOIN sums USING (doc_id), pri)
SELECT doc_id, CASE WHEN a0 >= a1 THEN 0 ELSE 1 END AS predicted FROM sc""")
def naive_bayes_counts(spark, sf_dir):
    """Train on the labelled documents (label = quality), predict every document."""
    docs = load_spread(spark, sf_dir, "documents", "doc_id", "text")
    train = docs.join(load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")),
                      "doc_id")
    return ops.naive_bayes(train, "label", tx.letter_tokens("text"), docs, "doc_id",
                           tx.letter_tokens("text"))
