"""Text operators: review cleaning, token frequencies, vocabularies, encode/decode,
language tagging, line pairing and a multinomial Naive Bayes built from counts.

All per-row work is built-in expressions (split/filter/transform); the only shuffles
are the aggregations and joins the operator needs.  Token joins may meet very hot
tokens; they run as shuffle joins with AQE skew splitting unless the planner finds the
small side's bytes under its broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators.indexing import dense_index, materialize

# Vocabulary specials and their indices.
SPECIALS = ("<unk>", "<pad>", "<bos>", "<eos>")
UNK_IDX = 0


def review_word_counts(df: DataFrame, id_col: str, text_col: str,
                       min_words_exclusive: int = 1) -> DataFrame:
    """L2: drop rows with null id/text, count whitespace words, keep > threshold."""
    # The count comes out of a one-element explode: a filter on a generator's output
    # stays above it, so the whole-text regex runs once per row instead of once for
    # the filter and again for the projection.
    counted = df.dropna(subset=[id_col, text_col]).select(
        "*", F.explode(F.array(tx.word_count(text_col))).alias("word_num"))
    return counted.where(F.col("word_num") > min_words_exclusive)


def token_frequencies(df: DataFrame, tokens: Column) -> DataFrame:
    """(token, count); partial aggregation collapses hot tokens map-side."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").count()


def build_vocabulary(freq: DataFrame, min_freq: int = 1,
                     specials: Sequence[str] = SPECIALS) -> DataFrame:
    """Specials take 0..len-1, then tokens by count descending, then token text."""
    spark = freq.sparkSession
    ranked = dense_index(freq.where(F.col("count") >= min_freq)
                             .where(~F.col("token").isin(list(specials))),
                         [F.col("count").desc(), F.col("token").asc()],
                         name="idx", start=len(specials))
    sp = spark.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, idx long")
    return ranked.select("token", "idx").unionByName(sp)


def vocabulary_head(freq: DataFrame, n: int, min_freq: int = 1,
                    specials: Sequence[str] = SPECIALS) -> DataFrame:
    """T4: the first ``n`` vocabulary entries, equal to ``build_vocabulary(...)`` filtered
    to idx < n, from a top-k (per-partition top n, then a merge of those) instead of
    numbering the whole vocabulary."""
    from pyspark.sql import Window
    spark = freq.sparkSession
    k = max(0, n - len(specials))
    order = [F.col("count").desc(), F.col("token").asc()]
    top = (freq.where(F.col("count") >= min_freq).where(~F.col("token").isin(list(specials)))
               .orderBy(*order).limit(k))
    # at most n rows: a window over them is small by construction
    ranked = top.select("token", (F.row_number().over(Window.orderBy(*order)) - 1
                                  + F.lit(len(specials))).cast("long").alias("idx"))
    sp = spark.createDataFrame([(t, i) for i, t in enumerate(specials) if i < n],
                               "token string, idx long")
    return ranked.unionByName(sp)


# Entries of the part of a vocabulary that is looked up inside the row.
HEAD = 1 << 16


def _looked_up(df: DataFrame, id_col: str, keys: Column, head: DataFrame, of_head, table: DataFrame) -> DataFrame:
    """(id, ``__values``): the value of every key in order, null for unknown ones, one row
    per row of ``df``.

    ``head`` (one row, column ``head``, of bounded size) holds the most frequent keys;
    ``of_head(head, key)`` reads it inside the row, without a join.  Only the other keys are
    exploded and joined with ``table`` (key, value); rows that have none do not move, and
    the others move as arrays of values."""
    rows = df.select(id_col, keys.alias("__keys"))
    rows = rows.withColumn("__head", head.select("head").scalar())
    rows = rows.select(id_col, "__keys", F.transform("__keys", lambda k: of_head(F.col("__head"), k)).alias("__values"))
    missing = F.filter(F.transform("__keys", lambda k, i: F.struct(i.alias("pos"), k.alias("key"))),
                       lambda s: F.get("__values", s["pos"]).isNull())
    # written once, so that the numbers of the rows hold in both reads below
    rows = materialize(rows.select(id_col, "__values", missing.alias("__missing"))
                           .withColumn("__row", F.monotonically_increasing_id()), "looked-up")
    some = F.coalesce(F.size("__missing"), F.lit(0)) > 0
    tail = (rows.where(some).select("__row", F.inline("__missing")).join(table, "key", "left")
                .groupBy("__row").agg(F.collect_list(F.struct("pos", "value")).alias("__tail")))
    known = F.filter(F.transform("__values", lambda v, i: F.struct(i.alias("pos"), v.alias("value"))), lambda s: s["value"].isNotNull())
    filled = F.transform(F.array_sort(F.concat(known, "__tail")), lambda s: s["value"])
    moved = rows.where(some).join(tail, "__row").select(id_col, filled.alias("__values"))
    return rows.where(~some).select(id_col, "__values").unionByName(moved)


def _slot(token: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(slots)).cast("int")


def encode(df: DataFrame, id_col: str, tokens: Column, vocab: DataFrame,
           as_text: bool = True, head: int = HEAD) -> DataFrame:
    """Token -> index with ``<unk>`` (0) for unknown words, order kept.

    Returns (id, n_tokens, n_unknown, ids) with ids as space-joined text, or as an array
    with ``as_text=False``.  A null or token-less text keeps its row with zero counts and
    no ids.  The vocabulary's head is a table of ``head`` slots, each with the most frequent
    token that hashes to it; only tokens outside it are joined.
    """
    best = vocab.groupBy(_slot(F.col("token"), head).alias("slot")).agg(F.min(F.struct("idx", "token")).alias("e"))
    slots = df.sparkSession.range(head).select(F.col("id").cast("int").alias("slot")).join(best, "slot", "left")
    table = slots.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "e"))), lambda s: s["e"]).alias("head"))

    def of_head(held: Column, t: Column) -> Column:
        e = F.get(held, _slot(t, head))
        return F.when(e["token"] == t, e["idx"])

    found = _looked_up(df, id_col, F.coalesce(tokens, F.array().cast("array<string>")), table, of_head,
                       vocab.select(F.col("token").alias("key"), F.col("idx").alias("value")))
    ids = F.transform("__values", lambda x: F.coalesce(x, F.lit(UNK_IDX)))
    unknown = F.size(F.filter("__ids", lambda x: x == UNK_IDX)).cast("long").alias("n_unknown")
    out = F.array_join(F.transform("__ids", lambda x: x.cast("string")), " ") if as_text else F.col("__ids")
    return (found.select(id_col, ids.alias("__ids"))
                 .select(id_col, F.size("__ids").cast("long").alias("n_tokens"), unknown, out.alias("ids")))


def decode(encoded: DataFrame, id_col: str, vocab: DataFrame, ids_col: str = "ids", head: int = HEAD) -> DataFrame:
    """Index -> token, order kept; returns (id, text).  ``ids_col`` holds an array
    or space-joined text; rows without ids decode to the empty text.  Indices below
    ``head`` are read from an array inside the row, only others are joined."""
    ids = F.col(ids_col)
    if dict(encoded.dtypes)[ids_col] == "string":
        ids = F.transform(F.filter(F.split(ids, " "), lambda x: x != ""), lambda x: x.cast("long"))
    first = vocab.where((F.col("idx") >= 0) & (F.col("idx") < head))
    places = encoded.sparkSession.range(head).withColumnRenamed("id", "idx").join(first, "idx", "left")
    table = places.agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "token"))), lambda s: s["token"]).alias("head"))

    def of_head(held: Column, i: Column) -> Column:
        return F.when((i >= 0) & (i < head), F.get(held, i.cast("int")))

    found = _looked_up(encoded, id_col, F.coalesce(ids, F.array().cast("array<long>")), table, of_head,
                       vocab.select(F.col("idx").alias("key"), F.col("token").alias("value")))
    return found.select(id_col, F.array_join("__values", " ").alias("text"))


# Short stop-word lists used to tag a text's language.
STOP_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "von",
           "mit", "sich", "auf", "dem", "für", "im", "auch", "es", "ich"),
    "en": ("the", "and", "of", "to", "is", "in", "it", "that", "with", "for", "as",
           "on", "by", "this", "be", "are", "was", "at", "or", "an"),
    "es": ("el", "los", "las", "y", "que", "una", "por", "con", "para", "es", "del",
           "se", "no", "lo", "su", "al", "como", "más", "pero", "sus"),
    "fr": ("le", "les", "des", "et", "est", "une", "du", "qui", "dans", "pour", "par",
           "sur", "avec", "au", "aux", "ce", "pas", "elle", "il", "ne"),
}
UNDETECTABLE = "undetectable"


def language_of(text_col: str | Column, stop_words: Mapping[str, Sequence[str]] = STOP_WORDS) -> Column:
    """The language with most stop-word hits among a text's letter tokens, ties by
    language code; no hit gives 'undetectable'.  A function of one row."""
    langs = sorted(stop_words)

    def hits_of(tokens: Column, words: Sequence[str]) -> Column:
        return F.coalesce(F.size(F.filter(tokens, lambda t: t.isin(*words))), F.lit(0))

    def best(tokens: Column) -> Column:
        hits = [hits_of(tokens, stop_words[k]) for k in langs]
        none = F.struct(F.lit(0).alias("h"), F.lit(0).alias("o"), F.lit(UNDETECTABLE).alias("lang"))
        return F.array_min(F.array(none, *[F.struct((-h).alias("h"), F.lit(1).alias("o"), F.lit(k).alias("lang"))
                                           for h, k in zip(hits, langs)]))

    # through a one-element array, so that the tokens are split once for all languages
    return F.transform(F.array(tx.letter_tokens(text_col)), best)[0]["lang"]


def tag_language(df: DataFrame, id_col: str, text_col: str,
                 stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
                 out: str = "language") -> DataFrame:
    """The rows of ``df`` with their language in place of the text; no shuffle."""
    keep = [c for c in df.columns if c not in (id_col, text_col)]
    return df.select(id_col, *keep, language_of(text_col, stop_words).alias(out))


# Sizes of the trained language model: code points are taken modulo CODES, so a pair of
# neighbouring characters is one of CODES^2 features; PER_LANGUAGE texts train a language.
CODES, PER_LANGUAGE, LOG_SCALE = 128, 200, 1000


def letter_pairs(text_col: str | Column) -> Column:
    """Numbers of the neighbouring characters of a text in lower case, runs of other
    characters than letters counting as one space; null for a null text."""
    plain = F.regexp_replace(F.lower(tx.as_col(text_col)), r"[^\p{L}]+", " ")
    codes = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.ascii(c) % CODES)
    # through a one-element array, so that the codes are found once
    return F.filter(F.transform(F.array(codes), lambda c: F.zip_with(c, F.slice(c, 2, F.greatest(F.size(c), F.lit(1))),
                                                                      lambda a, b: a * CODES + b))[0], lambda x: x.isNotNull())


def held_out_text(id_col: str | Column) -> Column:
    """Whether a row is kept for measuring: a quarter of all ids, by their md5."""
    return F.substring(F.md5(tx.as_col(id_col).cast("string")), 1, 1) < "4"


def language_model(df: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """L1: one row, ``model``: per language (in order) the log-probability of every
    character pair, in thousandths as whole numbers, with add-one-half smoothing.

    Learned from at most ``per_language`` labelled texts a language that are not held out
    (the smallest md5 of the id), so that fitting is bounded; the model has CODES^2 numbers
    a language.  Without labelled texts it is an empty list."""
    from pyspark.sql import Window
    key = F.md5(F.col(id_col).cast("string"))
    rows = df.select(id_col, F.col(lang_col).alias("lang"), text_col).where(
        F.col("lang").isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out_text(id_col))
    chosen = rows.withColumn("__n", F.row_number().over(
        Window.partitionBy("lang").orderBy(key, id_col, text_col))).where(F.col("__n") <= per_language)
    counts = materialize(chosen.select("lang", F.explode(letter_pairs(text_col)).alias("pair")).groupBy("lang", "pair").count(), "pairs")
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total"))
    every = totals.select("lang", "total", F.explode(F.sequence(F.lit(0), F.lit(CODES * CODES - 1))).alias("pair"))
    share = (F.coalesce(F.col("count"), F.lit(0)) + 0.5) / (F.col("total") + 0.5 * CODES * CODES)
    weights = every.join(counts, ["lang", "pair"], "left").select("lang", "pair", F.round(F.log(share) * LOG_SCALE).cast("int").alias("w"))
    lists = weights.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("pair", "w"))), lambda x: x["w"]).alias("w"))
    return lists.agg(F.array_sort(F.collect_list(F.struct("lang", "w"))).alias("model"))


def tag_by_model(df: DataFrame, text_col: str, model: DataFrame, out: str = "language") -> DataFrame:
    """``df`` with the language under which a text's character pairs are likeliest, ties
    by language code; a text without letters gives 'undetectable', as do all without a
    model.  Scored row by row against the model (a scalar subquery): no shuffle, no Python."""
    def best(pairs: Column, table: Column) -> Column:
        return F.array_min(F.transform(table, lambda m: F.struct(
            (-F.aggregate(pairs, F.lit(0).cast("long"), lambda s, i: s + F.get(m["w"], i))).alias("s"), m["lang"].alias("lang"))))

    found = F.transform(F.array(letter_pairs(text_col)), lambda pairs: best(pairs, F.col("__model")))[0]["lang"]
    tagged = F.when(F.col(text_col).rlike(r"\p{L}"), F.coalesce(found, F.lit(UNDETECTABLE))).otherwise(UNDETECTABLE)
    return df.withColumn("__model", model.select("model").scalar()).withColumn(out, tagged).drop("__model")


def next_turn_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text", src_role: str = "user",
                    tgt_role: str = "assistant") -> DataFrame:
    """Each ``src_role`` turn with the next turn when that one is ``tgt_role``.

    An equi-join on (conversation, turn + 1): no window over a conversation, so a
    huge conversation is spread over the join's partitions like any other key.
    Turns are consecutive integers per conversation.
    """
    src = turns.where(F.col(role) == src_role).select(
        conv, turn, F.col(text).alias("source"), (F.col(turn) + 1).alias("__next"))
    tgt = turns.where(F.col(role) == tgt_role).select(
        F.col(conv).alias("__c"), F.col(turn).alias("__next"), F.col(text).alias("target"))
    j = src.join(tgt, (src[conv] == tgt["__c"]) & (src["__next"] == tgt["__next"]))
    return j.select(conv, turn, "source", "target")


def targets_per_source(pairs: DataFrame, source: str = "source",
                       target: str = "target") -> DataFrame:
    """Number of distinct targets per source phrase (distinct pairs first, so a hot
    source is pre-aggregated instead of collected)."""
    return (pairs.select(source, target).distinct()
                 .groupBy(source).agg(F.count(F.lit(1)).alias("n_targets")))


def naive_bayes(train: DataFrame, label: str, tokens: Column, score: DataFrame,
                score_id: str, score_tokens: Column, classes: Sequence | None = None,
                smoothing: float = 1.0, head: int = HEAD) -> DataFrame:
    """Multinomial Naive Bayes from counts, add-one smoothing, unsmoothed priors.

    Training is one aggregation of per-token class counts, written once: the vocabulary
    size and the per-class token totals are scalar subqueries over that small table, the
    priors one over the labels.  Scoring joins tokens to their log-likelihood rows and sums
    per document.  The ``head`` most frequent tokens are broadcast, so that none of their
    occurrences moves or piles up in one task; only others shuffle to the rest of the
    model.  A text without known tokens is scored by the priors.  Tokens outside the
    training vocabulary are ignored; ties go to the smaller class.  Give ``classes`` to save
    a pass over the labels.
    """
    if classes is None:  # the class list is a handful of labels
        classes = sorted(r[0] for r in train.select(label).distinct().collect())
    k = len(classes)
    hit = [(F.col(label) == F.lit(c)).cast("long") for c in classes]
    # one scalar subquery per summary: documents per class, and (vocabulary size,
    # tokens per class); each is one aggregate evaluated once
    docs = train.select(F.struct(F.count(F.lit(1)).alias("n"),
                                 *[F.sum(h).alias(f"c{i}") for i, h in enumerate(hit)])).scalar()
    prior = [docs.getField(f"c{i}") / docs.getField("n") for i in range(k)]
    tok = train.select(label, F.explode(tokens).alias("token"))
    counts = materialize(tok.groupBy("token").agg(*[F.sum(h).alias(f"__n{i}") for i, h in enumerate(hit)]), "counts")
    tot = counts.select(F.struct(F.count(F.lit(1)).alias("v"),
                                 *[F.sum(f"__n{i}").alias(f"t{i}") for i in range(k)])).scalar()
    vsize = tot.getField("v")
    totals = [tot.getField(f"t{i}") for i in range(k)]
    model = counts.select("token", *[
        F.log((F.col(f"__n{i}") + F.lit(smoothing)) / (totals[i] + F.lit(smoothing) * vsize)).alias(f"__lp{i}")
        for i in range(k)])
    sums = [f"__lp{i}" for i in range(k)]
    frequent = F.broadcast(materialize(
        counts.withColumn("__n", sum(F.col(f"__n{i}") for i in range(k))).where(F.col("token").isNotNull())
              .orderBy(F.col("__n").desc(), "token").limit(head).select("token"), "frequent"))
    words = score.select(score_id, F.explode(score_tokens).alias("token"))
    parts = [words.join(F.broadcast(model.join(frequent, "token", "left_semi")), "token").select(score_id, *sums),
             words.join(frequent, "token", "left_anti").join(model.join(frequent, "token", "left_anti"), "token").select(score_id, *sums)]
    every = score.select(score_id, *[F.lit(None).cast("double").alias(c) for c in sums])
    scored = parts[0].unionByName(parts[1]).unionByName(every).groupBy(score_id).agg(
        *[F.sum(f"__lp{i}").alias(f"__s{i}") for i in range(k)])
    s = {i: F.coalesce(F.col(f"__s{i}"), F.lit(0.0)) + F.log(prior[i]) for i in range(k)}
    best = F.greatest(*s.values()) if k > 1 else s[0]
    pick = F.lit(classes[-1])
    for i in reversed(range(k)):
        pick = F.when(s[i] == best, F.lit(classes[i])).otherwise(pick)
    return scored.select(score_id, pick.alias("predicted"))
