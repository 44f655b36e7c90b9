"""Registered queries: text cleaning, n-grams, bag of words, TF-IDF, phrases, dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import prompts
from opinara.functions import text as tx
from opinara.functions.resources import KEPT_NEGATIONS, NOUN_SUFFIXES
from opinara.operators import features, phrases
from opinara.operators.augment import generated_id
from opinara.operators.lemmas import lemma_table
from opinara.plans import sqltext as sq
from opinara.plans.sqltext import RATED, REVIEWS
from opinara.sources.tables import rated_reviews, reviews

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return keep


# Reviews with an emoji, short forms, numbers, accents and plurals added in words that depend on the score.
_GOOD = " \U0001f600 I'm sure it's the best! Don't change 123 things."
_BAD = " \U0001f620 It won't start, I can't log in. They've lost 7 songs."
_PLAIN = " \U0001f610 We'll see; he'd say ÁRBOL y ñandú. Classes, buses and stories."
_MARKED_SQL = (
    "marked AS (SELECT row_id, concat(review, CASE WHEN score >= 4 THEN '{0}' WHEN score <= 2 THEN '{1}' ELSE '{2}' END) AS review FROM reviews)"
).format(*[t.replace("'", "''") for t in (_GOOD, _BAD, _PLAIN)])


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    tail = F.when(F.col("score") >= 4, _GOOD).when(F.col("score") <= 2, _BAD).otherwise(_PLAIN)
    return reviews(spark, folder).select("row_id", F.concat("review", tail).alias("review"))


def _text(spark: SparkSession, folder: str, value: Column) -> DataFrame:
    return _marked(spark, folder).select("row_id", value.alias("value"))


def _text_sql(value: str) -> str:
    return f"WITH {REVIEWS}, {_MARKED_SQL} SELECT row_id, {value} AS value FROM marked"


_EMOJI_SQL = (
    "replace(replace(replace(review, '\U0001f600', ':grinning_face:'), '\U0001f620', ':angry_face:'), '\U0001f610', ':neutral_face:')"
)



@query(_text_sql(_EMOJI_SQL))
def demojize(spark, folder):
    return _text(spark, folder, tx.demojize(F.col("review")))


@query(_text_sql(sq.contractions("review")))
def expand_contractions(spark, folder):
    return _text(spark, folder, tx.expand_contractions(F.col("review")))


@query(_text_sql("lower(review)"))
def lowercase(spark, folder):
    return _text(spark, folder, F.lower("review"))


@query(_text_sql(f"array_to_string({sq.WORDS_EMOJI.format(_EMOJI_SQL)}, ' ')"))
def tokenize_words_emoji(spark, folder):
    return _text(spark, folder, F.array_join(tx.tokenize_words_emoji(tx.demojize(F.col("review"))), " "))


@query(_text_sql(f"array_to_string({sq.WORDS.format('review')}, ' ')"))
def tokenize_words(spark, folder):
    return _text(spark, folder, F.array_join(tx.tokenize_words(F.col("review")), " "))


_LOWER_WORDS = sq.WORDS.format("lower(review)")


@query(_text_sql(f"array_to_string({sq.NO_NUMBERS.format(_LOWER_WORDS)}, ' ')"))
def drop_numeric_tokens(spark, folder):
    return _text(spark, folder, F.array_join(tx.drop_numeric(tx.tokenize_words(F.lower("review"))), " "))


@query(_text_sql(f"array_to_string({sq.no_stopwords(_LOWER_WORDS, KEPT_NEGATIONS)}, ' ')"))
def remove_stopwords_keep_neg(spark, folder):
    return _text(spark, folder, F.array_join(tx.remove_stopwords_keep_negation(tx.tokenize_words(F.lower("review"))), " "))


@query(_text_sql(f"array_to_string({sq.no_stopwords(_LOWER_WORDS)}, ' ')"))
def remove_stopwords(spark, folder):
    return _text(spark, folder, F.array_join(tx.remove_stopwords(tx.tokenize_words(F.lower("review"))), " "))


@query()
def remove_stopwords_spanish(spark, folder):
    return _text(spark, folder, F.array_join(tx.remove_stopwords(tx.tokenize_words(F.lower("review")), "spanish"), " "))


@query(_text_sql(f"array_to_string({sq.lemmas(_LOWER_WORDS)}, ' ')"))
def lemmatize_nouns(spark, folder):
    return _text(spark, folder, F.array_join(tx.lemmatize_nouns(tx.tokenize_words(F.lower("review"))), " "))


_RULES_SQL = ", ".join(f"({i}, '{end}', '{new}')" for i, (end, new) in enumerate(NOUN_SUFFIXES))
_KNOWN_SQL = ", ".join(f"('{a}', '{b}')" for a, b in tx.irregular_nouns().items())


@query(
    f"""WITH {REVIEWS}, words AS (SELECT row_id, unnest({_LOWER_WORDS}) AS word FROM reviews),
    lexicon AS (SELECT word FROM words GROUP BY word HAVING count(DISTINCT row_id) >= 2),
    rules AS (SELECT * FROM (VALUES {_RULES_SQL}) t(rule, ending, new)), known AS (SELECT * FROM (VALUES {_KNOWN_SQL}) t(word, lemma)),
    tried AS (SELECT w.word, rule, concat(left(w.word, length(w.word) - length(ending)), new) AS lemma FROM (SELECT DISTINCT word FROM words) w
      JOIN rules ON suffix(w.word, ending) AND length(w.word) > length(ending)),
    found AS (SELECT word, arg_min(lemma, rule) AS lemma FROM tried WHERE lemma IN (SELECT word FROM lexicon) GROUP BY word)
    SELECT w.word, coalesce(k.lemma, f.lemma, w.word) AS lemma FROM (SELECT DISTINCT word FROM words) w
    LEFT JOIN known k ON k.word = w.word LEFT JOIN found f ON f.word = w.word"""
)
def lemmatize_lexicon(spark, folder):
    """Lemma of every word, accepted by a lexicon: here the words that two reviews or more have."""
    words = reviews(spark, folder).select("row_id", F.explode(tx.tokenize_words(F.lower("review"))).alias("word"))
    lexicon = words.distinct().groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")
    return lemma_table(words, lexicon)


@query(_text_sql("strip_accents(review)"))
def strip_accents(spark, folder):
    return _text(spark, folder, tx.strip_accents(F.col("review")))


def simplified_sql(text: str) -> str:
    named = text.join(_EMOJI_SQL.split("review"))
    words = sq.NO_NUMBERS.format(sq.WORDS_EMOJI.format(f"lower({sq.contractions(named)})"))
    return f"strip_accents(array_to_string({sq.lemmas(sq.no_stopwords(words, KEPT_NEGATIONS))}, ' '))"


@query(_text_sql(simplified_sql("review")))
def simplify_text(spark, folder):
    return _text(spark, folder, tx.simplify_text(F.col("review")))


@query(_text_sql(f"array_to_string({sq.topic_tokens('review')}, ' ')"))
def clean_text_topics(spark, folder):
    return _text(spark, folder, F.array_join(tx.topic_tokens(F.col("review")), " "))


@query(f"""WITH {REVIEWS} SELECT row_id, concat(review, ' ', coalesce(location, ''), ' ', gender) AS value FROM reviews""")
def concat_text_columns(spark, folder):
    return reviews(spark, folder).select("row_id", tx.concat_texts(F.col("review"), F.col("location"), F.col("gender")).alias("value"))


def _prompt_sql(template: str, **values: str) -> str:
    parts = "'" + template.replace("'", "''") + "'"
    for name, value in values.items():
        parts = parts.replace("{" + name + "}", f"', {value}, '")
    return f"concat({parts})"


@query(
    f"""WITH {REVIEWS}, examples AS (
      SELECT gender, string_agg('- ' || "reviewId", chr(10) ORDER BY "reviewId") AS examples, count(*) AS n FROM reviews GROUP BY gender)
    SELECT r.row_id, {_prompt_sql(prompts.CLASSIFY, text='r.review')} AS classify,
      {_prompt_sql(prompts.PARAPHRASE, n='CAST(r.row_id AS VARCHAR)', label='r.gender', examples='concat(chr(45), chr(32), r.review)')} AS paraphrase,
      {_prompt_sql(prompts.PARAPHRASE_NEUTRAL, n='CAST(r.row_id AS VARCHAR)', examples='concat(chr(45), chr(32), r.review)')} AS neutral
    FROM reviews r"""
)
def build_prompt(spark, folder):
    examples = prompts.bullet_list(F.array("review"))
    return reviews(spark, folder).select(
        "row_id",
        prompts.fill_template(prompts.CLASSIFY, text=F.col("review")).alias("classify"),
        prompts.fill_template(prompts.PARAPHRASE, n=F.col("row_id"), label=F.col("gender"), examples=examples).alias("paraphrase"),
        prompts.fill_template(prompts.PARAPHRASE_NEUTRAL, n=F.col("row_id"), examples=examples).alias("neutral"),
    )


# Answers with numbered and bulleted lines, made from the documents' own lines.
_ANSWER_SQL = r"""answers AS (SELECT row_id, concat('1. ', replace(review, chr(10), concat(' ', chr(10), '- 2) ')), chr(10), '   ', chr(10), '3.') AS answer FROM reviews)"""


def _answer() -> Column:
    return F.concat(F.lit("1. "), F.replace("review", F.lit("\n"), F.lit(" \n- 2) ")), F.lit("\n   \n3."))


CLEAN_LINES_SQL = r"""list_filter(list_transform(regexp_split_to_array({0}, '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]'),
  lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '^[-•0-9. )(]+|[-•0-9. )(]+$', '', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')),
  lambda x: x <> '')"""


@query(
    f"""WITH {REVIEWS}, {_ANSWER_SQL}, lines AS (SELECT row_id, {CLEAN_LINES_SQL.format('answer')} AS l FROM answers)
    SELECT row_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM lines"""
)
def clean_paraphrases(spark, folder):
    return reviews(spark, folder).select("row_id", F.posexplode(tx.clean_lines(_answer())).alias("pos", "line"))


@query(f"""WITH {REVIEWS} SELECT row_id, concat('gen_', left(sha256(concat('run|', "reviewId", '|', CAST(row_id AS VARCHAR))), 16)) AS value FROM reviews""", "generated_id")
def generated_ids(spark, folder):
    return reviews(spark, folder).select(
        "row_id", generated_id(F.lit("run"), F.col("reviewId"), F.col("row_id").cast("string")).alias("value")
    )


# ---- n-grams and term tables ---------------------------------------------------------------

_W2 = sq.WORDS2.format("review")
_GRAMS_13 = (
    "list_concat(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])), "
    "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]))"
)


@query(
    f"""WITH {REVIEWS}, words AS (SELECT row_id, {_W2} AS w FROM reviews), grams AS (SELECT row_id, {_GRAMS_13} AS g FROM words)
    SELECT row_id, len(g) AS n, md5(array_to_string(g, '|')) AS digest FROM grams"""
)
def ngrams(spark, folder):
    words = reviews(spark, folder).select("row_id", _words2().alias("words"))
    made = words.select("row_id", tx.ngrams(F.col("words"), 1, 3).alias("g"))
    return made.select("row_id", F.size("g").cast("long").alias("n"), F.md5(F.array_join("g", "|").cast("binary")).alias("digest"))


_BOW_SQL = f"""{RATED}, grams AS (SELECT row_id, unnest({_W2}) AS term FROM reviews),
  rated_grams AS (SELECT row_id, term FROM grams JOIN rated USING (row_id)),
  vocabulary AS ({sq.vocabulary('grams', 'reviews')}),
  rated_vocabulary AS ({sq.vocabulary('rated_grams', 'rated')}),
  tf AS (SELECT row_id, term, count(*) AS n FROM grams GROUP BY row_id, term)"""


def _words2() -> Column:
    return tx.two_char_words(F.col("review"))


@query(f"WITH {_BOW_SQL} SELECT row_id, term, n FROM tf JOIN vocabulary USING (term)")
def bow(spark, folder):
    rows = reviews(spark, folder)
    return features.bag_of_words(rows, _words2(), features.fit_vocabulary(rows, _words2()))


_GRAMS_12_SQL = f"""{REVIEWS}, words AS (SELECT row_id, {_W2} AS w FROM reviews),
  grams AS (SELECT row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]))) AS term FROM words),
  vocabulary AS ({sq.vocabulary('grams', 'reviews')})"""


@query(f"WITH {_GRAMS_12_SQL} SELECT term, df FROM vocabulary")
def vocabulary_bigrams(spark, folder):
    words = reviews(spark, folder).select("row_id", _words2().alias("words"))
    return features.fit_vocabulary(words, tx.ngrams(F.col("words"), 1, 2)).terms


_WEIGHTS = """weighted AS (SELECT row_id, term, n * (ln((1 + (SELECT count(*) FROM {1})) / (1.0 + df)) + 1) AS w FROM tf JOIN {0} USING (term))
  SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS value FROM weighted"""


@query(f"WITH {_BOW_SQL}, {_WEIGHTS.format('vocabulary', 'reviews')}")
def tfidf(spark, folder):
    rows = reviews(spark, folder)
    values = features.tf_idf(rows, _words2(), features.fit_vocabulary(rows, _words2()))
    return values.withColumn("value", F.round("value", 6))


@query(f"WITH {_BOW_SQL}, {_WEIGHTS.format('rated_vocabulary', 'rated')}")
def vectorize_apply(spark, folder):
    """Vocabulary and weights learned on rated reviews, applied to all of them."""
    fitted = features.fit_vocabulary(rated_reviews(spark, folder), _words2())
    values = features.tf_idf(reviews(spark, folder), _words2(), fitted)
    return values.withColumn("value", F.round("value", 6))


@query(f"""WITH {REVIEWS} SELECT row_id, review AS value FROM reviews""")
def text_none(spark, folder):
    """Texts that are not vectorised stay as they are."""
    return reviews(spark, folder).select("row_id", F.col("review").alias("value"))


def topic_rows(spark: SparkSession, folder: str) -> DataFrame:
    return reviews(spark, folder).select("row_id", "score", tx.topic_tokens(F.col("review")).alias("tokens"))


_TOKENS_SQL = f"""{REVIEWS}, docs AS (SELECT row_id, {sq.topic_tokens('review')} AS tokens FROM reviews),
  toks AS (SELECT row_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS term FROM docs)"""

_PHRASES_SQL = f"""{_TOKENS_SQL},
  uni AS (SELECT term, count(*) AS n FROM toks GROUP BY term),
  pairs AS (SELECT a.row_id, a.pos, a.term AS a, b.term AS b FROM toks a JOIN toks b ON a.row_id = b.row_id AND b.pos = a.pos + 1),
  bi AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b),
  size AS (SELECT (SELECT count(*) FROM uni) + (SELECT count(*) FROM bi) AS v),
  phrases AS (SELECT bi.a, bi.b, bi.n, (bi.n - 5) / CAST(x.n AS DOUBLE) / y.n * v AS score FROM bi JOIN uni x ON x.term = a JOIN uni y ON y.term = b, size
    WHERE (bi.n - 5) / CAST(x.n AS DOUBLE) / y.n * v > 10)"""


@query(f"WITH {_PHRASES_SQL} SELECT a, b, n, round(score, 6) AS score FROM phrases")
def phrases_bigram(spark, folder):
    return phrases.phrase_scores(topic_rows(spark, folder)).withColumn("score", F.round("score", 6))


@query(
    f"""WITH {_PHRASES_SQL},
    hits AS (SELECT p.row_id, p.pos FROM pairs p JOIN phrases f ON p.a = f.a AND p.b = f.b),
    runs AS (SELECT row_id, pos, pos - row_number() OVER (PARTITION BY row_id ORDER BY pos) AS run FROM hits),
    taken AS (SELECT row_id, pos FROM (SELECT row_id, pos, row_number() OVER (PARTITION BY row_id, run ORDER BY pos) AS i FROM runs) WHERE i % 2 = 1),
    merged AS (SELECT t.row_id, t.pos, CASE WHEN s.pos IS NOT NULL THEN t.term || '_' || n.term ELSE t.term END AS term
      FROM toks t LEFT JOIN taken s ON s.row_id = t.row_id AND s.pos = t.pos LEFT JOIN toks n ON n.row_id = t.row_id AND n.pos = t.pos + 1
      LEFT JOIN taken e ON e.row_id = t.row_id AND e.pos = t.pos - 1 WHERE e.pos IS NULL)
    SELECT d.row_id, coalesce(string_agg(m.term, ' ' ORDER BY m.pos), '') AS value FROM docs d LEFT JOIN merged m ON m.row_id = d.row_id GROUP BY d.row_id"""
)
def merge_bigrams(spark, folder):
    return phrases.add_phrases(topic_rows(spark, folder), "bigram").select("row_id", F.array_join("tokens", " ").alias("value"))


def _merge_sql(tokens: str, n: int) -> str:
    """CTEs that find the phrases among ``tokens`` (row_id, pos, term) and merge them into ``merged{n}``."""
    return f"""uni{n} AS (SELECT term, count(*) AS n FROM {tokens} GROUP BY term),
  pairs{n} AS (SELECT a.row_id, a.pos, a.term AS a, b.term AS b FROM {tokens} a JOIN {tokens} b ON a.row_id = b.row_id AND b.pos = a.pos + 1),
  bi{n} AS (SELECT a, b, count(*) AS n FROM pairs{n} GROUP BY a, b),
  size{n} AS (SELECT (SELECT count(*) FROM uni{n}) + (SELECT count(*) FROM bi{n}) AS v),
  phrases{n} AS (SELECT bi.a, bi.b FROM bi{n} bi JOIN uni{n} x ON x.term = a JOIN uni{n} y ON y.term = b, size{n} WHERE (bi.n - 5) / CAST(x.n AS DOUBLE) / y.n * v > 10),
  hits{n} AS (SELECT p.row_id, p.pos FROM pairs{n} p JOIN phrases{n} f ON p.a = f.a AND p.b = f.b),
  runs{n} AS (SELECT row_id, pos, pos - row_number() OVER (PARTITION BY row_id ORDER BY pos) AS run FROM hits{n}),
  taken{n} AS (SELECT row_id, pos FROM (SELECT row_id, pos, row_number() OVER (PARTITION BY row_id, run ORDER BY pos) AS i FROM runs{n}) WHERE i % 2 = 1),
  merged{n} AS (SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS pos, term FROM (
    SELECT t.row_id, t.pos, CASE WHEN s.pos IS NOT NULL THEN t.term || '_' || n.term ELSE t.term END AS term
    FROM {tokens} t LEFT JOIN taken{n} s ON s.row_id = t.row_id AND s.pos = t.pos LEFT JOIN {tokens} n ON n.row_id = t.row_id AND n.pos = t.pos + 1
    LEFT JOIN taken{n} e ON e.row_id = t.row_id AND e.pos = t.pos - 1 WHERE e.pos IS NULL))"""


@query(
    f"""WITH {_TOKENS_SQL}, {_merge_sql('toks', 1)}, {_merge_sql('merged1', 2)}
    SELECT d.row_id, coalesce(string_agg(m.term, ' ' ORDER BY m.pos), '') AS value FROM docs d LEFT JOIN merged2 m ON m.row_id = d.row_id GROUP BY d.row_id"""
)
def phrases_trigram(spark, folder):
    return phrases.add_phrases(topic_rows(spark, folder), "trigram").select("row_id", F.array_join("tokens", " ").alias("value"))


_DICTIONARY_SQL = f"""{_TOKENS_SQL},
  kept AS ({sq.vocabulary('toks', 'docs', 5, 0.85)} ORDER BY df DESC, term LIMIT 100000),
  dictionary AS (SELECT term, df, CAST(row_number() OVER (ORDER BY encode(term)) - 1 AS INT) AS term_id FROM kept)"""


@query(f"WITH {_DICTIONARY_SQL} SELECT term, df, term_id FROM dictionary")
def dictionary_filter(spark, folder):
    return features.topic_dictionary(topic_rows(spark, folder), F.col("tokens")).terms


@query(f"WITH {_DICTIONARY_SQL} SELECT row_id, term_id, count(*) AS n FROM toks JOIN dictionary USING (term) GROUP BY row_id, term_id")
def doc2bow(spark, folder):
    rows = topic_rows(spark, folder)
    return features.doc2bow(rows, F.col("tokens"), features.topic_dictionary(rows, F.col("tokens")))
