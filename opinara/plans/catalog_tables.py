"""Registered queries: readers, projections, labels, imputation, scaling, counts, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import labels, numbers
from opinara.functions.text import fill_empty
from opinara.operators import distributions as dist
from opinara.operators import metrics, prepare
from opinara.plans.sqltext import RATED, REVIEWS, pnn, spanish
from opinara.session import new_path
from opinara.sources import files
from opinara.sources.tables import rated_reviews, reviews, table

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


# ---- readers and writers -------------------------------------------------------------------

_FILE_COLUMNS = ["row_id", "reviewId", "review", "score", "gender", "location", "date", "n_chars"]


@query(
    f"""WITH {REVIEWS} SELECT row_id, "reviewId", review, CAST(score AS DOUBLE) AS target, gender, location, date, n_chars
    FROM reviews"""
)
def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    path = files.write_csv(reviews(spark, folder).select(_FILE_COLUMNS), new_path(spark, "reviews"), ";")
    return files.read_reviews(spark, path, ";", rename={"score": "target"})


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def read_reviews_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    """Every error event is written with a surplus field, and such lines are skipped on reading."""
    events = table(spark, folder, "events")
    broken = F.when(F.col("event_type") == "error", "error|surplus").otherwise(F.col("event_type"))
    path = new_path(spark, "events")
    events.select("event_id", "user_id", "value", broken.alias("event_type")).write.options(
        header=True, sep="|", quote=""
    ).csv(path)
    return files.read_reviews_tolerant(spark, path)


@query(f"""WITH {RATED} SELECT row_id, review, CAST(score AS BIGINT) AS score FROM rated""")
def read_topic_source(spark: SparkSession, folder: str) -> DataFrame:
    path = files.write_csv(rated_reviews(spark, folder).select("row_id", "review", "score"), new_path(spark, "topics"), ";")
    return files.read_topic_source(spark, path)


@query(f"""WITH {REVIEWS} SELECT row_id, review, score FROM reviews""")
def require_columns(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.require_columns(reviews(spark, folder), ["review", "score"]).select("row_id", "review", "score")


# ---- projections, filters, labels ----------------------------------------------------------


@query(f"""WITH {REVIEWS} SELECT row_id, review, score, gender, location FROM reviews""")
def drop_features(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_features(reviews(spark, folder), ["reviewId", "date", "n_chars"])


@query(f"""WITH {REVIEWS} SELECT "reviewId", review, score, gender, location, date FROM reviews""")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return reviews(spark, folder).select("reviewId", "review", "score", "gender", "location", "date")


_ROLE = """SELECT '{0}' AS column_name, CASE WHEN count(DISTINCT {1}) <= 20 THEN 'categorical' ELSE 'text' END AS role,
  CASE WHEN count(DISTINCT {1}) <= 20 THEN count(DISTINCT {1}) END AS n_distinct FROM reviews"""


@query(
    f"WITH {REVIEWS} SELECT 'n_chars' AS column_name, 'numeric' AS role, CAST(NULL AS BIGINT) AS n_distinct UNION ALL "
    + " UNION ALL ".join(_ROLE.format(c, f'"{c}"') for c in ("reviewId", "review", "gender", "location", "date"))
)
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    return dist.select_features(reviews(spark, folder).drop("row_id"), "score", 20)


@query(
    f"""WITH {REVIEWS} SELECT row_id, score, CASE WHEN score IN (1, 2) THEN 'negative' WHEN score = 3 THEN 'neutral'
    ELSE 'positive' END AS sentiment FROM reviews WHERE score IN (1, 2, 3, 4, 5)"""
)
def filter_sentiment_band(spark: SparkSession, folder: str) -> DataFrame:
    banded = reviews(spark, folder).select("row_id", "score", labels.sentiment_band(F.col("score")).alias("sentiment"))
    return banded.where(F.col("sentiment").isNotNull())


@query(
    f"""WITH {REVIEWS}, bands AS (SELECT unnest(['negative', 'neutral', 'positive', 'mixed']) AS sentiment),
    sizes AS (SELECT CASE WHEN score IN (1, 2) THEN 'negative' WHEN score = 3 THEN 'neutral' WHEN score IN (4, 5) THEN 'positive' END AS s,
              count(*) AS n FROM reviews GROUP BY 1)
    SELECT sentiment, coalesce(n, 0) AS n, coalesce(n, 0) = 0 AS skipped FROM bands LEFT JOIN sizes ON s = sentiment"""
)
def empty_guard(spark: SparkSession, folder: str) -> DataFrame:
    band = labels.sentiment_band(F.col("score"))
    wanted = ["negative", "neutral", "positive", "mixed"]
    sizes = reviews(spark, folder).agg(*[F.count_if(F.coalesce(band == w, F.lit(False))).alias(w) for w in wanted])
    rows = F.array(*[F.struct(F.lit(w).alias("sentiment"), F.col(w).alias("n")) for w in wanted])
    return sizes.select(F.inline(rows)).withColumn("skipped", F.col("n") == 0)


# Scores as text, as a file would hold them: numbers, fractions, words and gaps.
_RAW_SQL = """raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount = 0.05 THEN 'x' WHEN l_discount = 0.06 THEN NULL ELSE CAST(l_quantity / 8 AS VARCHAR) END AS score,
  CASE WHEN l_tax = 0.01 THEN NULL ELSE l_returnflag END AS review FROM lineitem)"""


def _raw_scores(spark: SparkSession, folder: str) -> DataFrame:
    score = F.when(F.col("l_discount") == 0.05, "x").when(F.col("l_discount") != 0.06, (F.col("l_quantity") / 8).cast("string"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        score.alias("score"),
        F.when(F.col("l_tax") != 0.01, F.col("l_returnflag")).alias("review"),
    )


@query(
    f"""WITH {_RAW_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, review,
    CAST(trunc(try_cast(score AS DOUBLE)) AS INT) AS score FROM raw
    WHERE review IS NOT NULL AND trunc(try_cast(score AS DOUBLE)) BETWEEN 1 AND 5"""
)
def clean_scores(spark: SparkSession, folder: str) -> DataFrame:
    return dist.clean_scores(_raw_scores(spark, folder))


@query(f"""WITH {_RAW_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, review, try_cast(score AS DOUBLE) AS score FROM raw""")
def numeric_coerce(spark: SparkSession, folder: str) -> DataFrame:
    return dist.coerce_numeric(_raw_scores(spark, folder), ["score"])


@query(f"""WITH {_RAW_SQL} SELECT * FROM raw WHERE score IS NOT NULL AND review IS NOT NULL""")
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_null_rows(_raw_scores(spark, folder), ["score", "review"])


@query(f"""WITH {REVIEWS} SELECT row_id, coalesce(location, '') AS location FROM reviews""")
def fill_empty_text(spark: SparkSession, folder: str) -> DataFrame:
    return reviews(spark, folder).select("row_id", fill_empty(F.col("location")).alias("location"))


# Ratings with fractions, NaN and gaps.
_RATING_SQL = """ratings AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_tax = 0.01 THEN CAST('NaN' AS DOUBLE) WHEN l_tax = 0.02 THEN NULL ELSE l_quantity / 8 END AS rating FROM lineitem)"""
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _ratings(spark: SparkSession, folder: str) -> DataFrame:
    rating = F.when(F.col("l_tax") == 0.01, float("nan")).when(F.col("l_tax") != 0.02, F.col("l_quantity") / 8)
    return table(spark, folder, "lineitem").select(*_KEYS, rating.alias("rating"))


@query(f"""WITH {_RATING_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {pnn('rating')} AS label FROM ratings""")
def rating_to_pnn(spark: SparkSession, folder: str) -> DataFrame:
    return _ratings(spark, folder).select(*_KEYS, labels.rating_to_pnn(F.col("rating")).alias("label"))


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {spanish('CAST(trunc(l_quantity / 8) AS INT)')} AS label
    FROM lineitem"""
)
def score_to_label(spark: SparkSession, folder: str) -> DataFrame:
    score = (F.col("l_quantity") / 8).cast("int")
    return table(spark, folder, "lineitem").select(*_KEYS, labels.score_to_label(score).alias("label"))


_ANSWER_SQL = """CASE WHEN score >= 4 THEN concat('  Posi', 'tivo.', chr(10)) WHEN score = 3 THEN '"NEUTRO"'
  WHEN score <= 2 THEN 'El sentimiento es: negativo (claro)' ELSE review END"""


def _answers(df: DataFrame) -> DataFrame:
    score = F.col("score")
    answer = (
        F.when(score >= 4, "  Positivo.\n").when(score == 3, '"NEUTRO"').when(score <= 2, "El sentimiento es: negativo (claro)")
    )
    return df.withColumn("answer", answer.otherwise(F.col("review")))


_CLEAN_ANSWER = r"""translate(lower(regexp_replace(answer, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '.,:;"''()' || chr(10), '')"""


@query(
    f"""WITH {REVIEWS}, answers AS (SELECT row_id, {_ANSWER_SQL} AS answer FROM reviews),
    cleaned AS (SELECT row_id, {_CLEAN_ANSWER} AS a FROM answers)
    SELECT row_id, CASE WHEN contains(a, 'positivo') THEN 'Positivo' WHEN contains(a, 'negativo') THEN 'Negativo'
      WHEN contains(a, 'neutro') THEN 'Neutro' ELSE 'DESCONOCIDO' END AS label FROM cleaned"""
)
def normalize_llm_label(spark: SparkSession, folder: str) -> DataFrame:
    return _answers(reviews(spark, folder)).select("row_id", labels.normalize_answer(F.col("answer")).alias("label"))


# ---- imputation ----------------------------------------------------------------------------

_ITEMS_SQL = """items AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_tax = 0.03 THEN NULL ELSE l_quantity END AS qty,
  CASE WHEN l_discount = 0.07 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_tax = 0.04 THEN NULL ELSE l_returnflag END AS flag,
  CASE WHEN l_tax = 0.05 THEN NULL ELSE l_linestatus END AS status,
  CAST(NULL AS VARCHAR) AS nothing, 7.0::DOUBLE AS constant, l_discount AS discount, l_tax AS tax FROM lineitem)"""
_NUMBERS, _KINDS = ["qty", "price"], ["flag", "status", "nothing"]


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *_KEYS,
        F.when(F.col("l_tax") != 0.03, F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_discount") != 0.07, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_tax") != 0.04, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_tax") != 0.05, F.col("l_linestatus")).alias("status"),
        F.lit(None).cast("string").alias("nothing"),
        F.lit(7.0).alias("constant"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def _imputed(spark: SparkSession, folder: str, numeric: list, categorical: list, **how) -> DataFrame:
    items = _items(spark, folder).select(*_KEYS, *numeric, *categorical)
    filled = prepare.fit_imputer(items, numeric, categorical, **how).apply(items)
    return filled.withColumns({c: F.round(c, 6) for c in numeric})


def _impute_sql(fill: str, columns: list) -> str:
    picks = ", ".join(fill.format(c) + f" AS {c}" for c in columns)
    return f"WITH {_ITEMS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {picks} FROM items"


@query(_impute_sql("round(coalesce({0}, (SELECT avg({0}) FROM items)), 6)", _NUMBERS))
def impute_mean(spark, folder):
    return _imputed(spark, folder, _NUMBERS, [], impute_num="mean")


@query(_impute_sql("round(coalesce({0}, (SELECT median({0}) FROM items)), 6)", _NUMBERS))
def impute_median(spark, folder):
    return _imputed(spark, folder, _NUMBERS, [], impute_num="median")


_MODE = "(SELECT {0} FROM items WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"


@query(_impute_sql("round(coalesce({0}, " + _MODE + "), 6)", _NUMBERS))
def impute_mode_num(spark, folder):
    return _imputed(spark, folder, _NUMBERS, [], impute_num="mode")


@query(_impute_sql("coalesce({0}, -1)", _NUMBERS))
def impute_constant_num(spark, folder):
    return _imputed(spark, folder, _NUMBERS, [], impute_num="constant", num_constant=-1)


@query(_impute_sql("{0}", _NUMBERS) + " WHERE qty IS NOT NULL AND price IS NOT NULL")
def impute_delete_num(spark, folder):
    return _imputed(spark, folder, _NUMBERS, [], impute_num="delete")


@query(_impute_sql("coalesce({0}, " + _MODE + ", 'Desconocido')", _KINDS))
def impute_mode_cat(spark, folder):
    return _imputed(spark, folder, [], _KINDS, impute_cat="mode")


@query(_impute_sql("coalesce({0}, 'missing')", _KINDS))
def impute_constant_cat(spark, folder):
    return _imputed(spark, folder, [], _KINDS, impute_cat="constant", cat_constant="missing")


@query(_impute_sql("{0}", _KINDS[:2]) + " WHERE flag IS NOT NULL AND status IS NOT NULL")
def impute_delete_cat(spark, folder):
    return _imputed(spark, folder, [], _KINDS[:2], impute_cat="delete")


# ---- scaling and encoding ------------------------------------------------------------------

_SCALED = ["price", "discount", "constant"]
_SCALE_ROWS = "items AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, l_discount AS discount, 7.0::DOUBLE AS constant FROM lineitem)"


def _scaled(spark: SparkSession, folder: str, scaler: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        *_KEYS, F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.lit(7.0).alias("constant")
    )
    done = prepare.fit_scaler(items, _SCALED, scaler).apply(items)
    return done.withColumns({c: F.round(c, 6) for c in _SCALED})


def _scale_sql(body: str) -> str:
    picks = ", ".join("round(" + body.format(c) + f", 6) AS {c}" for c in _SCALED)
    limits = ", ".join(
        f"min({c}) AS {c}_min, max({c}) AS {c}_max, max(abs({c})) AS {c}_abs, avg({c}) AS {c}_avg, stddev_pop({c}) AS {c}_std"
        for c in _SCALED
    )
    return f"WITH {_SCALE_ROWS}, s AS (SELECT {limits} FROM items) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {picks} FROM items, s"


@query(_scale_sql("CASE WHEN {0}_max > {0}_min THEN ({0} - {0}_min) / ({0}_max - {0}_min) ELSE 0.0 END"))
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query(_scale_sql("CASE WHEN {0}_abs > 0 THEN {0} / {0}_abs ELSE 0.0 END"))
def scale_maxabs(spark, folder):
    return _scaled(spark, folder, "maxabs")


@query(_scale_sql("CASE WHEN {0}_std > 0 THEN ({0} - {0}_avg) / {0}_std ELSE 0.0 END"))
def scale_zscore(spark, folder):
    return _scaled(spark, folder, "zscore")


@query(_scale_sql("{0} / sqrt(price * price + discount * discount + constant * constant)"))
def scale_l2_row(spark, folder):
    return _scaled(spark, folder, "normalizer")


@query(_scale_sql("{0}"))
def scale_none(spark, folder):
    return _scaled(spark, folder, "standard")


@query(
    """WITH a AS (SELECT l_returnflag, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INT) AS f FROM (SELECT DISTINCT l_returnflag FROM lineitem)),
    b AS (SELECT l_linestatus, CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS INT) AS s FROM (SELECT DISTINCT l_linestatus FROM lineitem))
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, f AS l_returnflag, s AS l_linestatus
    FROM lineitem JOIN a USING (l_returnflag) JOIN b USING (l_linestatus)"""
)
def label_encode(spark, folder):
    items = table(spark, folder, "lineitem").select(*_KEYS, "l_returnflag", "l_linestatus")
    return prepare.fit_label_encoder(items, ["l_returnflag", "l_linestatus"]).apply(items)


# ---- counts and quotas ---------------------------------------------------------------------


@query(f"""WITH {RATED} SELECT score, count(*) AS n FROM rated GROUP BY score""")
def score_distribution(spark, folder):
    return dist.score_distribution(rated_reviews(spark, folder))


@query(f"""WITH {RATED} SELECT {spanish('score')} AS label, count(*) AS n FROM rated GROUP BY 1""")
def class_distribution(spark, folder):
    return dist.class_distribution(rated_reviews(spark, folder), labels.score_to_label(F.col("score")))


def _spanish_classes(spark: SparkSession, folder: str) -> DataFrame:
    return dist.class_distribution(rated_reviews(spark, folder), labels.score_to_label(F.col("score")))


_SIZES = f"""sizes AS (SELECT {spanish('score')} AS label, count(*) AS n FROM rated GROUP BY 1)"""


@query(f"""WITH {RATED}, {_SIZES} SELECT max(n) AS majority FROM sizes""")
def majority_size(spark, folder):
    return dist.majority_size(_spanish_classes(spark, folder))


@query(
    f"""WITH {RATED}, {_SIZES}, targets AS (SELECT * FROM (VALUES ('Negativo', 2), ('Neutro', 3), ('Mixto', 9)) t(label, target_score))
    SELECT label, target_score, (SELECT max(n) FROM sizes) - coalesce(n, 0) AS quota FROM targets LEFT JOIN sizes USING (label)
    WHERE (SELECT max(n) FROM sizes) - coalesce(n, 0) > 0"""
)
def class_deficit(spark, folder):
    return dist.class_deficit(_spanish_classes(spark, folder), {"Negativo": 2, "Neutro": 3, "Mixto": 9})


@query(f"""WITH {RATED} SELECT score, count(*) AS n FROM rated GROUP BY score ORDER BY n, score LIMIT 3""")
def smallest_k_scores(spark, folder):
    return dist.smallest_scores(dist.score_distribution(rated_reviews(spark, folder)))


@query(
    f"""WITH {RATED}, d AS (SELECT score, count(*) AS n FROM rated GROUP BY score ORDER BY n, score LIMIT 3)
    SELECT score, n, CAST(round_even(n * 0.5, 0) AS BIGINT) AS quota FROM d"""
)
def percent_quota(spark, folder):
    return dist.percent_quota(dist.smallest_scores(dist.score_distribution(rated_reviews(spark, folder))))


@query(
    f"""WITH {REVIEWS}, answers AS (SELECT row_id, {_ANSWER_SQL} AS answer FROM reviews),
    cleaned AS (SELECT {_CLEAN_ANSWER} AS a FROM answers),
    named AS (SELECT CASE WHEN contains(a, 'positivo') THEN 'Positivo' WHEN contains(a, 'negativo') THEN 'Negativo'
      WHEN contains(a, 'neutro') THEN 'Neutro' ELSE 'DESCONOCIDO' END AS label FROM cleaned),
    wanted AS (SELECT unnest(['Positivo', 'Neutro', 'Negativo', 'DESCONOCIDO']) AS label)
    SELECT w.label, count(n.label) AS n FROM wanted w LEFT JOIN named n ON n.label = w.label GROUP BY w.label"""
)
def label_summary(spark, folder):
    named = normalize_llm_label(spark, folder).withColumnRenamed("label", "prediccion")
    return dist.answer_summary(named)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c in ("l_returnflag", "l_quantity", "l_suppkey")
    )
)
def nunique(spark, folder):
    return dist.count_unique(table(spark, folder, "lineitem"), ["l_returnflag", "l_quantity", "l_suppkey"])


@query(
    f"WITH {_ITEMS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) > count({c}) AS has_null FROM items"
        for c in ("qty", "flag", "nothing", "discount")
    )
)
def null_check(spark, folder):
    return dist.null_check(_items(spark, folder), ["qty", "flag", "nothing", "discount"])


# ---- metrics -------------------------------------------------------------------------------

_JUDGED = """judged AS (SELECT l_returnflag AS label, CASE WHEN l_quantity > 30 THEN 'A' WHEN l_discount > 0.05 THEN 'R' ELSE 'X' END AS prediction
  FROM lineitem)"""
_PER_CLASS = (
    _JUDGED
    + """, names AS (SELECT label AS c FROM judged UNION SELECT prediction FROM judged),
  per_class AS (SELECT c, tp, support, predicted,
      CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r,
      CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f
    FROM (SELECT c, CAST(count(*) FILTER (WHERE label = c AND prediction = c) AS DOUBLE) AS tp,
                 CAST(count(*) FILTER (WHERE label = c) AS DOUBLE) AS support,
                 CAST(count(*) FILTER (WHERE prediction = c) AS DOUBLE) AS predicted
          FROM names JOIN judged ON label = c OR prediction = c GROUP BY c))"""
)


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    prediction = F.when(F.col("l_quantity") > 30, "A").when(F.col("l_discount") > 0.05, "R").otherwise("X")
    return table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label"), prediction.alias("prediction"))


@query(
    f"""WITH {_PER_CLASS} SELECT a.c AS y_true, b.c AS y_pred, (SELECT count(*) FROM judged WHERE label = a.c AND prediction = b.c) AS n
    FROM names a, names b"""
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_judged(spark, folder))


@query(
    f"""WITH {_PER_CLASS}
    SELECT 'macro' AS average, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f), 6) AS f1 FROM per_class
    UNION ALL SELECT 'micro', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6) FROM per_class
    UNION ALL SELECT 'weighted', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
      round(sum(f * support) / sum(support), 6) FROM per_class"""
)
def precision_recall_f(spark, folder):
    counts = metrics.confusion(_judged(spark, folder))
    result = None
    for average in metrics.AVERAGES:
        one = metrics.precision_recall_f(counts, average).select(
            F.lit(average).alias("average"), *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")]
        )
        result = one if result is None else result.unionByName(one)
    return result


@query(f"""WITH {_PER_CLASS} SELECT round(sum(tp) / sum(support), 6) AS f1_micro, round(avg(f), 6) AS f1_macro FROM per_class""")
def f1_micro_macro(spark, folder):
    scores = metrics.f1_micro_macro(metrics.confusion(_judged(spark, folder)))
    return scores.select(F.round("f1_micro", 6).alias("f1_micro"), F.round("f1_macro", 6).alias("f1_macro"))


@query(
    f"""WITH {_PER_CLASS}
    SELECT c AS label, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, CAST(support AS BIGINT) AS support FROM per_class
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4),
      CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4),
      round(sum(f * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM per_class"""
)
def classification_report(spark, folder):
    return metrics.classification_report(metrics.confusion(_judged(spark, folder)))
