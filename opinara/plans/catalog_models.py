"""Registered queries: naive Bayes, nearest neighbours, folds, grids, library models, topics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.functions import labels
from opinara.functions import text as tx
from opinara.operators import bayes, features, folds, logistic, neighbors, sampling, search, topics, trees
from opinara.operators import metrics as mt
from opinara.plans import classify
from opinara.plans import sqltext as sq
from opinara.plans import topics as topic_plan
from opinara.plans.catalog_balance import near_sql
from opinara.plans.catalog_text import simplified_sql
from opinara.plans.sqltext import RATED
from opinara.session import materialise, new_path, small_values, stored
from opinara.sources import files
from opinara.sources.tables import rated_reviews, reviews, split_of, table

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


def _words() -> Column:
    return tx.two_char_words(F.col("review"))


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    return rated_reviews(spark, folder).select("row_id", labels.rating_to_pnn(F.col("score")).alias("label"), "review")


def _counts(df: DataFrame, vocabulary: features.Vocabulary, carry: list[str]) -> DataFrame:
    return features.bag_of_words(df, _words(), vocabulary, carry).withColumn("value", F.col("n").cast("double"))


_FEATURES = f"""{RATED}, labelled AS (SELECT row_id, {sq.pnn('score')} AS label FROM rated),
  grams AS (SELECT row_id, unnest({sq.WORDS2.format('review')}) AS term FROM reviews),
  rated_grams AS (SELECT row_id, term FROM grams JOIN rated USING (row_id)),
  vocabulary AS ({sq.vocabulary('rated_grams', 'rated')}),
  feats AS (SELECT row_id, term, count(*) AS v FROM grams JOIN vocabulary USING (term) GROUP BY row_id, term),
  train AS (SELECT * FROM feats JOIN labelled USING (row_id))"""


def _model_sql(alpha: float) -> str:
    return f"""size AS (SELECT count(*) AS terms FROM vocabulary), names AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
  cell AS (SELECT term, label, sum(v) AS v FROM train GROUP BY term, label),
  mass AS (SELECT label, sum(v) AS total FROM cell GROUP BY label),
  model AS (SELECT t.term, n.label, ln((coalesce(c.v, 0) + {alpha}) / (m.total + {alpha} * terms)) AS lp
    FROM vocabulary t CROSS JOIN names n JOIN mass m ON m.label = n.label LEFT JOIN cell c ON c.term = t.term AND c.label = n.label, size)"""


def _predict_sql(alpha: float, prior: str) -> str:
    return f"""{_FEATURES}, {_model_sql(alpha)},
  joint AS (SELECT r.row_id, n.label, round({prior} + coalesce(s.s, 0), 9) AS s FROM reviews r CROSS JOIN names n
    LEFT JOIN (SELECT row_id, label, sum(v * lp) AS s FROM feats JOIN model USING (term) GROUP BY row_id, label) s ON s.row_id = r.row_id AND s.label = n.label),
  predicted AS (SELECT row_id, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY s DESC, label) AS i FROM joint) WHERE i = 1)"""


_LEARNED = "ln(n.n / (SELECT sum(n) FROM names))"
_UNIFORM = "-ln((SELECT count(*) FROM names))"


def _fitted(spark: SparkSession, folder: str) -> tuple[features.Vocabulary, bayes.BayesModel]:
    rows = _rated(spark, folder)
    vocabulary = features.fit_vocabulary(rows, _words())
    model = bayes.fit_bayes(_counts(rows, vocabulary, ["row_id", "label"]), rows, vocabulary.size)
    return vocabulary, model


@query(f"WITH {_FEATURES}, {_model_sql(0.5)} SELECT term, label, round(lp, 6) AS log_probability FROM model")
def naive_bayes_fit(spark, folder):
    model = _fitted(spark, folder)[1]
    return bayes.log_table(model, 0.5).withColumn("log_probability", F.round("log_probability", 6))


def _predicted(spark: SparkSession, folder: str, fit_prior: bool) -> DataFrame:
    vocabulary, model = _fitted(spark, folder)
    rows = reviews(spark, folder).select("row_id", "score", "review")
    return bayes.predict_bayes(model, rows, _counts(rows, vocabulary, ["row_id"]), 0.5, fit_prior)


@query(f"WITH {_predict_sql(0.5, _LEARNED)} SELECT row_id, prediction FROM predicted")
def naive_bayes_predict(spark, folder):
    """Learned on rated reviews, applied to all."""
    return _predicted(spark, folder, True).select("row_id", "prediction")


@query(f"WITH {_predict_sql(0.5, _UNIFORM)} SELECT row_id, prediction FROM predicted")
def naive_bayes_uniform_prior(spark, folder):
    return _predicted(spark, folder, False).select("row_id", "prediction")


@query(f"WITH {_predict_sql(0.5, _LEARNED)} SELECT row_id, review, {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)")
def attach_predictions(spark, folder):
    done = _predicted(spark, folder, True)
    return done.select("row_id", "review", labels.rating_to_pnn(F.col("score")).alias("label"), "prediction")


@query(f"WITH {_predict_sql(0.5, _LEARNED)} SELECT row_id, review, {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)")
def write_predictions(spark, folder):
    path = files.write_predictions(attach_predictions(spark, folder), new_path(spark, "predictions"))
    return files.read_reviews(spark, path, ",")


_PER_CLASS = """names2 AS (SELECT label AS c FROM judged UNION SELECT prediction FROM judged),
  per_class AS (SELECT c, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r,
      CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f
    FROM (SELECT c, CAST(count(*) FILTER (WHERE label = c AND prediction = c) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = c) AS DOUBLE) AS support,
      CAST(count(*) FILTER (WHERE prediction = c) AS DOUBLE) AS predicted FROM names2 JOIN judged ON label = c OR prediction = c GROUP BY c))"""
_REPORT = f"""{_predict_sql(0.5, _LEARNED)}, judged AS (SELECT label, prediction FROM labelled JOIN predicted USING (row_id)),
  {_PER_CLASS}"""
_REPORT_ROWS = """SELECT c AS label, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, CAST(support AS BIGINT) AS support FROM per_class
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4), round(sum(f * support) / sum(support), 4),
      CAST(sum(support) AS BIGINT) FROM per_class"""


@query(f"WITH {_REPORT} {_REPORT_ROWS}")
def sentiment_report(spark, folder):
    """Classification report of naive Bayes on the rated reviews it was fitted on."""
    judged = attach_predictions(spark, folder).join(_rated(spark, folder).select("row_id"), "row_id", "left_semi")
    return mt.classification_report(mt.confusion(judged))


# ---- folds and grids -----------------------------------------------------------------------


def _folds_sql(rows: str, out: str = "folded") -> str:
    return f"""classes AS (SELECT label, count(*) AS n, min(row_id) AS first FROM {rows} GROUP BY label),
  offsets AS (SELECT label, n, sum(n) OVER (ORDER BY first) - n AS off FROM classes),
  shares AS (SELECT label, i, (off + n + 4 - i) // 5 - (off + 4 - i) // 5 AS share FROM offsets, range(5) t(i)),
  ends AS (SELECT label, i, sum(share) OVER (PARTITION BY label ORDER BY i) AS last FROM shares),
  numbered AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY row_id) AS r FROM {rows}),
  {out} AS (SELECT row_id, x.label, CAST(count(*) FILTER (WHERE last < r) AS INT) AS fold FROM numbered x JOIN ends e ON e.label = x.label GROUP BY row_id, x.label)"""


@query(f"WITH labelled AS (SELECT o_orderkey AS row_id, o_orderpriority AS label FROM orders), {_folds_sql('labelled')} SELECT row_id, label, fold FROM folded")
def stratified_folds(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("label"))
    return folds.stratified_folds(rows, "label")


ALPHAS, PRIORS = [0.1, 0.5, 1.0], [True, False]
_CELLS = [{"alpha": a, "fit_prior": b} for a in ALPHAS for b in PRIORS]
_CELL_ROWS = ", ".join(
    f"({i}, {c['alpha']}, {str(c['fit_prior']).lower()}, '{search.model_name('naive_bayes', c)}')" for i, c in enumerate(_CELLS)
)
_GRID = f"""{_FEATURES}, {_folds_sql('labelled')}, cells AS (SELECT * FROM (VALUES {_CELL_ROWS}) t(cell, alpha, prior, model)),
  size AS (SELECT count(*) AS terms FROM vocabulary),
  ftrain AS (SELECT t.term, t.v, f.label, f.fold, f.row_id FROM train t JOIN folded f ON f.row_id = t.row_id),
  held AS (SELECT fold, label, term, sum(v) AS v FROM ftrain GROUP BY ALL),
  total AS (SELECT label, term, sum(v) AS v FROM ftrain GROUP BY ALL),
  five AS (SELECT unnest(range(5)) AS fold), names AS (SELECT DISTINCT label FROM labelled),
  kept AS (SELECT five.fold, n.label, t.term, coalesce(a.v, 0) - coalesce(h.v, 0) AS v FROM five CROSS JOIN names n CROSS JOIN vocabulary t
    LEFT JOIN total a ON a.label = n.label AND a.term = t.term LEFT JOIN held h ON h.fold = five.fold AND h.label = n.label AND h.term = t.term),
  mass AS (SELECT fold, label, sum(v) AS total FROM kept GROUP BY ALL),
  amount AS (SELECT five.fold, n.label, count(*) FILTER (WHERE f.label = n.label AND f.fold <> five.fold) AS n, count(*) FILTER (WHERE f.fold <> five.fold) AS every
    FROM five CROSS JOIN names n CROSS JOIN folded f GROUP BY ALL),
  words AS (SELECT x.row_id, k.label, c.cell, sum(x.v * ln((k.v + c.alpha) / (m.total + c.alpha * terms))) AS s
    FROM ftrain x JOIN kept k ON k.fold = x.fold AND k.term = x.term JOIN mass m ON m.fold = k.fold AND m.label = k.label, cells c, size GROUP BY ALL),
  joint AS (SELECT f.row_id, f.fold, f.label AS y, c.cell, a.label, round(CASE WHEN c.prior THEN ln(a.n / a.every) ELSE -ln((SELECT count(*) FROM names)) END + coalesce(w.s, 0), 9) AS s
    FROM folded f CROSS JOIN cells c JOIN amount a ON a.fold = f.fold LEFT JOIN words w ON w.row_id = f.row_id AND w.label = a.label AND w.cell = c.cell),
  guesses AS (SELECT row_id, fold, y, cell, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY row_id, cell ORDER BY s DESC, label) AS i FROM joint) WHERE i = 1)"""


def _scores_sql(guesses: str) -> str:
    return f"""sides AS (SELECT cell, fold, y AS c FROM {guesses} UNION SELECT cell, fold, prediction FROM {guesses}),
  per_class AS (SELECT s.cell, s.fold, s.c, CAST(count(*) FILTER (WHERE y = c AND prediction = c) AS DOUBLE) AS tp,
      count(*) FILTER (WHERE y = c) AS support, count(*) FILTER (WHERE prediction = c) AS predicted
    FROM sides s JOIN {guesses} g ON g.cell = s.cell AND g.fold = s.fold AND (y = c OR prediction = c) GROUP BY ALL),
  per_fold AS (SELECT cell, fold, avg(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END) AS p, avg(CASE WHEN support > 0 THEN tp / support ELSE 0 END) AS r,
      avg(2 * tp / (support + predicted)) AS f FROM per_class GROUP BY ALL),
  scores AS (SELECT cell, avg(p) AS p, avg(r) AS r, avg(f) AS f FROM per_fold GROUP BY cell)"""


def _nb_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rated(spark, folder)
    vocabulary = features.fit_vocabulary(rows, _words())
    folded = materialise(folds.stratified_folds(rows, "label"))[0]
    counts = _counts(folded, vocabulary, ["row_id", "fold", "label"])
    return bayes.bayes_cv_predictions(counts, folded.drop("review"), vocabulary.size, ALPHAS, PRIORS)


def _nb_scores(spark: SparkSession, folder: str) -> DataFrame:
    return search.name_cells(search.grid_scores(_nb_predictions(spark, folder)), "naive_bayes", _CELLS)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.round(m, 6) for m in ("precision", "recall", "f1")})


@query(f"WITH {_GRID} SELECT row_id, fold, cell, prediction FROM guesses")
def cross_validated_predictions(spark, folder):
    return _nb_predictions(spark, folder).select("row_id", "fold", "cell", "prediction")


@query(f"WITH {_GRID}, {_scores_sql('guesses')} SELECT cell, model, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scores JOIN cells USING (cell)")
def grid_search(spark, folder):
    return _rounded(_nb_scores(spark, folder))


@query(
    f"WITH {_GRID}, {_scores_sql('guesses')} SELECT cell, model, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scores JOIN cells USING (cell) ORDER BY f DESC, cell LIMIT 1"
)
def best_cell(spark, folder):
    return _rounded(search.best_cell(_nb_scores(spark, folder)))


_BEST = f"""best AS (WITH {_GRID}, {_scores_sql('guesses')} SELECT alpha, prior FROM scores JOIN cells USING (cell) ORDER BY f DESC, cell LIMIT 1)"""
_BEST_PRIOR = f"CASE WHEN (SELECT prior FROM best) THEN {_LEARNED} ELSE {_UNIFORM} END"


@query(f"WITH {_BEST}, {_predict_sql('(SELECT alpha FROM best)', _BEST_PRIOR)} SELECT row_id, prediction FROM predicted")
def best_model_refit(spark, folder):
    """The best cell of the grid, fitted again on all rated reviews and applied to every review."""
    best = _CELLS[search.best_cell(_nb_scores(spark, folder)).first()["cell"]]
    vocabulary, model = _fitted(spark, folder)
    rows = reviews(spark, folder).select("row_id", "review")
    counts = _counts(rows, vocabulary, ["row_id"])
    return bayes.predict_bayes(model, rows, counts, best["alpha"], best["fit_prior"]).select("row_id", "prediction")


@query(
    f"""WITH {_GRID}, {_scores_sql('guesses')} SELECT model AS "NombreMod", printf('%.4f', p) AS "Precisión", printf('%.4f', r) AS "Recall", printf('%.4f', f) AS "F_score(macro)"
    FROM scores JOIN cells USING (cell)"""
)
def write_grid_results(spark, folder):
    scores = _nb_scores(spark, folder)
    path = files.write_grid_results(scores, new_path(spark, "grid"))
    back = files.read_reviews(spark, path, ",")
    return back.select("NombreMod", *[F.format_string("%.4f", F.col(f"`{c}`")).alias(c) for c in back.columns if c != "NombreMod"])


@query(f"WITH {_GRID} SELECT cell, model, count(*) AS n_predictions FROM guesses JOIN cells USING (cell) GROUP BY cell, model")
def model_name(spark, folder):
    """Name of every grid cell and how many out-of-fold predictions it made."""
    counted = _nb_predictions(spark, folder).groupBy("cell").agg(F.count("*").alias("n_predictions"))
    return search.name_cells(counted, "naive_bayes", _CELLS).select("cell", "model", "n_predictions")


# ---- nearest neighbours --------------------------------------------------------------------

_POINTS = """points AS (SELECT vec_id AS row_id, label AS y, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"""


def _points(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("label").alias("y"), "embedding")
    return neighbors.dense_vectors(rows, F.col("embedding")).drop("embedding")


def _near(spark: SparkSession, folder: str, p: int) -> DataFrame:
    points = _points(spark, folder)
    near = neighbors.knn(points, points, 5, p, exclude="self")
    return near.select("row_id", "neighbor_id", "position", F.round("distance", 6).alias("distance"))


@query(f"WITH {_POINTS}, {near_sql('near', 'points', 'points', 5, 'a.row_id <> b.row_id')} SELECT row_id, neighbor_id, position, round(distance, 6) AS distance FROM near")
def knn_neighbors(spark, folder):
    return _near(spark, folder, 2)


@query(f"WITH {_POINTS}, {near_sql('near', 'points', 'points', 5, 'a.row_id <> b.row_id', 1)} SELECT row_id, neighbor_id, position, round(distance, 6) AS distance FROM near")
def knn_neighbors_p1(spark, folder):
    return _near(spark, folder, 1)


@query(
    f"""WITH {_FEATURES},
    norms AS (SELECT row_id, CAST(sum(v * v) AS DOUBLE) AS s FROM feats GROUP BY row_id),
    every AS (SELECT r.row_id, coalesce(s, 0) AS s FROM reviews r LEFT JOIN norms USING (row_id)),
    dots AS (SELECT a.row_id, b.row_id AS other, sum(a.v * b.v) AS d FROM feats a JOIN feats b ON a.term = b.term JOIN rated t ON t.row_id = b.row_id GROUP BY ALL),
    pairs AS (SELECT a.row_id, b.row_id AS neighbor_id, sqrt(a.s + b.s - 2 * coalesce(d, 0)) AS distance
      FROM every a JOIN every b ON a.row_id <> b.row_id JOIN rated t ON t.row_id = b.row_id LEFT JOIN dots ON dots.row_id = a.row_id AND dots.other = b.row_id)
    SELECT row_id, neighbor_id, position, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbor_id) AS position FROM pairs) WHERE position <= 3"""
)
def knn_neighbors_text(spark, folder):
    """The 3 rated reviews nearest to every review, by word counts."""
    rated = _rated(spark, folder)
    vocabulary = features.fit_vocabulary(rated, _words())
    spec = classify.JobSpec("score", text_process="bow")
    prepared = classify.Prepared(
        spec, {"numeric": [], "categorical": [], "text": ["review"]}, None, None, None, vocabulary
    )
    rows = reviews(spark, folder).select("row_id", _words().alias(classify.WORDS))
    every = materialise(classify.as_vectors(rows, prepared))[0]
    train = every.join(rated.select("row_id"), "row_id", "left_semi")
    near = neighbors.knn(every, train, 3, 2, exclude="self")
    return near.select("row_id", "neighbor_id", "position", F.round("distance", 6).alias("distance"))


_KNN_CELLS = search.grid_cells({"n_neighbors": [1, 3, 5], "p": [1, 2], "weights": ["distance", "uniform"]})
_KNN_ROWS = ", ".join(f"({i}, {c['n_neighbors']}, {c['p']}, '{c['weights']}')" for i, c in enumerate(_KNN_CELLS))
_KNN = f"""{_POINTS}, {_folds_sql('points')}, spots AS (SELECT p.row_id, p.y, p.v, f.fold FROM points p JOIN folded f USING (row_id)),
  {near_sql('near1', 'spots', 'spots', 5, 'a.fold <> b.fold', 1)}, {near_sql('near2', 'spots', 'spots', 5, 'a.fold <> b.fold', 2)},
  near AS (SELECT *, 1 AS p FROM near1 UNION ALL SELECT *, 2 FROM near2),
  cells AS (SELECT * FROM (VALUES {_KNN_ROWS}) t(cell, k, p, weights)),
  chosen AS (SELECT n.*, c.cell, c.weights, bool_or(n.distance = 0) OVER (PARTITION BY n.row_id, c.cell) AS touching FROM near n JOIN cells c ON c.p = n.p AND n.position <= c.k),
  votes AS (SELECT row_id, cell, other_y, round(sum(CASE WHEN weights = 'uniform' THEN 1.0 WHEN touching THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1 / distance END), 9) AS vote
    FROM chosen GROUP BY row_id, cell, other_y),
  guesses AS (SELECT s.row_id, s.fold, s.y, cell, other_y AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY row_id, cell ORDER BY vote DESC, other_y) AS i FROM votes) JOIN spots s USING (row_id) WHERE i = 1)"""


def _knn_predictions(spark: SparkSession, folder: str) -> DataFrame:
    names = list(range(10))
    points = _points(spark, folder).withColumn("label", F.col("y"))
    held = materialise(folds.stratified_folds(points, "label"))[0]
    votes = classify.knn_predictions(held, held, _KNN_CELLS, names, "fold")
    return votes.join(held.select("row_id", "fold", "label"), "row_id")


@query(f"WITH {_KNN} SELECT row_id, fold, cell, prediction FROM guesses")
def knn_classify(spark, folder):
    return _knn_predictions(spark, folder).select("row_id", "fold", "cell", "prediction")


@query(f"WITH {_KNN}, {_scores_sql('guesses')} SELECT cell, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scores")
def knn_grid(spark, folder):
    return _rounded(search.grid_scores(_knn_predictions(spark, folder)))


# ---- whole jobs ----------------------------------------------------------------------------

_DROPPED = ("reviewId", "date", "location", "gender")


def _job(**changes) -> classify.JobSpec:
    base = {"target": "score", "drop_features": _DROPPED, "scaler": "minmax", "text_process": "tf-idf", "grid": {"alpha": [0.5], "fit_prior": [False]}}
    return classify.JobSpec(**{**base, **changes})


_JOB = f"""{RATED}, labelled AS (SELECT row_id, {sq.pnn('score')} AS label FROM rated),
  middle AS (SELECT median(n_chars) AS m FROM rated), limits AS (SELECT min(coalesce(n_chars, m)) AS low, max(coalesce(n_chars, m)) AS high FROM rated, middle),
  grams AS (SELECT row_id, unnest({sq.WORDS2.format(simplified_sql('review'))}) AS term FROM reviews),
  rated_grams AS (SELECT row_id, term FROM grams JOIN rated USING (row_id)),
  text_terms AS ({sq.vocabulary('rated_grams', 'rated')}),
  vocabulary AS (SELECT 'text:' || term AS term FROM text_terms UNION ALL SELECT 'column:n_chars'),
  tf AS (SELECT row_id, term, count(*) AS n FROM grams GROUP BY row_id, term),
  weighted AS (SELECT row_id, term, n * (ln((1 + (SELECT count(*) FROM rated)) / (1.0 + df)) + 1) AS w FROM tf JOIN text_terms USING (term)),
  feats AS (SELECT row_id, 'text:' || term AS term, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS v FROM weighted
    UNION ALL SELECT row_id, 'column:n_chars', (coalesce(n_chars, m) - low) / (high - low) FROM reviews, middle, limits),
  train AS (SELECT * FROM feats JOIN labelled USING (row_id))"""
_JOB_PREDICTED = _predict_sql(0.5, _UNIFORM).replace(_FEATURES, _JOB)


@query(f"WITH {_JOB_PREDICTED} SELECT row_id, {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)")
def predict(spark, folder):
    """Whole naive Bayes job on rated reviews: clean, impute, scale, TF-IDF, fit; applied to all reviews."""
    trained = classify.train(rated_reviews(spark, folder), _job())
    return classify.predict(trained, reviews(spark, folder)).select("row_id", "label", "prediction")


# With the two categorical columns: the commonest place fills gaps, codes are places in sorted order.
_JOB_ALL = _JOB.replace(
    "grams AS (", """common_place AS (SELECT location AS p FROM rated WHERE location IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  places AS (SELECT location, row_number() OVER (ORDER BY location) - 1 AS code FROM (SELECT DISTINCT coalesce(location, p) AS location FROM rated, common_place)),
  tongues AS (SELECT gender, row_number() OVER (ORDER BY gender) - 1 AS code FROM (SELECT DISTINCT gender FROM rated)),
  grams AS (""", 1
).replace(
    "UNION ALL SELECT 'column:n_chars')", "UNION ALL SELECT 'column:n_chars' UNION ALL SELECT 'column:gender' UNION ALL SELECT 'column:location')"
).replace(
    "FROM reviews, middle, limits)",
    """FROM reviews, middle, limits
    UNION ALL SELECT row_id, 'column:gender', code FROM reviews JOIN tongues USING (gender)
    UNION ALL SELECT row_id, 'column:location', code FROM (SELECT row_id, coalesce(location, p) AS location FROM reviews, common_place) JOIN places USING (location))""",
)
_JOB_ALL_PREDICTED = _predict_sql(0.5, _UNIFORM).replace(_FEATURES, _JOB_ALL)


@query(f"WITH {_JOB_ALL_PREDICTED} SELECT row_id, {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)")
def predict_all_columns(spark, folder):
    """The same job with its categorical columns: they are imputed by mode and encoded."""
    trained = classify.train(rated_reviews(spark, folder), _job(drop_features=("reviewId", "date")))
    return classify.predict(trained, reviews(spark, folder)).select("row_id", "label", "prediction")


@query(f"WITH {_JOB_PREDICTED} SELECT row_id, {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)")
def save_load_model(spark, folder):
    trained = classify.train(rated_reviews(spark, folder), _job())
    path = new_path(spark, "model")
    classify.save(trained, path)
    return classify.predict(classify.load(spark, path), reviews(spark, folder)).select("row_id", "label", "prediction")


@query(
    f"""WITH {_JOB} SELECT r.row_id, {sq.pnn('r.score')} AS label, count(v) FILTER (WHERE v <> 0) AS n_features, coalesce(round(sum(v), 6), 0) AS total
    FROM reviews r LEFT JOIN feats USING (row_id) GROUP BY r.row_id, r.score"""
)
def attach_text_features(spark, folder):
    prepared, _ = classify.fit_preparation(rated_reviews(spark, folder), _job())
    rows = classify.as_vectors(classify.prepared_rows(reviews(spark, folder), prepared), prepared)
    total = F.round(F.aggregate("val", F.lit(0.0), lambda a, x: a + x), 6)
    return rows.select("row_id", "label", F.size("idx").cast("long").alias("n_features"), total.alias("total"))


@query()
def reattach_resampled(spark, folder):
    """SMOTE rows with their label beside the originals."""
    prepared, kept = classify.fit_preparation(rated_reviews(spark, folder), _job(sampling="smote"))
    rows, _ = classify.training_rows(kept, prepared)
    return rows.select("row_id", "label", "fold", F.size("idx").alias("n_features"))


# Fitted on the training split alone: the rated rows of the SQL are those of that split.
_DEV_PREDICTED = _JOB_PREDICTED.replace(
    "rated AS (SELECT * FROM reviews WHERE score IS NOT NULL)",
    "rated AS (SELECT * FROM reviews WHERE score IS NOT NULL AND row_id % 10 < 8)",
)


@query(
    f"""WITH {_DEV_PREDICTED}, judged AS (SELECT {sq.pnn('score')} AS label, prediction FROM reviews JOIN predicted USING (row_id)
      WHERE score IS NOT NULL AND row_id % 10 = 8), {_PER_CLASS} {_REPORT_ROWS}"""
)
def evaluate_dev(spark, folder):
    """Report on the dev split of a job that was trained on the train split."""
    rows = rated_reviews(spark, folder).withColumn("_split", split_of())
    trained = classify.train(rows.where("_split = 'train'").drop("_split"), _job())
    return classify.evaluate(trained, rows.where("_split = 'dev'").drop("_split"))["report"]


def _scores(spark: SparkSession, folder: str, algorithm: str, grid: dict, **changes) -> DataFrame:
    spec = _job(algorithm=algorithm, grid=grid, **changes)
    return classify.train(rated_reviews(spark, folder), spec).scores


@query()
def decision_tree(spark, folder):
    """Scores of trees of any depth, all cells and folds grown at once."""
    grid = {"max_depth": [None, 50], "min_samples_leaf": [1], "min_samples_split": [10], "criterion": ["gini", "entropy"]}
    return _scores(spark, folder, "decision_tree", grid)


@query()
def random_forest(spark, folder):
    """Scores of forests of 100 trees of any depth."""
    grid = {"n_estimators": [100], "max_depth": [None], "min_samples_leaf": [1], "min_samples_split": [2, 10], "criterion": ["gini"]}
    return _scores(spark, folder, "random_forest", grid)


_STUMP_COLUMNS = ("l_quantity", "l_discount", "l_tax")
_STUMP_ENTRIES = " UNION ALL ".join(f"SELECT {i} AS term, {c} AS value, l_linestatus AS y FROM lineitem" for i, c in enumerate(_STUMP_COLUMNS))


@query(
    f"""WITH entries AS ({_STUMP_ENTRIES}), names AS (SELECT DISTINCT l_linestatus AS y FROM lineitem),
    by_value AS (SELECT term, value, y, count(*) AS n FROM entries GROUP BY ALL),
    grid AS (SELECT v.term, v.value, y FROM (SELECT DISTINCT term, value FROM by_value) v, names),
    sums AS (SELECT g.term, g.value, g.y, sum(coalesce(n, 0)) OVER (PARTITION BY g.term, g.y ORDER BY g.value) AS left_n,
      sum(coalesce(n, 0)) OVER (PARTITION BY g.term, g.y) AS whole FROM grid g LEFT JOIN by_value b ON b.term = g.term AND b.value = g.value AND b.y = g.y),
    sides AS (SELECT term, value, sum(left_n) AS n_left, sum(whole) AS n, sum(left_n * left_n) AS l, sum((whole - left_n) * (whole - left_n)) AS r FROM sums GROUP BY term, value),
    cuts AS (SELECT *, round((l / CAST(n_left AS DOUBLE) + r / CAST(n - n_left AS DOUBLE)) / n, 10) AS score FROM sides WHERE n_left < n),
    best AS (SELECT * FROM cuts ORDER BY score DESC, term, value LIMIT 1)
    SELECT CASE WHEN e.value <= b.value THEN 'left' ELSE 'right' END AS side, b.term AS term, e.y AS label, count(*) AS n
    FROM entries e JOIN best b ON e.term = b.term GROUP BY ALL"""
)
def tree_first_cut(spark, folder):
    """The best cut of all line items by three columns, and the classes on its two sides."""
    lines = table(spark, folder, "lineitem").select(F.monotonically_increasing_id().alias("row_id"), "l_linestatus", *_STUMP_COLUMNS)
    names = small_values(lines, "l_linestatus")
    values = F.array(*[F.col(c).cast("double") for c in _STUMP_COLUMNS])
    rows = neighbors.dense_vectors(lines, values).select(
        "row_id", F.lit(0).alias("fold"), bayes.label_index(F.col("l_linestatus"), names).alias("y"), "idx", "val"
    )
    rows = stored(rows, "lines")
    coded = trees.coded(rows, trees.fit_edges(rows), ["row_id", "fold", "y"], len(_STUMP_COLUMNS))
    families = [trees.Family(max_depth=1)]
    # Every row is in one node, which is cut by the distributed rule whatever its size.
    state = trees.start(stored(coded, "codes"), families, [None])
    nodes = trees.grow(state, families, len(names), local_entries=0)[0]
    cut = nodes.where("term IS NOT NULL").select("tree", "node", "term", "code")  # a row for each inner node: one
    sided = state.join(F.broadcast(cut), ["tree", "node"])
    side = F.when(trees.node_code() <= F.col("code"), "left").otherwise("right").alias("side")
    return sided.groupBy(side, "term", F.get(F.array(*map(F.lit, names)), F.col("y")).alias("label")).agg(F.count("*").alias("n"))


@query()
def logistic_regression(spark, folder):
    """Scores of ridge and lasso models after 20 steps."""
    grid = {"C": [1.0], "l1_ratio": [0, 1], "solver": ["saga"], "max_iter": [20]}
    return _scores(spark, folder, "logistic_regression", grid)


@query(
    """SELECT l_returnflag AS label, l_returnflag AS prediction, count(*) AS n
    FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY ALL"""
)
def logistic_separable(spark, folder):
    """A model of a label that is a function of one column has to name it for every line item."""
    lines = table(spark, folder, "lineitem").where("l_returnflag IS NOT NULL")
    lines = lines.select(F.monotonically_increasing_id().alias("row_id"), F.col("l_returnflag").alias("label"), "l_discount", "l_tax")
    names = small_values(lines, "label")
    y = bayes.label_index(F.col("label"), names)
    # An indicator of each flag, and two columns that say nothing.
    rows = lines.select(
        "row_id", "label", F.lit(0).alias("fold"), y.alias("y"),
        F.array(y, F.lit(len(names)), F.lit(len(names) + 1)).cast("array<int>").alias("idx"),
        F.array(F.lit(1.0), F.col("l_discount").cast("double"), F.col("l_tax").cast("double")).alias("val"),
    )
    rows = stored(rows, "lines")
    n_terms = len(names) + 2
    blocks = logistic.pack(rows, n_terms)
    weights = logistic.fit(rows, [logistic.Problem(max_iter=50)], len(names), n_terms, tolerance=0.05, blocks=blocks)
    sums = stored(logistic.margins(blocks, weights, logistic.width(len(names))), "margins")
    blocks.release()
    found = sums.select("row_id", logistic.likeliest(F.col("m"), F.lit(0), len(names)).alias("class"))
    named = found.withColumn("prediction", F.get(F.array(*map(F.lit, names)), F.col("class")))
    return named.join(rows, "row_id").groupBy("label", "prediction").agg(F.count("*").alias("n"))


@query(
    f"""WITH {RATED}, labelled AS (SELECT row_id, {sq.pnn('score')} AS label FROM rated), {_folds_sql('labelled')},
    spaces AS (SELECT CAST(h AS INT) AS held, row_id, label FROM folded, range(5) t(h) WHERE fold <> h),
    sizes AS (SELECT held, label, count(*) AS n FROM spaces GROUP BY held, label),
    sides AS (SELECT *, max(n) OVER (PARTITION BY held) - n AS deficit, min(n) OVER (PARTITION BY held) AS smallest FROM sizes),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY held, label ORDER BY {sq.lehmer('row_id', 42)}, row_id) AS rank FROM spaces),
    draws AS (SELECT held, label, n, unnest(range(deficit)) AS draw FROM sides),
    times AS (SELECT held, label, {sq.wide('draw', 42)} % n + 1 AS rank, count(*) AS times FROM draws GROUP BY ALL)
    SELECT 'oversampling' AS kind, held, row_id, label, CAST(0 AS BIGINT) AS copy FROM spaces
    UNION ALL SELECT 'oversampling', held, row_id, label, unnest(range(1, times + 1)) FROM ranked JOIN times USING (held, label, rank)
    UNION ALL SELECT 'undersampling', held, row_id, label, CAST(0 AS BIGINT) FROM ranked JOIN sides USING (held, label) WHERE rank <= smallest"""
)
def resample_inside_folds(spark, folder):
    """Training rows of each fold, rebalanced without its held-out rows."""
    rows = stored(folds.stratified_folds(_rated(spark, folder).drop("review"), "label"), "folds")
    made = [
        sampling.resample_inside_folds(rows, "label", kind).select(F.lit(kind).alias("kind"), "held", "row_id", "label", "copy")
        for kind in ("oversampling", "undersampling")
    ]
    return made[0].unionByName(made[1])


# ---- topics --------------------------------------------------------------------------------

_MIXTURE = """mixtures AS (SELECT vec_id AS row_id, list_transform(e, lambda x: x / list_sum(e)) AS mixture
  FROM (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x)) AS e FROM embeddings))"""


@query(
    f"""WITH {_MIXTURE} SELECT row_id, CAST(list_position(mixture, list_max(mixture)) - 1 AS INT) AS topic,
    concat(CAST(round(list_max(mixture) * 100, 2) AS VARCHAR), '%') AS percent FROM mixtures"""
)
def dominant_topic(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("e")
    )
    rows = rows.withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    topic, percent = topics.dominant_topic(F.transform("e", lambda x: x / F.col("total")))
    return rows.select("row_id", topic.alias("topic"), percent.alias("percent"))


_COHERENCE = f"""{RATED}, docs AS (SELECT row_id, CASE WHEN score <= 2 THEN 0 WHEN score = 3 THEN 1 ELSE 2 END AS topic, {sq.topic_tokens('review')} AS tokens FROM rated),
  toks AS (SELECT row_id, topic, len(tokens) AS size, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS term FROM docs),
  tops AS (SELECT topic, term FROM (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, term) AS i FROM toks GROUP BY topic, term) WHERE i <= 20),
  wanted AS (SELECT DISTINCT term FROM tops), hits AS (SELECT row_id, size, pos, term FROM toks JOIN wanted USING (term)),
  total AS (SELECT CAST(sum(w) AS DOUBLE) AS windows FROM (SELECT row_id, greatest(any_value(size) - 109, 1) AS w FROM hits GROUP BY row_id)),
  inside AS (SELECT DISTINCT row_id, unnest(range(greatest(1, pos - 109), least(pos, greatest(size - 109, 1)) + 1)) AS start, term FROM hits),
  own AS (SELECT term, count(*) AS n FROM inside GROUP BY term),
  wanted_pairs AS (SELECT DISTINCT a.term AS a, b.term AS b FROM tops a JOIN tops b USING (topic)),
  both_in AS (SELECT x.term AS a, y.term AS b, count(*) AS n FROM inside x JOIN inside y ON x.row_id = y.row_id AND x.start = y.start GROUP BY ALL),
  npmi AS (SELECT p.a, p.b, ln((coalesce(n.n, 0) / windows + 1e-12) / (oa.n / windows * ob.n / windows)) / -ln(coalesce(n.n, 0) / windows + 1e-12) AS x
    FROM wanted_pairs p LEFT JOIN both_in n ON n.a = p.a AND n.b = p.b JOIN own oa ON oa.term = p.a JOIN own ob ON ob.term = p.b, total),
  context AS (SELECT s.topic, s.term AS a, t.term AS b, x FROM tops s JOIN tops t USING (topic) JOIN npmi ON npmi.a = s.term AND npmi.b = t.term),
  whole AS (SELECT topic, b, sum(x) AS y FROM context GROUP BY ALL),
  cosines AS (SELECT topic, a, sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) AS c FROM context JOIN whole USING (topic, b) GROUP BY ALL)"""


@query(f"WITH {_COHERENCE} SELECT topic, round(avg(c), 6) AS coherence FROM cosines GROUP BY topic")
def coherence_cv(spark, folder):
    """Coherence of the 20 most frequent words of each sentiment class, taken as fixed topics."""
    topic = F.when(F.col("score") <= 2, 0).when(F.col("score") == 3, 1).otherwise(2)
    rows = rated_reviews(spark, folder).select("row_id", topic.alias("topic"), tx.topic_tokens(F.col("review")).alias("tokens"))
    rows = materialise(rows)[0]
    counts = rows.select("topic", F.explode("tokens").alias("word")).groupBy("topic", "word").agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("n"), "word"))
    words = counts.withColumn("i", best).where(F.col("i") <= topics.TOP_WORDS).select("topic", "word")
    return topics.coherence_cv(rows, words).withColumn("coherence", F.round("coherence", 6))


BANDS = ("negative", "neutral", "positive")
# The job's range of topic numbers.
KS = (2, 10, 1)


def _each_band(spark: SparkSession, folder: str, make) -> DataFrame:
    """``make`` of every band's rows and dictionary, one below the other, with the band's name."""
    every = topic_plan.banded_tokens(rated_reviews(spark, folder), topic_plan.TopicSpec(bands=BANDS))
    every = materialise(every)[0]

    def of_band(band: str) -> DataFrame | None:
        rows = every.where(F.col("sentiment") == band)
        dictionary = topics.build_dictionary(rows)
        return make(rows, dictionary).withColumn("sentiment", F.lit(band)) if dictionary.size else None

    # Updates follow each other, so the bands' jobs are queued side by side.
    with ThreadPoolExecutor(len(BANDS)) as pool:
        parts = [part for part in pool.map(of_band, BANDS) if part is not None]
    return reduce(DataFrame.unionByName, parts)


@query()
def lda_fit(spark, folder):
    """Topic mixture of every review under three topics of its band."""

    def mixtures(rows: DataFrame, dictionary: features.Vocabulary) -> DataFrame:
        model = topics.fit_topics(rows, dictionary, 3)
        mixed = model.transform(rows).select("row_id", F.posexplode("mixture").alias("topic", "share"))
        return mixed.withColumn("share", F.round("share", 4))

    return _each_band(spark, folder, mixtures)


@query(
    f"""WITH {RATED}, docs AS (SELECT row_id, {sq.pnn('score')} AS sentiment, {sq.topic_tokens('review')} AS tokens FROM rated),
    sizes AS (SELECT sentiment, count(*) AS documents FROM docs GROUP BY sentiment),
    toks AS (SELECT row_id, sentiment, unnest(tokens) AS term FROM docs),
    counted AS (SELECT sentiment, term, count(DISTINCT row_id) AS df, count(*) AS n FROM toks GROUP BY ALL),
    kept AS (SELECT c.*, documents FROM counted c JOIN sizes USING (sentiment) WHERE df >= 5 AND df <= 0.85 * documents),
    top AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY df DESC, term) <= 100000)
    SELECT sentiment, any_value(documents) AS documents, CAST(any_value(documents) AS DOUBLE) AS mixture_mass,
      count(*) AS words, CAST(sum(n) AS DOUBLE) AS word_mass FROM top GROUP BY sentiment"""
)
def topic_mass(spark, folder):
    """What a model's weights and mixtures add up to: all words of the dictionary in the documents, and all documents.

    With all documents in one batch, the weights over their priors hold each word's occurrences once.
    """
    k = 3

    def masses(rows: DataFrame, dictionary: features.Vocabulary) -> DataFrame:
        model = topics.fit_topics(rows, dictionary, k, passes=2, chunk_docs=max(1, dictionary.n_docs))
        above = F.aggregate("x", F.lit(0.0), lambda a, x: a + x - 1.0 / k)
        weighed = model.weights.where(F.col("term_id") < dictionary.size).agg(
            F.count("*").alias("words"), F.round(F.sum(above), 3).alias("word_mass")
        )
        share = F.aggregate("mixture", F.lit(0.0), lambda a, x: a + x)
        mixed = model.transform(rows).agg(F.count("*").alias("documents"), F.round(F.sum(share), 3).alias("mixture_mass"))
        both = mixed.unionByName(weighed, allowMissingColumns=True)  # one row each
        return both.agg(*[F.max(c).alias(c) for c in ("documents", "mixture_mass", "words", "word_mass")])

    return _each_band(spark, folder, masses)


@query()
def topic_keywords(spark, folder):
    """Heaviest words of three topics per band."""
    return _each_band(
        spark, folder, lambda rows, dictionary: topics.topic_keywords(topics.fit_topics(rows, dictionary, 3))
    )


def _curves(spark: SparkSession, folder: str) -> DataFrame:
    return _each_band(
        spark, folder, lambda rows, dictionary: topics.coherence_curve(rows, dictionary, topics.k_range(*KS))
    )


@query()
def coherence_curve(spark, folder):
    """Coherence for each number of topics of the job's range, per band."""
    return _curves(spark, folder)


def _chosen(curves: DataFrame, manual: dict[str, int]) -> DataFrame:
    found: dict[str, list] = {}
    # One row per band and number of topics.
    for row in curves.orderBy("sentiment", "k").collect():
        found.setdefault(row["sentiment"], []).append((row["k"], row["coherence"]))
    chosen = [(band, topics.choose_k(curve, manual.get(band))) for band, curve in found.items()]
    return curves.sparkSession.createDataFrame(chosen, "sentiment string, k int")


@query()
def k_sweep(spark, folder):
    """The curve of each band, and which number of topics it chooses."""
    curves = _curves(spark, folder)
    best = _chosen(curves, {}).select("sentiment", F.col("k").alias("_k"))
    return curves.join(F.broadcast(best), "sentiment").withColumn("chosen", F.col("k") == F.col("_k")).drop("_k")


@query()
def k_choice(spark, folder):
    """The number of topics per band: swept, but for one that is set by hand."""
    return _chosen(_curves(spark, folder), {"positive": 3})


_MANUAL = {"positive": 3, "neutral": 3}


@query()
def topics_per_band(spark, folder):
    """The whole topic job with trigram phrases; every band's number of topics is swept."""
    spec = topic_plan.TopicSpec(n_gram="trigram")
    done = topic_plan.run_topics(rated_reviews(spark, folder), spec)["assignments"]
    return done.select("row_id", "score", "sentiment", "Topico_Dominante", "Porcentaje_Similitud")


@query()
def write_topic_assignments(spark, folder):
    """The files of a job that sweeps one band and is told the number of topics of the others."""
    done = topic_plan.run_topics(rated_reviews(spark, folder), topic_plan.TopicSpec(manual_k=_MANUAL))["assignments"]
    path = files.write_topic_assignments(done, new_path(spark, "assignments"), "music", "unigram")
    return files.read_reviews(spark, path, ";")
