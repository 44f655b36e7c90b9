"""Registered queries: rebalancing, sampling, and the request and answer tables of model jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import labels, prompts
from opinara.operators import augment, neighbors, sampling
from opinara.operators.distributions import score_distribution as count_scores
from opinara.plans import sqltext as sq
from opinara.plans.catalog_text import CLEAN_LINES_SQL
from opinara.plans.sqltext import RATED, REVIEWS, lehmer, wide
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


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return rated_reviews(spark, folder).select("row_id", labels.rating_to_pnn(F.col("score")).alias("label"), "review")


_LABELLED = f"""{RATED}, labelled AS (SELECT row_id, {sq.pnn('score')} AS label, review FROM rated),
  sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
  ranked AS (SELECT row_id, label, review, row_number() OVER (PARTITION BY label ORDER BY {lehmer('row_id', 42)}, row_id) AS rank FROM labelled)"""


@query(
    f"""WITH {_LABELLED},
    draws AS (SELECT label, n, unnest(range((SELECT max(n) FROM sizes) - n)) AS draw FROM sizes),
    picks AS (SELECT label, {wide('draw', 42)} % n + 1 AS rank FROM draws),
    times AS (SELECT label, rank, count(*) AS times FROM picks GROUP BY label, rank)
    SELECT row_id, label, CAST(0 AS BIGINT) AS copy FROM labelled
    UNION ALL SELECT row_id, label, unnest(range(1, times + 1)) FROM ranked JOIN times USING (label, rank)"""
)
def random_oversample(spark, folder):
    return sampling.random_oversample(labelled(spark, folder).drop("review"), "label")


@query(f"""WITH {_LABELLED} SELECT row_id, label FROM ranked WHERE rank <= (SELECT min(n) FROM sizes)""")
def random_undersample(spark, folder):
    return sampling.random_undersample(labelled(spark, folder).drop("review"), "label")


@query(f"""WITH {_LABELLED} SELECT row_id, label FROM labelled""")
def sampling_none(spark, folder):
    return labelled(spark, folder).drop("review")


# Three classes of uneven size from the ten labels.
_VECTORS = """vectors AS (SELECT vec_id AS row_id, CASE WHEN label <= 5 THEN 0 WHEN label <= 8 THEN 1 ELSE 2 END AS y,
  CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    y = F.when(F.col("label") <= 5, 0).when(F.col("label") <= 8, 1).otherwise(2)
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), y.alias("y"), "embedding")
    return neighbors.dense_vectors(rows, F.col("embedding")).drop("embedding")


def near_sql(name: str, left: str, right: str, k: int, on: str, p: int = 2) -> str:
    away = (
        "sqrt(round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 12))"
        if p == 2
        else "round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1] - z[2]))), 12)"
    )
    return f"""{name} AS (SELECT * FROM (SELECT a.row_id, b.row_id AS neighbor_id, b.y AS other_y, {away} AS distance,
      row_number() OVER (PARTITION BY a.row_id ORDER BY {away}, b.row_id) AS position
      FROM {left} a JOIN {right} b ON {on}) WHERE position <= {k})"""


_SMOTE = f"""{_VECTORS}, sizes AS (SELECT y, count(*) AS n FROM vectors GROUP BY y),
  ranked AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {lehmer('row_id', 42)}, row_id) AS base_rank FROM vectors),
  {near_sql('near', 'vectors', 'vectors', 5, 'a.y = b.y AND a.row_id <> b.row_id')},
  draws AS (SELECT y, n, unnest(range((SELECT max(n) FROM sizes) - n)) AS draw FROM sizes),
  picks AS (SELECT y, draw, draw * 1048576 + y AS seed_id, {wide('draw * 1048576 + y', 42)} % n + 1 AS base_rank FROM draws),
  made AS (SELECT concat(p.y, '-', p.draw) AS synthetic_id, r.row_id, p.y, {lehmer('p.seed_id', 101)} % 5 + 1 AS position,
    {lehmer(lehmer('p.seed_id', 202))} / 2147483647.0 AS u FROM picks p JOIN ranked r USING (y, base_rank))"""
_MADE_ROWS = """SELECT m.synthetic_id, m.row_id, n.neighbor_id, round(m.u, 6) AS u, m.y,
    round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] + m.u * (z[2] - z[1]))), 6) AS total,
    round(a.v[1] + m.u * (b.v[1] - a.v[1]), 6) AS first
  FROM made m JOIN near n ON n.row_id = m.row_id AND n.position = m.position JOIN vectors a ON a.row_id = m.row_id JOIN vectors b ON b.row_id = n.neighbor_id"""


def _made(df: DataFrame) -> DataFrame:
    total = F.aggregate("val", F.lit(0.0), lambda a, x: a + x)
    return df.select(
        "synthetic_id",
        "row_id",
        "neighbor_id",
        F.round("u", 6).alias("u"),
        "y",
        F.round(total, 6).alias("total"),
        F.round(F.get("val", F.lit(0)), 6).alias("first"),
    )


@query(f"WITH {_SMOTE} {_MADE_ROWS}")
def smote(spark, folder):
    return _made(sampling.smote(vectors(spark, folder)))


_DRAWN = f"{lehmer('row_id')} * 2147483648 + draw"
_ADASYN = f"""{_VECTORS}, sizes AS (SELECT y, count(*) AS n FROM vectors GROUP BY y),
  minority AS (SELECT v.* FROM vectors v JOIN sizes USING (y) WHERE n < (SELECT max(n) FROM sizes)),
  {near_sql('around', 'minority', 'vectors', 5, 'a.row_id <> b.row_id')},
  shares AS (SELECT a.row_id, m.y, count(*) FILTER (WHERE other_y <> m.y) / 5.0 AS other_share FROM around a JOIN minority m USING (row_id) GROUP BY ALL),
  quotas AS (SELECT row_id, y, other_share, CAST(round_even(round(other_share * (((SELECT max(n) FROM sizes) - n) / sum(other_share) OVER (PARTITION BY y)), 9), 0) AS BIGINT) AS quota
    FROM shares JOIN sizes USING (y))"""


@query(f"WITH {_ADASYN} SELECT row_id, y, CAST(other_share AS DOUBLE) AS other_share, quota FROM quotas")
def adasyn_quota(spark, folder):
    return sampling.adasyn_quota(vectors(spark, folder))


@query(
    f"""WITH {_ADASYN}, {near_sql('near', 'minority', 'minority', 5, 'a.y = b.y AND a.row_id <> b.row_id')},
    draws AS (SELECT row_id, y, unnest(range(quota)) AS draw FROM quotas),
    made AS (SELECT concat(row_id, '-', draw) AS synthetic_id, row_id, y, {lehmer(_DRAWN, 101)} % 5 + 1 AS position,
      {lehmer(lehmer(_DRAWN, 202))} / 2147483647.0 AS u FROM draws) {_MADE_ROWS}"""
)
def adasyn(spark, folder):
    return _made(sampling.adasyn(vectors(spark, folder)))


@query(f"""WITH {REVIEWS} SELECT row_id, review FROM reviews ORDER BY {lehmer('row_id', 42)}, row_id LIMIT 100""")
def sample_n(spark, folder):
    return sampling.sample_n(reviews(spark, folder).select("row_id", "review"), 100)


_EXAMPLES = """asked AS (SELECT b.*, s.n AS pool, unnest(range(least({k}, s.n))) AS i FROM batches b JOIN sizes s USING (label)),
  listed AS (SELECT label, batch, list(review ORDER BY i) AS examples FROM asked JOIN ranked USING (label)
    WHERE ranked.rank = (asked.batch * {k} + asked.i) % asked.pool + 1 GROUP BY label, batch)"""


@query(
    f"""WITH {_LABELLED}, batches AS (SELECT label, unnest(range(CAST(ceil(n / 10.0) AS BIGINT))) AS batch FROM sizes),
    {_EXAMPLES.format(k=3)} SELECT label, batch, array_to_string(examples, chr(10)) AS examples FROM listed"""
)
def sample_examples(spark, folder):
    rows = labelled(spark, folder)
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / 10.0).alias("batches"))
    batches = sizes.select("label", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("batch"))
    picked = sampling.pick_examples(batches, rows, "label", "review", 3)
    return picked.select("label", "batch", F.array_join("examples", "\n").alias("examples"))


@query(
    f"""WITH {_LABELLED}, wanted AS (SELECT row_id AS number, label FROM labelled)
    SELECT number, label, ranked.row_id AS donor FROM wanted JOIN sizes USING (label) JOIN ranked USING (label)
    WHERE ranked.rank = {wide('number', 42)} % n + 1"""
)
def sample_base_row(spark, folder):
    rows = labelled(spark, folder).withColumn("donor", F.col("row_id"))
    wanted = rows.select(F.col("row_id").alias("number"), "label")
    return sampling.base_rows(wanted, rows, "label", "number", ["donor"])


# ---- model jobs ----------------------------------------------------------------------------

_N = 100
_PLAN_CLASSIFY = f"""{REVIEWS}, plan AS (SELECT row_id, score, review, CAST(row_id AS VARCHAR) AS prompt_id,
  concat('{prompts.CLASSIFY.replace("{text}", "', coalesce(review, ''), '")}') AS prompt, CAST(0 AS DOUBLE) AS temperature, 3 AS num_predict
  FROM reviews ORDER BY {lehmer('row_id', 42)}, row_id LIMIT {_N})"""


@query(f"WITH {_PLAN_CLASSIFY} SELECT * FROM plan")
def llm_classify_plan(spark, folder):
    return augment.classify_plan(reviews(spark, folder).select("row_id", "score", "review"), _N)


# Answers stand in for a model: they are made from scores and texts, some are errors, some missing.
_RESPONSES_SQL = """responses AS (SELECT CAST(row_id AS VARCHAR) AS prompt_id,
  CASE WHEN score >= 4 THEN ' Positivo.' WHEN score <= 2 THEN 'Es NEGATIVO' WHEN gender = 'fr' THEN NULL ELSE review END AS response,
  CASE WHEN score IS NULL AND gender = 'fr' THEN 'timeout' END AS error FROM reviews WHERE gender <> 'es')"""


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    score = F.col("score")
    french = F.col("gender") == "fr"
    response = F.when(score >= 4, " Positivo.").when(score <= 2, "Es NEGATIVO").when(~french, F.col("review"))
    return reviews(spark, folder).where(F.col("gender") != "es").select(
        F.col("row_id").cast("string").alias("prompt_id"),
        response.alias("response"),
        F.when(score.isNull() & french, "timeout").alias("error"),
    )


_JUDGE = """CASE WHEN error IS NOT NULL OR response IS NULL THEN 'DESCONOCIDO' WHEN contains(lower(response), 'positivo') THEN 'Positivo'
  WHEN contains(lower(response), 'negativo') THEN 'Negativo' WHEN contains(lower(response), 'neutro') THEN 'Neutro' ELSE 'DESCONOCIDO' END"""
_COLLECT = f"""WITH {_PLAN_CLASSIFY}, {_RESPONSES_SQL}
  SELECT row_id, prompt_id, {_JUDGE} AS prediccion, coalesce(error, trim(response, chr(32) || chr(9) || chr(10)), 'no response') AS salida_modelo
  FROM plan LEFT JOIN responses USING (prompt_id)"""


@query(_COLLECT)
def llm_classify_collect(spark, folder):
    done = augment.classify_collect(llm_classify_plan(spark, folder), _responses(spark, folder))
    return done.select("row_id", "prompt_id", "prediccion", "salida_modelo")


@query(_COLLECT)
def write_llm_labels(spark, folder):
    path = files.write_answer_labels(llm_classify_collect(spark, folder), new_path(spark, "answers"))
    return files.read_reviews(spark, path, ",", T.StructType.fromDDL(
        "row_id long, prompt_id string, prediccion string, salida_modelo string"
    ))


_SPANISH = f"""{RATED}, labelled AS (SELECT row_id, {sq.spanish('score')} AS label, score, review, gender, location, date FROM rated),
  sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
  ranked AS (SELECT row_id, label, review, gender, location, date, row_number() OVER (PARTITION BY label ORDER BY {lehmer('row_id', 42)}, row_id) AS rank FROM labelled)"""
_BY_SCORE = f"""{RATED}, labelled AS (SELECT row_id, score AS label, score, review, gender, location, date FROM rated),
  sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
  ranked AS (SELECT row_id, label, review, gender, location, date, row_number() OVER (PARTITION BY label ORDER BY {lehmer('row_id', 42)}, row_id) AS rank FROM labelled)"""
_BALANCE_QUOTAS = """quotas AS (SELECT label, target_score, (SELECT max(n) FROM sizes) - coalesce(n, 0) AS quota
  FROM (VALUES ('Negativo', 2), ('Neutro', 3)) t(label, target_score) LEFT JOIN sizes USING (label) WHERE (SELECT max(n) FROM sizes) > coalesce(n, 0))"""
_FIXED_QUOTAS = """quotas AS (SELECT 'Neutro' AS label, 3 AS target_score, CAST(1000 AS BIGINT) AS quota)"""
_PERCENT_QUOTAS = f"""quotas AS (SELECT label, label AS target_score, CAST(round_even(n * 0.5, 0) AS BIGINT) AS quota, {sq.spanish('label')} AS name
  FROM (SELECT label, n FROM sizes ORDER BY n, label LIMIT 3) WHERE round_even(n * 0.5, 0) > 0)"""


def _plan_sql(base: str, quotas: str, settings: dict, template: str, run: str, name: str = "label") -> str:
    size, k = settings["per_prompt"], settings["examples"]
    text = "'" + template.replace("'", "''") + "'"
    for key, value in {"n": "size", "label": name, "examples": "examples"}.items():
        text = text.replace("{" + key + "}", f"', {value}, '")
    return f"""{base}, {quotas},
  batches AS (SELECT *, least({size}, quota - batch * {size}) AS size FROM (SELECT *, unnest(range(CAST(ceil(quota / {size}.0) AS BIGINT))) AS batch FROM quotas)),
  asked AS (SELECT b.*, s.n AS pool, unnest(range(least({k}, s.n))) AS i FROM batches b JOIN sizes s USING (label)),
  listed AS (SELECT asked.* EXCLUDE (i), string_agg('- ' || review, chr(10) ORDER BY i) AS examples FROM asked JOIN ranked
    ON ranked.label = asked.label AND ranked.rank = (asked.batch * {k} + asked.i) % asked.pool + 1 GROUP BY ALL),
  plan AS (SELECT concat('{run}-', label, '-', batch) AS prompt_id, label AS "group", target_score, quota, batch, size, {size} AS per_prompt,
    concat({text}) AS prompt, CAST({settings['temperature']} AS DOUBLE) AS temperature, {settings['num_predict']} AS num_predict FROM listed)"""


_PLAN_BALANCE = _plan_sql(_SPANISH, _BALANCE_QUOTAS, augment.BALANCE, prompts.PARAPHRASE, "balance")
_PLAN_FIXED = _plan_sql(_SPANISH, _FIXED_QUOTAS, augment.FIXED, prompts.PARAPHRASE_NEUTRAL, "fixed")
_PLAN_PERCENT = _plan_sql(_BY_SCORE, _PERCENT_QUOTAS, augment.PERCENT, prompts.PARAPHRASE, "percent", "name")


@query(f"WITH {_PLAN_BALANCE} SELECT * FROM plan")
def augment_plan_balance(spark, folder):
    return augment.plan_balance(rated_reviews(spark, folder))


@query(f"WITH {_PLAN_FIXED} SELECT * FROM plan")
def augment_plan_fixed(spark, folder):
    return augment.plan_fixed(rated_reviews(spark, folder))


@query(f"WITH {_PLAN_PERCENT} SELECT * FROM plan")
def augment_plan_percent(spark, folder):
    return augment.plan_percent(rated_reviews(spark, folder))


# The answer to a request is the text of the review whose id is the request's batch number, line by line.
_LINES_SQL = f"""answers AS (SELECT p.prompt_id, r.review AS response, CASE WHEN r.gender = 'es' THEN 'timeout' END AS error
    FROM plan p JOIN reviews r ON r.row_id = p.batch),
  cleaned AS (SELECT p.*, {CLEAN_LINES_SQL.format('a.response')} AS l FROM plan p JOIN answers a USING (prompt_id) WHERE a.error IS NULL),
  lines AS (SELECT * FROM (SELECT * EXCLUDE (l), generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line FROM cleaned) WHERE pos < size)"""


def _answers(spark: SparkSession, folder: str, plan: DataFrame) -> DataFrame:
    texts = reviews(spark, folder).select(F.col("row_id").alias("batch"), F.col("review").alias("response"), "gender")
    error = F.when(F.col("gender") == "es", "timeout")
    return plan.select("prompt_id", "batch").join(texts, "batch").select("prompt_id", "response", error.alias("error"))


_GENERATED_SQL = f"""{_LINES_SQL}, generated AS (
  SELECT concat('gen_', left(sha256(concat('balance|', prompt_id, '|', CAST(pos AS VARCHAR))), 16)) AS "reviewId", line AS review,
    CAST(target_score AS INT) AS score, k.gender, k.location, k.date
  FROM lines x JOIN sizes s ON s.label = x."group" JOIN ranked k ON k.label = x."group" AND k.rank = {wide('x.batch * x.per_prompt + x.pos', 42)} % s.n + 1)"""


def _generated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = rated_reviews(spark, folder)
    plan = augment.plan_balance(rows)
    named = rows.withColumn("label", labels.score_to_label(F.col("score")))
    made = augment.augment_collect(
        plan, _answers(spark, folder, plan), named, "label", ["gender", "location", "date"], "balance"
    )
    return rows, made


@query(f"WITH {_PLAN_BALANCE}, {_GENERATED_SQL} SELECT * FROM generated")
def augment_collect(spark, folder):
    return _generated(spark, folder)[1]


_UNION_SQL = f"""WITH {_PLAN_BALANCE}, {_GENERATED_SQL} SELECT "reviewId", review, score, gender, location, date, false AS is_generated FROM rated
  UNION ALL SELECT *, true FROM generated"""


@query(_UNION_SQL)
def union_generated(spark, folder):
    return augment.union_generated(*_generated(spark, folder))


@query(f"""WITH {_PLAN_BALANCE}, {_GENERATED_SQL} SELECT "reviewId", review, CAST(score AS BIGINT) AS score, gender, location, date, 'full' AS part FROM rated
  UNION ALL SELECT *, 'full' FROM generated UNION ALL SELECT *, 'generated' FROM generated""")
def write_augmented(spark, folder):
    full, generated = files.write_augmented(union_generated(spark, folder), new_path(spark, "augmented"))
    return files.read_reviews(spark, full).withColumn("part", F.lit("full")).unionByName(
        files.read_reviews(spark, generated).withColumn("part", F.lit("generated"))
    )


@query(
    f"""WITH {_PLAN_BALANCE}, {_GENERATED_SQL}, every AS (SELECT score, 0 AS added FROM rated UNION ALL SELECT score, 1 FROM generated)
    SELECT score, count(*) FILTER (WHERE added = 0) AS before, count(*) AS after FROM every GROUP BY score"""
)
def distribution_after(spark, folder):
    rows, made = _generated(spark, folder)
    before = count_scores(rows).withColumnRenamed("n", "before")
    after = count_scores(augment.union_generated(rows, made)).withColumnRenamed("n", "after")
    return after.join(before, "score", "left").select("score", F.coalesce("before", F.lit(0)).alias("before"), "after")


@query(
    f"""WITH {_PLAN_BALANCE}, {_LINES_SQL}, received AS (SELECT "group", count(*) AS received FROM lines GROUP BY 1)
    SELECT q.label AS "group", q.target_score, q.quota, received, q.quota - received AS remaining FROM quotas q JOIN received r ON r."group" = q.label
    WHERE q.quota > received"""
)
def augment_remaining(spark, folder):
    plan = augment.plan_balance(rated_reviews(spark, folder))
    return augment.augment_remaining(plan, _answers(spark, folder, plan))
