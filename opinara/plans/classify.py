"""The classifier job: prepare, search the grid, refit, evaluate, predict, save and load."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from opinara.functions import text as tx
from opinara.functions.labels import rating_to_pnn
from opinara.functions.numbers import quoted
from opinara.operators import bayes, features, logistic, mlmodels, neighbors, prepare, sampling, search, trees
from opinara.operators.distributions import feature_roles
from opinara.operators.folds import stratified_folds
from opinara.operators.metrics import classification_report, confusion, confusion_matrix, f1_micro_macro
from opinara.operators.ranks import class_ranks
from opinara.session import lookup_join, materialise, new_path, sized, small_values, stored, work_dir

# Columns of the job itself; no source column is called so inside, whatever its name outside.
WORDS = "_words"

ML_MODELS = {
    "decision_tree": DecisionTreeClassificationModel,
    "random_forest": RandomForestClassificationModel,
    "logistic_regression": LogisticRegressionModel,
}


@dataclass(frozen=True)
class JobSpec:
    """Settings of a training run; names follow the job's configuration file."""

    target: str
    algorithm: str = "naive_bayes"
    grid: dict = field(default_factory=lambda: {"alpha": [1.0], "fit_prior": [True]})
    average: str = "macro"
    pnn: bool = True
    sampling: str = "none"
    scaler: str = "standard"
    unique_category_threshold: int = 20
    text_process: str = "tf-idf"
    ngram_range: tuple = (1, 1)
    language: str = "english"
    impute_num: str = "median"
    impute_cat: str = "mode"
    num_constant: int | None = None
    cat_constant: str | None = None
    drop_features: tuple = ()
    min_df: int = 5
    max_df: float = 0.8
    # Fit trees and logistic regression by pyspark.ml; ``allow_approx`` then takes settings it has no exact match for.
    library: bool = False
    allow_approx: bool = False
    # Weights of a logistic model up to which pyspark.ml holds them on the driver; larger models are fitted as tables.
    driver_weights: int = 1_000_000
    # Learn the fills of missing values on every table anew instead of on the training table alone.
    refit_on_input: bool = False


@dataclass
class Prepared:
    """State fitted on the training table and reused on every later table."""

    spec: JobSpec
    roles: dict
    imputer: prepare.Imputer
    encoder: prepare.LabelEncoder
    scaler: prepare.Scaler
    vocabulary: features.Vocabulary | None
    term_ids: DataFrame | None = None
    text_ids: DataFrame | None = None

    @property
    def plain_columns(self) -> list[str]:
        return self.roles["numeric"] + self.roles["categorical"]

    @property
    def inner_columns(self) -> list[str]:
        """What the plain columns are called in prepared rows."""
        return [f"_x{i}" for i in range(len(self.plain_columns))]

    @property
    def n_terms(self) -> int:
        return len(self.plain_columns) + (self.vocabulary.size if self.vocabulary else 0)


@dataclass
class TreeModel:
    """Nodes of all trees of the best cell, and the edges that turn values into codes."""

    nodes: DataFrame
    edges: DataFrame
    trees: int


@dataclass
class Trained:
    prepared: Prepared
    labels: list
    cell: dict
    scores: DataFrame
    model: object


def with_row_id(df: DataFrame) -> DataFrame:
    """Number the rows of a file. The numbers are written out, so that later scans agree on them."""
    work_dir(df.sparkSession)
    return df.withColumn("row_id", F.monotonically_increasing_id()).checkpoint()


def _label(df: DataFrame, spec: JobSpec) -> Column:
    return rating_to_pnn(quoted(spec.target)) if spec.pnn else quoted(spec.target)


def _with_words(df: DataFrame, prepared: Prepared) -> DataFrame:
    """Add the word array: n-grams over all text columns, cleaned and joined."""
    spec = prepared.spec
    if WORDS in df.columns:
        return df
    texts = [tx.simplify_text(quoted(c), spec.language) for c in prepared.roles["text"]]
    single = df.withColumn(WORDS, tx.two_char_words(tx.concat_texts(*texts)))
    return single.withColumn(WORDS, tx.ngrams(F.col(WORDS), *spec.ngram_range))


def fit_fills(df: DataFrame, roles: dict, spec: JobSpec) -> prepare.Imputer:
    return prepare.fit_imputer(
        df, roles["numeric"], roles["categorical"], spec.impute_num, spec.impute_cat, spec.num_constant, spec.cat_constant
    )


def fit_preparation(train: DataFrame, spec: JobSpec) -> tuple[Prepared, DataFrame]:
    """The fitted preparation, and the training table with its cleaned words kept for reuse."""
    kept = prepare.drop_features(train, list(spec.drop_features))
    roles = feature_roles(kept.drop("row_id"), spec.target, spec.unique_category_threshold)
    imputer = fit_fills(kept, roles, spec)
    whole = imputer.apply(kept)
    encoder = prepare.fit_label_encoder(whole, roles["categorical"])
    scaler = prepare.fit_scaler(encoder.apply(whole), roles["numeric"], spec.scaler)
    prepared = Prepared(spec, roles, imputer, encoder, scaler, None)
    if roles["text"] and spec.text_process in ("tf-idf", "bow"):
        # Cleaning is the costly step: it is done once, and the raw texts are not kept beside the words.
        kept = stored(_with_words(kept, prepared).drop(*roles["text"]), "words")
        prepared.vocabulary = features.fit_vocabulary(imputer.apply(kept), F.col(WORDS), spec.min_df, spec.max_df)
    return prepared, kept


def prepared_rows(df: DataFrame, prepared: Prepared) -> DataFrame:
    """row_id, label (if the target is there), numeric and encoded columns, and the word array."""
    spec = prepared.spec
    kept = prepare.drop_features(df, list(spec.drop_features))
    whole = (fit_fills(kept, prepared.roles, spec) if spec.refit_on_input else prepared.imputer).apply(kept)
    scaled = prepared.scaler.apply(prepared.encoder.apply(whole))
    if prepared.vocabulary is not None:
        worded = _with_words(scaled, prepared)
    else:
        worded = scaled.withColumn(WORDS, F.array().cast("array<string>"))
    label = [_label(df, spec).alias("label")] if spec.target in df.columns else []
    plain = [quoted(c).alias(inner) for c, inner in zip(prepared.plain_columns, prepared.inner_columns, strict=True)]
    return worded.select("row_id", *label, *plain, WORDS)


def _plain_long(rows: DataFrame, prepared: Prepared, carry: list[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(f"column:{c}").alias("term"), F.col(inner).cast("double").alias("value"))
        for c, inner in zip(prepared.plain_columns, prepared.inner_columns, strict=True)
    ]
    return rows.select(*carry, F.inline(F.array(*entries))).where(F.col("value") != 0)


def _long_rows(rows: DataFrame, prepared: Prepared, carry: list[str]) -> DataFrame:
    """(carry..., term, value): text terms as ``text:term``, other columns as ``column:name``."""
    parts = [_plain_long(rows, prepared, carry)] if prepared.plain_columns else []
    if prepared.vocabulary is not None:
        if prepared.spec.text_process == "tf-idf":
            terms = features.tf_idf(rows, F.col(WORDS), prepared.vocabulary, carry)
        else:
            counts = features.bag_of_words(rows, F.col(WORDS), prepared.vocabulary, carry)
            terms = counts.withColumn("value", F.col("n").cast("double"))
        parts.append(terms.select(*carry, F.concat(F.lit("text:"), "term").alias("term"), "value"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def term_numbers(prepared: Prepared) -> DataFrame:
    """(term, term_id): plain columns first, then the vocabulary numbered by distributed ranks."""
    if prepared.term_ids is None:
        columns = prepared.plain_columns
        spark = SparkSession.active()
        table = spark.createDataFrame([(f"column:{c}", i) for i, c in enumerate(columns)], "term string, term_id int")
        if prepared.vocabulary is not None:
            keyed = prepared.vocabulary.terms.select("term", F.xxhash64("term").alias("row_id"))
            ranked = class_ranks(keyed, F.lit(0), rank="at")
            number = (F.col("at") - 1 + len(columns)).cast("int")
            table = table.unionByName(ranked.select(F.concat(F.lit("text:"), "term").alias("term"), number.alias("term_id")))
        prepared.term_ids = materialise(table)[0]
    return prepared.term_ids


def as_long(rows: DataFrame, prepared: Prepared, carry: list[str]) -> DataFrame:
    if "idx" not in rows.columns:
        return _long_rows(rows, prepared, carry)
    tall = rows.select(*carry, F.inline(F.arrays_zip(F.col("idx").alias("term_id"), F.col("val").alias("value"))))
    named = lookup_join(tall, term_numbers(prepared), ["term_id"], table_rows=prepared.n_terms)
    return named.select(*carry, "term", "value")


def _text_ids(prepared: Prepared) -> DataFrame:
    """(term, df, term_id) of the vocabulary."""
    if prepared.text_ids is None:
        named = prepared.vocabulary.terms.withColumn("_name", F.concat(F.lit("text:"), "term"))
        numbers = term_numbers(prepared).withColumnRenamed("term", "_name")
        prepared.text_ids = materialise(named.join(numbers, "_name").select("term", "df", "term_id"))[0]
    return prepared.text_ids


def as_vectors(rows: DataFrame, prepared: Prepared) -> DataFrame:
    """The rows with sparse ``idx`` and ``val`` arrays; a row without features has empty ones.

    Words become numbers before they are shuffled, once; counting, gathering and scaling stay where a row's words came together.
    """
    if "idx" in rows.columns:
        return rows
    parts = []
    at = rows.withColumn("_at", F.monotonically_increasing_id())  # rows that share an id are counted apart
    if prepared.plain_columns:  # the first numbers are those of the plain columns
        entries = [F.struct(F.lit(i).alias("term_id"), F.col(c).cast("double").alias("value")) for i, c in enumerate(prepared.inner_columns)]
        plain = at.select("row_id", "_at", F.inline(F.array(*entries))).where(F.col("value") != 0)
        parts.append(plain.withColumn("df", F.lit(None).cast("long")))
    if prepared.vocabulary is not None:
        words = at.select("row_id", "_at", F.explode_outer(WORDS).alias("term")).where(F.col("term").isNotNull())
        known = lookup_join(words, _text_ids(prepared), ["term"], table_rows=prepared.vocabulary.size)
        parts.append(known.select("row_id", "_at", "term_id", F.lit(None).cast("double").alias("value"), "df"))
    tall = parts[0]
    for part in parts[1:]:
        tall = tall.unionByName(part)
    counted = tall.repartition("row_id").groupBy("row_id", "_at", "term_id", "value", "df").agg(F.count("*").alias("n"))
    is_plain, tf_idf = F.col("df").isNull(), prepared.vocabulary is not None and prepared.spec.text_process == "tf-idf"
    weight = features.idf_weight(prepared.vocabulary) if tf_idf else F.col("n").cast("double")
    tall = counted.select("row_id", "term_id", F.when(is_plain, F.col("value")).otherwise(weight).alias("value"), is_plain.alias("_plain"))
    entry = F.struct("term_id", "value")
    listed = tall.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("_plain"), entry))).alias("_p"),
        F.sort_array(F.collect_list(F.when(~F.col("_plain"), entry))).alias("_t"),
    )
    texts = F.col("_t.value")
    if tf_idf:
        # The length stands in an array of one, so that it is computed once per row and not once per value.
        length = F.array(F.sqrt(F.aggregate(texts, F.lit(0.0), lambda a, w: a + w * w)))
        texts = F.get(F.transform(length, lambda n: F.transform(texts, lambda w: w / n)), F.lit(0))
    listed = listed.select("row_id", F.concat("_p.term_id", "_t.term_id").alias("idx"), F.concat("_p.value", texts).alias("val"))
    joined = rows.drop(WORDS, *prepared.inner_columns).join(listed, "row_id", "left")
    none = F.array()
    return joined.select(
        *[c for c in joined.columns if c not in ("idx", "val")],
        F.coalesce(F.col("idx"), none.cast("array<int>")).alias("idx"),
        F.coalesce(F.col("val"), none.cast("array<double>")).alias("val"),
    )


def as_assembled(rows: DataFrame, prepared: Prepared) -> DataFrame:
    """The rows with one sparse ``features`` vector.

    Rows are vectorised inside the JVM without a shuffle. Of rebalanced rows only the sparse arrays are there, old and
    new ones alike, numbered by ``term_numbers``; they become vectors inside the JVM, too.
    """
    if "idx" in rows.columns:
        return sparse_vectors(rows, prepared.n_terms)
    if prepared.vocabulary is None:
        return mlmodels.assemble(rows, [], prepared.inner_columns, None).transform(rows)
    stages = mlmodels.text_stages(prepared.vocabulary, WORDS, "text_vector", prepared.spec.text_process)
    done = mlmodels.assemble(rows, stages, prepared.inner_columns, "text_vector").transform(rows)
    return done.drop(WORDS, "text_vector", "text_vector_n", "text_vector_w")


def _library_rows(rows: DataFrame, prepared: Prepared) -> DataFrame:
    """What the library's models read. Logistic regression does not depend on the order of terms, so its rows go by
    ``term_numbers`` and are stored: no step of a fit carries the vocabulary in its tasks."""
    if prepared.spec.algorithm == "logistic_regression":
        rows = as_vectors(rows, prepared)
    return as_assembled(rows, prepared)


def sparse_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``features`` in place of the arrays ``idx`` and ``val``, without leaving the JVM.

    A vector is stored as a struct of its kind, size, places and values; written as such a struct it is read back as
    a vector.
    """
    kind = F.lit(0).cast("tinyint").alias("type")
    parts = F.struct(kind, F.lit(size).alias("size"), F.col("idx").alias("indices"), F.col("val").alias("values"))
    made = rows.withColumn("features", parts).drop("idx", "val")
    path = new_path(rows.sparkSession, "vectors")
    made.write.parquet(path)
    fields = [StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in made.schema.fields]
    return rows.sparkSession.read.schema(StructType(fields)).parquet(path)


def _drawn_rows(df: DataFrame, spec: JobSpec) -> DataFrame:
    """Random over- or undersampling of the raw rows; copies get ids behind the largest one."""
    kind = spec.sampling.lower()
    if kind not in ("oversampling", "undersampling"):
        return df
    labelled = df.withColumn("_label", _label(df, spec))
    if kind == "undersampling":
        return sampling.random_undersample(labelled, "_label").drop("_label")
    grown = stored(sampling.random_oversample(labelled, "_label").drop("_label"), "oversampled")
    copies = behind(df, grown.where("copy > 0").drop("copy"), F.col("row_id"))
    return grown.where("copy = 0").drop("copy").unionByName(copies)


def behind(rows: DataFrame, new: DataFrame, key: Column) -> DataFrame:
    """``new`` with row ids that follow the largest one of ``rows`` without gaps, in a pseudo-random order of ``key``.

    Ranks grow with the number of rows only, whatever the ids are.
    """
    last = rows.agg(F.max("row_id")).first()[0] or 0
    ranked = class_ranks(new.withColumn("_key_of", key), F.lit(0), row_id="_key_of", rank="_at")
    return ranked.withColumn("row_id", F.col("_at") + last).select(*new.columns)


def _synthetic_rows(rows: DataFrame, prepared: Prepared, labels: list) -> DataFrame:
    """SMOTE or ADASYN on the feature vectors: row_id, label, idx, val of all rows, old and new."""
    held = stored(as_vectors(rows, prepared).withColumn("y", bayes.label_index(F.col("label"), labels)), "vectors")
    made = sampling.smote(held) if prepared.spec.sampling.lower() == "smote" else sampling.adasyn(held)
    numbered = behind(held, stored(made, "synthetic"), F.xxhash64("synthetic_id"))
    name = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("y") + 1)
    columns = ["row_id", name.alias("label"), "idx", "val"]
    return stored(held.select(*columns).unionByName(numbered.select(*columns)), "rebalanced")


def training_rows(df: DataFrame, prepared: Prepared, vectors: bool = False) -> tuple[DataFrame, list]:
    """Rebalanced training rows with their cross-validation fold, and the class labels.

    Rebalancing comes before the folds are cut. With ``vectors`` words become vectors before, too, and no word is ranked.
    """
    spec = prepared.spec
    rows = prepared_rows(_drawn_rows(df, spec), prepared)
    labels = small_values(rows, "label")
    if spec.sampling.lower() in ("smote", "adasyn"):
        rows = _synthetic_rows(rows, prepared, labels)
    elif vectors:
        rows = stored(as_vectors(rows, prepared), "vectors")
    return stratified_folds(rows, "label"), labels


def train(df: DataFrame, spec: JobSpec) -> Trained:
    """Fit the preparation, score the whole grid by 5-fold cross-validation and refit the best cell.

    ``df`` holds a unique ``row_id`` and the target beside the features.
    """
    prepared, kept = fit_preparation(df, spec)
    by_library = spec.library and spec.algorithm != "logistic_regression"
    rows, labels = training_rows(kept, prepared, spec.algorithm != "naive_bayes" and not by_library)
    cells = search.grid_cells(spec.grid)
    carry = ["row_id", "fold", "label"]
    if spec.algorithm == "naive_bayes":
        rows = stored(rows, "rows")
        long = stored(as_long(rows, prepared, carry), "terms")
        alphas, priors = spec.grid.get("alpha", [1.0]), spec.grid.get("fit_prior", [True])
        cells = [{"alpha": a, "fit_prior": b} for a in alphas for b in priors]
        predictions = bayes.bayes_cv_predictions(long, rows.select(*carry), prepared.n_terms, alphas, priors)
        scores = search.name_cells(search.grid_scores(predictions, spec.average), spec.algorithm, cells)
        scores = stored(scores, "scores")
        best = cells[search.best_cell(scores).first()["cell"]]
        model = bayes.fit_bayes(long, rows.select(*carry), prepared.n_terms)
    elif spec.algorithm == "kNN":
        model = as_vectors(rows, prepared).withColumn("y", bayes.label_index(F.col("label"), labels))
        model = stored(model, "neighbours")
        predictions = knn_predictions(model, model, cells, labels, "fold").join(model.select(*carry), "row_id")
        scores = search.name_cells(search.grid_scores(predictions, spec.average), spec.algorithm, cells)
        scores = stored(scores, "scores")
        best = cells[search.best_cell(scores).first()["cell"]]
    elif _by_trees(spec):
        scores, best, model = _train_trees(rows, prepared, cells, labels)
    elif _by_gradients(prepared, labels):
        scores, best, model = _train_logistic(rows, prepared, cells, labels)
    else:
        assembled = _library_rows(rows, prepared)
        if "idx" in rows.columns:  # each part costs a step all weights of a model
            entries = rows.agg(F.sum(F.size("idx"))).first()[0] or 0
            assembled = assembled.coalesce(max(1, -(-entries // FIT_ENTRIES)))
        assembled = assembled.persist()
        scores = mlmodels.grid_search(assembled, spec.algorithm, spec.grid, spec.average, allow_approx=spec.allow_approx)
        best = cells[search.best_cell(scores).first()["cell"]]
        model = mlmodels.fit_model(assembled, spec.algorithm, best, labels, allow_approx=spec.allow_approx)
        assembled.unpersist()
    return Trained(prepared, labels, best, scores, model)


# Entries of a part of the rows that a library model is fitted on.
FIT_ENTRIES = 2_000_000
# Trees that are grown in one pass; each of them has its own copy of its rows.
PASS_TREES = 512


def _by_trees(spec: JobSpec) -> bool:
    return spec.algorithm in ("decision_tree", "random_forest") and not spec.library


def tree_search(coded: DataFrame, algorithm: str, cells: list[dict], n_terms: int, labels: list, n_folds: int = 5) -> DataFrame:
    """(row_id, cell, prediction) of every row by the trees of every cell that were grown without its fold."""
    found, families, held = None, [], []
    every = [(i, trees.family_of(algorithm, cell, n_terms), fold) for i, cell in enumerate(cells) for fold in range(n_folds)]
    if (coded.agg(F.sum(F.size("terms"))).first()[0] or 0) <= trees.LOCAL_ENTRIES:
        families, held = [f for _, f, _ in every], [fold for *_, fold in every]
        shares = trees.held_shares(coded, families, held, len(labels))
        cell = F.get(F.array(*[F.lit(i) for i, *_ in every]), F.floor(F.col("tree") / trees.TREES).cast("int"))
        found, every = stored(trees.voted(shares, cell, len(labels)), "tree-votes"), []
    while every:
        batch = [every.pop(0)]
        while every and sum(f.trees for _, f, _ in batch) + every[0][1].trees <= PASS_TREES:
            batch.append(every.pop(0))
        families, held = [f for _, f, _ in batch], [fold for *_, fold in batch]
        shares = trees.grow(trees.start(coded, families, held), families, len(labels))[1]
        cell = F.get(F.array(*[F.lit(i) for i, *_ in batch]), F.floor(F.col("tree") / trees.TREES).cast("int"))
        votes = stored(trees.voted(shares, cell, len(labels)), "tree-votes")
        found = votes if found is None else found.unionByName(votes)
    return found.select("row_id", F.col("family").alias("cell"), _class_name(labels).alias("prediction"))


def _class_name(labels: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in labels]), F.col("class"))


def _train_trees(rows: DataFrame, prepared: Prepared, cells: list[dict], labels: list) -> tuple[DataFrame, dict, TreeModel]:
    spec = prepared.spec
    held = stored(as_vectors(rows, prepared).withColumn("y", bayes.label_index(F.col("label"), labels)), "vectors")
    edges, _ = materialise(trees.fit_edges(held))
    coded = stored(trees.coded(held, edges, ["row_id", "fold", "y"], prepared.n_terms), "codes")
    predictions = tree_search(coded, spec.algorithm, cells, prepared.n_terms, labels).join(held.select("row_id", "fold", "label"), "row_id")
    scores = stored(search.name_cells(search.grid_scores(predictions, spec.average), spec.algorithm, cells), "scores")
    best = cells[search.best_cell(scores).first()["cell"]]
    family = trees.family_of(spec.algorithm, best, prepared.n_terms)
    nodes, _ = trees.grow(trees.start(coded, [family], [None]), [family], len(labels))
    return scores, best, TreeModel(stored(nodes, "trees"), edges, family.trees)


def _predict_trees(model: TreeModel, rows: DataFrame, prepared: Prepared, labels: list) -> DataFrame:
    asked = trees.coded(as_vectors(rows, prepared), model.edges, ["row_id"], prepared.n_terms)
    shares = trees.predict(model.nodes, stored(asked, "codes"), list(range(model.trees)))
    return trees.voted(shares, F.lit(0), len(labels)).select("row_id", _class_name(labels).alias("prediction"))


def _by_gradients(prepared: Prepared, labels: list) -> bool:
    """Whether a logistic model is too large for the driver, or has settings that the library refuses."""
    spec = prepared.spec
    if spec.algorithm != "logistic_regression" or spec.library:
        return False
    refused = any(mlmodels.estimator(spec.algorithm, cell, 1) is None for cell in search.grid_cells(spec.grid))
    return refused or prepared.n_terms * logistic.width(len(labels)) > spec.driver_weights


def _train_logistic(
    rows: DataFrame, prepared: Prepared, cells: list[dict], labels: list, n_folds: int = 5
) -> tuple[DataFrame, dict, DataFrame]:
    spec = prepared.spec
    indexed = as_vectors(rows, prepared).withColumn("y", bayes.label_index(F.col("label"), labels)).where("y IS NOT NULL")
    held = stored(indexed, "vectors")
    blocks = logistic.pack(held, prepared.n_terms)
    problems = [logistic.problem_of(cell, fold) for cell in cells for fold in range(n_folds)]
    weights = logistic.fit(held, problems, len(labels), prepared.n_terms, blocks=blocks)
    sums = logistic.margins(blocks, weights, logistic.width(len(labels)) * len(problems))
    # Of each cell, the problem that did not see the row's fold.
    votes = [logistic.likeliest(F.col("m"), F.col("fold") + i * n_folds, len(labels)) for i in range(len(cells))]
    voted = stored(sums.select("row_id", F.posexplode(F.array(*votes)).alias("cell", "class")), "votes")
    named = voted.select("row_id", "cell", _class_name(labels).alias("prediction"))
    predictions = named.join(held.select("row_id", "fold", "label"), "row_id")
    scores = stored(search.name_cells(search.grid_scores(predictions, spec.average), spec.algorithm, cells), "scores")
    best = cells[search.best_cell(scores).first()["cell"]]
    model = logistic.fit(held, [logistic.problem_of(best, None)], len(labels), prepared.n_terms, blocks=blocks)
    blocks.release()
    return scores, best, model


def _predict_logistic(model: DataFrame, rows: DataFrame, prepared: Prepared, labels: list) -> DataFrame:
    blocks = logistic.pack(as_vectors(rows, prepared), prepared.n_terms)
    sums = stored(logistic.margins(blocks, model, logistic.width(len(labels))), "margins")
    blocks.release()
    found = sums.withColumn("class", logistic.likeliest(F.col("m"), F.lit(0), len(labels)))
    return found.select("row_id", _class_name(labels).alias("prediction"))


def knn_predictions(queries: DataFrame, held: DataFrame, cells: list[dict], labels: list, exclude: str = "none") -> DataFrame:
    """(row_id, cell, prediction) of every grid cell; one neighbour search per p serves all k and weights."""
    result = None
    for p in sorted({cell.get("p", 2) for cell in cells}):
        mine = [{"n_neighbors": 5, **cell, "cell": i} for i, cell in enumerate(cells) if cell.get("p", 2) == p]
        near = neighbors.knn(queries, held, max(c["n_neighbors"] for c in mine), p, exclude)
        votes = neighbors.knn_votes(near, mine, labels)
        result = votes if result is None else result.unionByName(votes)
    return result


def _predict_bayes(trained: Trained, rows: DataFrame) -> DataFrame:
    """``bayes.predict_bayes`` on ``as_long`` without the shuffles of single values between them.

    Words meet their weights and the model in one join, and a row's sums are scaled instead of its values.
    """
    prepared, model = trained.prepared, trained.model
    alpha, fit_prior = trained.cell["alpha"], trained.cell["fit_prior"]
    if prepared.vocabulary is None:
        return bayes.predict_bayes(model, rows.select("row_id"), as_long(rows, prepared, ["row_id"]), alpha, fit_prior)
    sums = bayes.row_sums(model, alpha)
    names = ["mass", *[f"t{j}" for j in range(len(model.labels))]]
    known = prepared.vocabulary.terms.withColumn("_name", F.concat(F.lit("text:"), "term"))
    known = known.join(sized(model.table.withColumnRenamed("term", "_name")), "_name", "left").drop("_name")
    counts = features.term_counts(rows, F.col(WORDS), ["row_id"])
    found = lookup_join(counts, known, ["term"], table_rows=prepared.vocabulary.size)
    tf_idf = prepared.spec.text_process == "tf-idf"
    weight = features.idf_weight(prepared.vocabulary) if tf_idf else F.col("n").cast("double")
    found = found.select("row_id", weight.alias("value"), "mass")
    squares = F.sum(F.col("value") * F.col("value")) if tf_idf else F.lit(1.0)
    per_row = found.groupBy("row_id").agg(*sums, squares.alias("_squares"))
    per_row = per_row.select("row_id", *[(F.col(c) / F.sqrt("_squares")).alias(c) for c in names])
    if prepared.plain_columns:
        plain = lookup_join(_plain_long(rows, prepared, ["row_id"]), model.table.where("term LIKE 'column:%'"), ["term"])
        both = per_row.unionByName(plain.groupBy("row_id").agg(*sums))
        per_row = both.groupBy("row_id").agg(*[F.sum(c).alias(c) for c in names])
    return bayes.predict_by_sums(model, rows.select("row_id"), per_row, alpha, fit_prior)


def predict(trained: Trained, df: DataFrame) -> DataFrame:
    """The rows of ``df`` with ``label`` (if the target is there) and ``prediction``.

    Source columns of these names come back as ``source_label`` and ``source_prediction``.
    """
    prepared = trained.prepared
    rows = prepared_rows(df, prepared)
    algorithm = prepared.spec.algorithm
    if algorithm == "naive_bayes":
        done = _predict_bayes(trained, rows)
    elif algorithm == "kNN":
        done = knn_predictions(as_vectors(rows, prepared), trained.model, [trained.cell], trained.labels)
    elif _by_trees(prepared.spec):
        done = _predict_trees(trained.model, rows, prepared, trained.labels)
    elif _by_gradients(prepared, trained.labels):
        done = _predict_logistic(trained.model, rows, prepared, trained.labels)
    else:
        done = mlmodels.predict_model(trained.model, _library_rows(rows, prepared), trained.labels)
    # A source column called like one of the two stays as it is under another name.
    taken = {c: f"source_{c}" for c in ("label", "prediction") if c in df.columns and c != prepared.spec.target}
    named = df.withColumnsRenamed(taken)
    if prepared.spec.target in named.columns:
        named = named.withColumn("label", _label(named, prepared.spec))
    return named.join(done.select("row_id", "prediction"), "row_id", "left")


def evaluate(trained: Trained, df: DataFrame) -> dict[str, DataFrame]:
    """Best cell, F1 averages, report and confusion matrix from one stored prediction table."""
    scored = stored(predict(trained, df).select("label", "prediction"), "scored")
    counts = confusion(scored)
    return {
        "best": search.best_cell(trained.scores),
        "f1": f1_micro_macro(counts),
        "report": classification_report(counts),
        "confusion": confusion_matrix(scored),
    }


def save(trained: Trained, path: str) -> None:
    """Write the fitted state: settings as one JSON line, tables as Parquet, library models as such."""
    prepared = trained.prepared
    spark = SparkSession.active()
    state = {
        "spec": asdict(prepared.spec),
        "roles": prepared.roles,
        "imputer": asdict(prepared.imputer),
        "encoder": prepared.encoder.classes,
        "scaler": asdict(prepared.scaler),
        "n_docs": prepared.vocabulary.n_docs if prepared.vocabulary else None,
        "labels": trained.labels,
        "cell": trained.cell,
    }
    algorithm = prepared.spec.algorithm
    if algorithm == "naive_bayes":
        state["bayes"] = {"class_rows": trained.model.class_rows, "class_mass": trained.model.class_mass}
        trained.model.table.write.mode("overwrite").parquet(f"{path}/model")
    elif algorithm == "kNN" or _by_gradients(prepared, trained.labels):
        trained.model.write.mode("overwrite").parquet(f"{path}/model")
        term_numbers(prepared).write.mode("overwrite").parquet(f"{path}/term_ids")
    elif _by_trees(prepared.spec):
        state["trees"] = trained.model.trees
        trained.model.nodes.write.mode("overwrite").parquet(f"{path}/model")
        trained.model.edges.write.mode("overwrite").parquet(f"{path}/edges")
        term_numbers(prepared).write.mode("overwrite").parquet(f"{path}/term_ids")
    else:
        trained.model.write().overwrite().save(f"{path}/model")
        if algorithm == "logistic_regression":
            term_numbers(prepared).write.mode("overwrite").parquet(f"{path}/term_ids")
    if prepared.vocabulary is not None:
        prepared.vocabulary.terms.write.mode("overwrite").parquet(f"{path}/vocabulary")
    trained.scores.write.mode("overwrite").parquet(f"{path}/scores")
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").text(f"{path}/state")


def load(spark: SparkSession, path: str) -> Trained:
    state = json.loads(spark.read.text(f"{path}/state").first()[0])
    spec = JobSpec(**{**state["spec"], "ngram_range": tuple(state["spec"]["ngram_range"])})
    imputer = prepare.Imputer(state["imputer"]["fills"], tuple(state["imputer"]["drop"]))
    scaler = prepare.Scaler(**{**state["scaler"], "columns": tuple(state["scaler"]["columns"])})
    prepared = Prepared(spec, state["roles"], imputer, prepare.LabelEncoder(state["encoder"]), scaler, None)
    if state["n_docs"] is not None:
        terms, size = materialise(spark.read.parquet(f"{path}/vocabulary"))
        prepared.vocabulary = features.Vocabulary(terms, size, state["n_docs"])
    if spec.algorithm == "naive_bayes":
        table = spark.read.parquet(f"{path}/model")
        model = bayes.BayesModel(table, state["labels"], n_terms=prepared.n_terms, **state["bayes"])
    elif spec.algorithm == "kNN" or _by_gradients(prepared, state["labels"]):
        model = spark.read.parquet(f"{path}/model")
        prepared.term_ids = spark.read.parquet(f"{path}/term_ids")
    elif _by_trees(spec):
        model = TreeModel(spark.read.parquet(f"{path}/model"), spark.read.parquet(f"{path}/edges"), state["trees"])
        prepared.term_ids = spark.read.parquet(f"{path}/term_ids")
    else:
        model = ML_MODELS[spec.algorithm].load(f"{path}/model")
        if spec.algorithm == "logistic_regression":
            prepared.term_ids = spark.read.parquet(f"{path}/term_ids")
    return Trained(prepared, state["labels"], state["cell"], spark.read.parquet(f"{path}/scores"), model)
