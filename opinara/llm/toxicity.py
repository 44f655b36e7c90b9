"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon is a short fixed list plus words and word beginnings that labelled rows show to be toxic: they must occur in
several toxic documents after several different words, so that copies of one document teach nothing. A training row's
features leave its own label out of the lexicon's counts. Trees are fitted on three quarters of a bounded sample, the
calibration on the rest. Scoring reads each whole text once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.session import new_path

# Labelled rows that a fit uses at most, by label (0, 1); chosen by a hash of the id.
SAMPLE_ROWS = (9_000, 3_000)
# A term of the lexicon: documents and different preceding words it needs, least log-odds, most terms.
FEWEST_DOCS, FEWEST_CONTEXTS, LEAST_ODDS, MOST_TERMS = 3, 3, 3.5, 20_000
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.7
NEAR = 6
KEPT_TOKENS = 150_000

# Common insults, and second-person words of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers trash scum clown pathetic worthless disgusting fool fools jerk"
    " imbecile dimwit vermin filth garbage hateful ugly shut".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine euch euer sie ihr tu te toi ton ta tes vous votre vos"
    " tú ti tuyo usted ustedes vosotros su".split()
)
LEET = str.maketrans("013457@$!|*", "oieastasil_")
EDGE = re.compile(r"^\W+|\W+$")
INSIDE = re.compile(r"[^\W\d_][\d@$!|*][^\W\d_]")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
CAPITALS = bytes(range(65, 91))
SIGNS = b"!?.,;:'\"-()[]{}*#@$%&|<>"
FEATURES = (
    "hits_per_word", "odds_per_word", "hits", "distinct_hits", "top_odds", "insults_per_word", "hits_near_you",
    "you_per_word", "capitals", "capital_words", "exclamations", "signs", "obfuscated", "stretched", "words",
)


def terms(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a trailing hyphen."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


def plain(token: str) -> str:
    return EDGE.sub("", token).lower()


@dataclass
class Lexicon:
    """Documents of each label that hold a term, and documents of each label."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    clean: int = 0
    toxic: int = 0

    def odds(self, word: str, own: int | None) -> float:
        """The largest log-odds among a word's terms, 0 if none counts; ``own`` is the label to leave out."""
        best = 0.0
        for term in terms(word):
            found = self.counts.get(term)
            if found:
                clean, toxic = found[0] - (own == 0), found[1] - (own == 1)
                if toxic >= FEWEST_DOCS - 1:
                    rate = (toxic + 0.5) / (self.toxic + 1)
                    best = max(best, math.log(rate * (self.clean + 1) / (clean + 0.5)))
        return best if best >= LEAST_ODDS else 0.0


class Reader:
    """Features of texts under a lexicon; what a token says is worked out once per worker."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.kept: dict[int | None, dict[str, tuple[float, int]]] = {}
        # Most tokens say one of few things, which need not be kept more than once.
        self.same: dict[tuple[float, int], tuple[float, int]] = {}

    def token(self, token: str, own: int | None) -> tuple[float, int]:
        word = plain(token)
        flags = 0
        odds = self.lexicon.odds(word, own)
        bare = word
        if not word.isalpha() and INSIDE.search(word):
            flags |= 8
            bare = word.translate(LEET)
            odds = max(odds, self.lexicon.odds(bare, own))
        if word in INSULTS or bare in INSULTS:
            flags |= 1
        if word in SECOND_PERSON:
            flags |= 2
        if len(word) > 2 and token.isupper():
            flags |= 4
        if STRETCHED.search(word):
            flags |= 16
        return odds, flags

    def features(self, text: str, own: int | None = None) -> list[float]:
        tokens = text.split()
        kept = self.kept.setdefault(own, {})
        if len(kept) > KEPT_TOKENS:
            kept.clear()
        for token in set(tokens):
            if token not in kept:
                said = self.token(token, own)
                kept[token] = self.same.setdefault(said, said)
        known = [kept[token] for token in tokens]
        n = max(len(tokens), 1)
        flags = np.fromiter((k[1] for k in known), dtype=np.int64, count=len(known))
        hits = [(i, k[0]) for i, k in enumerate(known) if k[0] or k[1] & 1]
        you = np.flatnonzero(flags & 2)
        near = 0
        if hits and len(you):
            at = np.array([i for i, _ in hits])
            place = np.searchsorted(you, at)
            gap = np.minimum(
                np.abs(you[np.minimum(place, len(you) - 1)] - at), np.abs(you[np.maximum(place - 1, 0)] - at)
            )
            near = int((gap <= NEAR).sum())
        data = text.encode(errors="replace")
        size = max(len(data), 1)
        share = lambda bit: float(np.count_nonzero(flags & bit)) / n
        return [
            len(hits) / n, sum(o for _, o in hits) / n, math.log1p(len(hits)),
            math.log1p(len({plain(tokens[i]) for i, _ in hits})), max((o for _, o in hits), default=0.0), share(1),
            near / n, share(2), (len(data) - len(data.translate(None, CAPITALS))) / size, share(4),
            data.count(b"!") / n, (len(data) - len(data.translate(None, SIGNS))) / size, share(8), share(16), math.log1p(len(tokens)),
        ]


def sampled_labels(labels: DataFrame, trains: Column) -> DataFrame:
    """At most SAMPLE_ROWS (doc_id, toxic) of the rows that may train, by a hash of the id."""
    rows = labels.where(trains & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    steps = 1 << 20
    limit = {t: math.floor(steps * min(1.0, SAMPLE_ROWS[t] / counts.get(t, 1))) for t in (0, 1)}
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0])
    return rows.where(chosen)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms of toxic documents that several of them use in several contexts, counted by label."""
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                rows, before = set(), ""
                for word in map(plain, text.as_py().split()):
                    rows.update((term, before) for term in terms(word) if word)
                    before = word
                own = pa.array([doc.as_py()] * len(rows), pa.int64())
                columns = [pa.array([row[n] for row in rows], pa.string()) for n in (0, 1)]
                yield pa.RecordBatch.from_arrays([own, *columns], ["doc_id", "term", "before"])

    toxic = sample.where("toxic = 1").mapInArrow(contexts, "doc_id long, term string, before string")
    seen = toxic.groupBy("term").agg(F.countDistinct("doc_id").alias("docs"), F.countDistinct("before").alias("contexts"))
    seen = seen.where((F.col("docs") >= FEWEST_DOCS) & (F.col("contexts") >= FEWEST_CONTEXTS))
    common_first = seen.orderBy(F.desc("docs"), "term").limit(MOST_TERMS).collect()
    in_toxic = {r["term"]: r["docs"] for r in common_first}

    def holding(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, int] = {}
        for text in batch.column("text").to_pylist():
            words = {plain(t) for t in text.split()}
            for term in {t for w in words for t in terms(w)} & in_toxic.keys():
                found[term] = found.get(term, 0) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "docs"]
        )

    clean = common.map_batches(sample.where("toxic = 0"), "term string, docs long", holding)
    in_clean = {r["term"]: r["docs"] for r in clean.groupBy("term").agg(F.sum("docs").alias("docs")).collect()}
    lexicon = Lexicon({}, counts.get(0, 0), counts.get(1, 0))
    for term, docs in in_toxic.items():
        lexicon.counts[term] = (in_clean.get(term, 0), docs)
        if not lexicon.odds(term, None):
            del lexicon.counts[term]
    return lexicon


def with_features(docs: DataFrame, lexicon: Lexicon, text: str, keep: list[str], own: str | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the features of each whole text; null counts as empty."""
    fields = [docs.schema[name] for name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "_features array<double>"])
    readers: list[Reader] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not readers:
            readers.append(Reader(lexicon))
        labels = batch.column(own).to_pylist() if own else [None] * batch.num_rows
        rows = [
            readers[0].features(t or "", label) for t, label in zip(batch.column(text).to_pylist(), labels, strict=True)
        ]
        columns = [batch.column(name) for name in keep] + [pa.array(rows, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, [*keep, "_features"])

    return common.map_batches(docs, schema, work)


@dataclass
class Model:
    """A lexicon, trees and a calibration; without trees every score is 0."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def fit(docs: DataFrame, labels: DataFrame, trains: Column | None = None, text: str = "text", iterations: int = 20) -> Model:
    """Fit on labelled documents (labels: doc_id, toxic) for which ``trains`` holds; both classes are needed."""
    chosen = sampled_labels(labels.select("doc_id", "toxic"), F.lit(True) if trains is None else trains)
    body = docs.select("doc_id", common.whole_text(text).alias("text"))
    # At most sum(SAMPLE_ROWS) ids.
    path = new_path(docs.sparkSession, "toxicity-sample")
    body.join(F.broadcast(chosen), "doc_id").write.parquet(path)
    sample = docs.sparkSession.read.parquet(path)
    lexicon = learn_lexicon(sample)
    if not lexicon.clean or not lexicon.toxic:
        return Model(lexicon)
    rows = with_features(sample, lexicon, "text", ["doc_id", "toxic"], own="toxic")
    rows = rows.select(
        F.col("toxic").cast("double").alias("label"),
        array_to_vector("_features").alias("features"),
        (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).alias("_calibrates"),
    )
    path = new_path(docs.sparkSession, "toxicity-features")
    rows.coalesce(2).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path).coalesce(2).persist()
    fitted, rest = rows.where("NOT _calibrates"), rows.where("_calibrates")
    if fitted.select("label").distinct().count() < 2 or rest.select("label").distinct().count() < 2:
        fitted = rest = rows
    trees = GBTClassifier(maxIter=iterations, maxDepth=4, stepSize=0.2, subsamplingRate=1.0, seed=7).fit(fitted)
    margins = trees.transform(rest).select("label", vector_to_array("probability")[1].alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    rows.unpersist()
    return Model(lexicon, trees, calibration)


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """``docs`` (its columns ``keep``, or all) with a score from 0 to 1; null and empty texts are scored too.

    Equal texts have equal scores; a column called like the score is replaced; an empty table stays empty.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != name]
    rows = with_features(docs, model.lexicon, text, keep)
    if model.trees is None:
        return rows.drop("_features").withColumn(name, F.lit(0.0))
    trees, calibration = model.trees.copy(), model.calibration
    trees.setFeaturesCol("_vector").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_probability")
    raw = trees.transform(rows.withColumn("_vector", array_to_vector("_features")))
    raw = raw.withColumn("_margin", vector_to_array("_probability")[1])
    calibrated = calibration.setFeaturesCol("_margin").setPredictionCol("_calibrated").transform(raw)
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_calibrated")))
    return calibrated.select(*keep, bounded.alias(name))


def may_train(id_column: str = "doc_id") -> Column:
    return F.coalesce(common.remainder(id_column, 3) != 1, F.lit(False))


def scored(docs: DataFrame, folder: str, keep: list[str]) -> DataFrame:
    """``docs`` scored by a model of the tables in ``folder``."""
    spark = docs.sparkSession
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = fit(common.documents(spark, folder), labels, may_train())
    return score(docs, model, keep=keep, name="score")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(common.documents(spark, folder).select("doc_id", "text"), folder, ["doc_id"])
    return rows.select(
        "doc_id",
        F.coalesce(common.remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
