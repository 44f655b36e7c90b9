import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import odd_documents
from pyspark.sql import functions as F

from opinara.llm import weighted_sampling


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    pairs = []
    for _ in range(60):
        a = rng.choices(words, weights=range(1, 31), k=rng.randint(20, 80))
        b = [w if rng.random() < rng.random() else rng.choice(words) for w in a] + rng.choices(words, k=5)
        pairs.append((" ".join(a), " ".join(b)))
    docs = spark.createDataFrame([(2 * i + s, p[s]) for i, p in enumerate(pairs) for s in (0, 1)], "doc_id long, text string")
    prints = weighted_sampling.fingerprints(docs, samples=64).drop("fingerprint")
    left = prints.where("doc_id % 2 = 0").withColumn("doc_id", F.col("doc_id") / 2)
    right = prints.where("doc_id % 2 = 1").withColumn("doc_id", (F.col("doc_id") - 1) / 2)
    right = right.withColumnsRenamed({f"own_{k}": f"b_{k}" for k in range(16)})
    likeness = weighted_sampling.likeness("own", "b", samples=64)
    found = {int(r.doc_id): r.like for r in left.join(right, "doc_id").withColumn("like", likeness).collect()}
    errors = [found[i] - jaccard(*p) for i, p in enumerate(pairs)]
    assert abs(sum(errors) / len(errors)) < 0.03
    assert max(map(abs, errors)) < 0.3


def test_accuracy_of_the_query_s_own_samples(spark):
    rng = random.Random(3)
    pairs = []
    for i in range(400):
        words = [f"w{i}x{k}" for k in range(40)]  # words of its own, so that the errors of pairs are independent
        a = rng.choices(words, k=rng.randint(30, 80))
        share = rng.uniform(0.5, 0.95)
        pairs.append((" ".join(a), " ".join(w if rng.random() < share else rng.choice(words) for w in a)))
    docs = spark.createDataFrame([(2 * i + s, p[s]) for i, p in enumerate(pairs) for s in (0, 1)], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in weighted_sampling.fingerprints(docs).collect()}
    size = weighted_sampling.SAMPLES
    errors = []
    for i, p in enumerate(pairs):
        a, b = prints[2 * i], prints[2 * i + 1]
        assert len(a) == len(b) == 4 * size
        errors.append(sum(a[k : k + 4] == b[k : k + 4] for k in range(0, 4 * size, 4)) / size - jaccard(*p))
    assert abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.073
    assert max(map(abs, errors)) < 0.25


def plain_edited(rows):
    """Digest of each row's edited text, rows by descending id, equal ids by the hash of the text."""
    turn = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    made = {}
    for n, (doc, text, h) in enumerate(turn):
        after = turn[(n + 1) % len(turn)][1]
        cut = len(text) // 3
        made[doc, h] = hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()
    return made


def test_query_on_odd_documents(spark, tmp_path):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["alpha", "βeta", "Gamma", "d🙂", "e\n"], k=rng.randint(1, 40))) for _ in range(40)] + ["x" * 50, "a", "ab"]
    docs = odd_documents(spark, texts).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = weighted_sampling.op6_weighted_sampling(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count()
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    keyed = {(r.doc_id, r.t, r.h) for r in body.collect()}
    expected = plain_edited(list(keyed))
    by_id = {}
    for doc, text, h in keyed:
        by_id.setdefault(doc, set()).add((len(text), expected[doc, h]))
    for r in rows:
        assert (r.n_chars, r.edited_sha256) in by_id[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert re.fullmatch(r"([0-9a-f]{4})*", r.fingerprint)
    same = {}
    for r in rows:
        for doc, text, _ in keyed:
            if doc == r.doc_id and len(text) == r.n_chars:
                same.setdefault(text, set()).add(r.fingerprint)
    assert all(len(prints) == 1 for text, prints in same.items())


def test_fingerprints_of_edited_texts_are_those_of_the_texts(spark, tmp_path):
    """Counting shared words once gives the fingerprint that the edited text has by itself."""
    rows = [(1, "one two three four five six seven eight nine ten"), (2, "One two THREE fou rfive alpha beta gamma delta")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in weighted_sampling.op6_weighted_sampling(spark, str(tmp_path)).collect()}
    edited = []
    for (doc, text), (_, after) in zip(rows, rows[::-1], strict=True):
        cut = len(text) // 3
        edited.append((doc, text[: len(text) - cut] + after[:cut]))
    plain = weighted_sampling.fingerprints(spark.createDataFrame(edited, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in plain} == {d: r.edited_fingerprint for d, r in found.items()}


def test_empty_table(spark, tmp_path):
    odd_documents(spark, ["a"]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert weighted_sampling.op6_weighted_sampling(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("text", [None, "", " \n "])
def test_text_without_words_has_an_empty_fingerprint(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert weighted_sampling.fingerprints(docs).first().fingerprint == ""
