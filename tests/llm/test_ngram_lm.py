import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import odd_documents

from opinara.llm import common, ngram_lm
from opinara.llm.elias_fano import EliasFano, MappedArrays, NgramTrie


@pytest.mark.parametrize("high", [1, 2, 50, 1 << 20, 1 << 50])
def test_elias_fano_round_trip_and_successors(high):
    rng = np.random.default_rng(high)
    values = np.sort(rng.integers(0, high, size=700).astype(np.uint64))
    coded = EliasFano(values, high, MappedArrays())
    assert (coded.get(np.arange(len(values))) == values).all()
    asked = np.unique(np.concatenate([values, rng.integers(0, high, size=500).astype(np.uint64)]))
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()


def test_empty_sequence_and_trie():
    assert EliasFano(np.empty(0, np.uint64), 1 << 32, MappedArrays()).find(np.array([3], np.uint64)).tolist() == [-1]
    empty = np.empty(0, np.uint64)
    assert NgramTrie([empty, empty], np.empty(0, np.uint16)).find([np.array([1], np.uint64)] * 2).tolist() == [-1]


def test_trie_of_three_levels():
    rng = random.Random(4)
    grams = sorted({tuple(rng.choice([0, 1, 7, 9, 2**32 - 1, rng.randrange(2**32)]) for _ in range(3)) for _ in range(900)})
    trie = NgramTrie([np.array(c, dtype=np.uint64) for c in zip(*grams)], np.arange(len(grams)))
    asked = grams + [tuple(rng.choice([0, 1, 7, 9, 5]) for _ in range(3)) for _ in range(300)]
    place = trie.find([np.array(c, dtype=np.uint64) for c in zip(*asked)])
    assert place.tolist() == [grams.index(g) if g in grams else -1 for g in asked]
    firsts = sorted({g[0] for g in grams})
    follow = Counter(a for a, _ in {g[:2] for g in grams})
    assert trie.successors(0, np.arange(len(firsts))).tolist() == [follow[a] for a in firsts]


def plain_scores(rows):
    """Scores of (id, text) by counting everything at once."""
    words = [(i, (t or "").encode().lower().split() + [b" end"]) for i, t in rows]
    trains = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in words]
    single, double = Counter(), Counter()
    for (_, w), train in zip(words, trains, strict=True):
        if train:
            single.update(w)
            double.update(zip([b" start", *w[:-1]], w, strict=True))
    follow = Counter(a for a, _ in double)
    total, size, d = sum(single.values()), len(single), ngram_lm.DISCOUNT
    found = []
    for (i, w), train in zip(words, trains, strict=True):
        base = score = 0.0
        for before, word in zip([b" start", *w[:-1]], w, strict=True):
            plain = (single[word] + 1) / (total + size + 1)
            seen = single[b" end"] if before == b" start" else single[before]
            smooth = (max(double[before, word] - d, 0) + d * follow[before] * plain) / seen if seen else plain
            base, score = base + math.log10(plain), score + math.log10(smooth)
        found.append((i, not train, len(w), sum(single[x] > 0 for x in w), total, base, score))
    return found


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(40)] + ["é", "É", "the", "The"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("block", [2_000_000, 150])
def test_scores_agree_with_a_plain_count(spark, monkeypatch, block, tmp_path):
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 2_000)
    odd_documents(spark, corpus(1)).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    found = sorted(ngram_lm.score(docs, common.remainder("doc_id", 7) != 2).collect(), key=lambda r: key((r.doc_id, 0, r.n_tokens, 0, 0, r.base_score)))
    expected = sorted(plain_scores([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    assert len(found) == len(expected)
    for r, e in zip(found, expected, strict=True):
        # A null id trains nothing, so it counts as held out.
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:5]
        assert r.base_score == pytest.approx(e[5], abs=1e-9)
        assert r.score == pytest.approx(e[6], abs=2e-4 * r.n_tokens)


def twins():
    """Two words whose hashes share their upper 32 bits."""
    met = {}
    for i in range(2_000_000):
        word = f"t{i}"
        other = met.setdefault(xxhash.xxh3_64_intdigest(word.encode()) >> 32, word)
        if other != word:
            return other, word


def test_words_that_share_half_a_hash_stay_apart(spark, tmp_path):
    frequent, rare = twins()
    texts = [f"{frequent} a {frequent} b c {frequent} a"] * 40 + [f"{rare} b a {rare} c"] * 2
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    found = {r.doc_id: r.score for r in ngram_lm.score(docs, common.remainder("doc_id", 7) != 2).collect()}
    for e in plain_scores(enumerate(texts)):
        assert found[e[0]] == pytest.approx(e[6], abs=2e-4 * e[2]) and found[e[0]] < 0


def test_probabilities_sum_to_one():
    """Over the vocabulary and one unknown word, after any context, by the formula of the plain count."""
    words = [t.encode().lower().split() + [b" end"] for t in corpus(2)]
    single = Counter(x for w in words for x in w)
    double = Counter(p for w in words for p in zip([b" start", *w[:-1]], w, strict=True))
    follow = Counter(a for a, _ in double)
    total, size, d = sum(single.values()), len(single), ngram_lm.DISCOUNT
    for context in (b"w1", b"the", b" start"):
        seen = single[b" end"] if context == b" start" else single[context]
        mass = sum(
            (max(double[context, w] - d, 0) + d * follow[context] * (single[w] + 1) / (total + size + 1)) / seen
            for w in [*single, b"unknown word"]
        )
        assert mass == pytest.approx(1.0)


def test_empty_table_and_no_training_rows(spark, tmp_path):
    docs = odd_documents(spark, ["a b", "c"])
    docs.limit(0).write.parquet(f"{tmp_path}/none")
    assert ngram_lm.score(spark.read.parquet(f"{tmp_path}/none"), common.remainder("doc_id", 7) != 2).count() == 0
    docs.write.parquet(f"{tmp_path}/some")
    from pyspark.sql import functions as F

    rows = ngram_lm.score(spark.read.parquet(f"{tmp_path}/some"), F.lit(False)).collect()
    assert {(r.n_known, r.base_score, r.score, r.train_tokens) for r in rows} == {(0, 0.0, 0.0, 0)}
