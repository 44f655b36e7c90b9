import itertools
import random

import numpy as np
import pytest
from helpers import odd_documents

from opinara.llm import components as components_module
from opinara.llm import jaccard_join
from opinara.llm.components import components


def plain_sets(texts):
    found = []
    for t in texts:
        w = (t or "").encode().lower().split()
        found.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return found


def plain_components(ids, texts):
    sets, root = plain_sets(texts), list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[top(i)] = top(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[top(i)] = min(least.get(top(i), own), own)
    return {(own, len(sets[i]), least.get(top(i), own)) for i, own in enumerate(ids)}


def corpus(seed, bases=12, copies=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = rng.choices(words, k=60)
    texts = []
    for _ in range(bases):
        base = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own + passage
            if rng.random() < 0.2:
                own = own[: -rng.randint(1, 3)] or own
            texts.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    return texts


def found(docs):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_all_pairs(spark, seed):
    docs = odd_documents(spark, corpus(seed)).repartition(5)
    rows = docs.collect()
    assert found(docs) == plain_components([r.doc_id for r in rows], [r.text for r in rows])


def test_large_clusters_in_many_chunks_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(jaccard_join, "GROUP_CHARS", 1_000)
    docs = odd_documents(spark, corpus(7, bases=4, copies=60)).repartition(3)
    rows = docs.collect()
    assert found(docs) == plain_components([r.doc_id for r in rows], [r.text for r in rows])


def test_shingles_of_many_nodes_are_joined_and_of_few_paired(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRED", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 200)
    docs = odd_documents(spark, corpus(11, bases=8, copies=20)).repartition(4)
    rows = docs.collect()
    assert found(docs) == plain_components([r.doc_id for r in rows], [r.text for r in rows])


def test_unlike_documents_that_share_rare_shingles_form_no_cluster(spark, monkeypatch):
    """As in a long input, where the sketch is full and every document shares some shingle with another."""
    monkeypatch.setattr(jaccard_join, "sketch_of", lambda read: np.zeros(1 << jaccard_join.CELL_BITS, dtype=np.uint8))
    rng = random.Random(4)
    shared = [[f"s{i}x{k}" for k in range(25)] for i in range(41)]
    texts = [" ".join([*shared[i], *(f"d{i}x{k}" for k in range(rng.randint(90, 110))), *shared[i + 1]]) for i in range(40)]
    texts += [f"{texts[5]} more", f"{texts[5]} words"]
    sizes, dealt = [], jaccard_join.dealt

    def noted(nodes, clusters):
        sizes.extend(r["count"] for r in clusters.groupBy("label").count().collect())
        return dealt(nodes, clusters)

    monkeypatch.setattr(jaccard_join, "dealt", noted)
    docs = odd_documents(spark, texts)
    rows = docs.collect()
    assert found(docs) == plain_components([r.doc_id for r in rows], [r.text for r in rows])
    assert sizes and max(sizes) == 3


def test_tree_never_loses_a_set_that_the_bound_allows():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 9, size=(400, jaccard_join.GROUPS))
    vectors[200:] = vectors[:200] + (rng.random((200, jaccard_join.GROUPS)) < 0.05)
    sizes = vectors.sum(axis=1)
    tree = jaccard_join.CountVectorTree(vectors, sizes)
    for i in range(0, 400, 7):
        near = set(tree.near(vectors[i], int(sizes[i])).tolist())
        most = np.minimum(vectors, vectors[i]).sum(axis=1)
        assert near >= set(np.flatnonzero(180 * most >= 80 * (sizes + sizes[i])).tolist())


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(9)
    sketch = rng.integers(0, 9, size=1 << jaccard_join.CELL_BITS).astype(np.uint8)
    flat = np.zeros_like(sketch)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 64, size=rng.integers(1, 80), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 64, size=2, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for order in (sketch, flat):
                assert set(jaccard_join.prefix(a, order).tolist()) & set(jaccard_join.prefix(b, order).tolist())


def test_empty_table_and_one_of_each(spark):
    docs = odd_documents(spark, corpus(3))
    assert found(docs.limit(0)) == set()
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = docs.collect()
    expected = plain_components([r.doc_id for r in rows], [r.text for r in rows])
    groups = {c for _, n, c in expected if n}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i not in (900, 901, 902) and i is not None) == sorted(g for g in groups if g is not None)
    assert {900, 901, 902} <= set(ids)


def test_many_pointers_and_kept_rows_are_never_broadcast(spark, monkeypatch):
    plans, stored = [], components_module.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(components_module, "BROADCAST_NODES", 0)
    monkeypatch.setattr(components_module, "stored", noted)
    found = components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")).collect()
    assert {r.label for r in found} == {0} and len(found) == 10
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
    kept = jaccard_join.one_of_each(odd_documents(spark, ["a b c d e f"] * 3))
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(200, i) for i in range(201, 260)] + [(7, 7), (None, 3), (50, 0)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {**{i: 0 for i in range(51)}, **{i: 200 for i in range(200, 260)}}
