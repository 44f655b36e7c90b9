import hashlib
import random
from fractions import Fraction

import pytest
from helpers import odd_documents

from opinara.llm import mixing


def plain_targets(sizes):
    """Targets by name, rounds of sharing done one by one."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, stopped = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        open_ = [s for s in names if s not in stopped]
        rest = budget - sum(2 * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        new = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not new:
            return {**{s: Fraction(2 * sizes[s]) for s in stopped}, **share}
        stopped |= new


def rows_of(docs):
    plan = mixing.schedule(docs)
    return plan, plan.rows.withColumn("copies", plan.copies()).collect()


def corpus(spark, seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "é", "Z", "𝄞", "￿", None, "tiny"]
    rows = [
        (i, " ".join(["w"] * rng.randint(0, 60)), sources[0] if rng.random() < 0.4 else rng.choice(sources[:7]))
        for i in range(n)
    ] + [(n, "one", "tiny"), (None, "two words", "a"), (3, "x y z", "b"), (3, "x y z", "b"), (n + 1, None, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_shares(spark, seed):
    docs = corpus(spark, seed)
    plan, rows = rows_of(docs.repartition(7))
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    expected = plain_targets(sizes)
    found = {r.source: r for r in plan.sources.collect()}
    assert {s: r.source_size for s, r in found.items()} == sizes
    for source, target in expected.items():
        assert found[source].target == pytest.approx(float(target), rel=1e-12)
    taken = {}
    for r in rows:
        taken[r.place] = taken.get(r.place, 0) + r.size * r.copies
    for source, r in found.items():
        assert abs(taken[r.place] - r.target) <= 60, source
        assert taken[r.place] <= 2 * sizes[source]
    total = sum(taken.values())
    assert 1.5 * sum(sizes.values()) - 60 <= total <= 1.5 * sum(sizes.values())


def test_reruns_and_other_parts_agree(spark, monkeypatch):
    docs = corpus(spark, 5)
    first = sorted((r["_doc"] or -1, r["size"], r["copies"]) for r in rows_of(docs)[1])
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10)
    monkeypatch.setattr(mixing, "TIME_SLICES", 4)
    monkeypatch.setattr(mixing, "CUT_ROWS", 5)
    monkeypatch.setattr(mixing, "BROADCAST", (0, 0))
    assert first == sorted((r["_doc"] or -1, r["size"], r["copies"]) for r in rows_of(docs.repartition(9))[1])


def test_order_is_that_of_virtual_finish_times(spark):
    docs = corpus(spark, 8)
    plan, rows = rows_of(docs)
    source = {r.place: r for r in plan.sources.collect()}
    key = lambda r: int(hashlib.md5(f"mix:{'' if r['_doc'] is None else r['_doc']}".encode()).hexdigest()[:15], 16)
    done, copies = {}, []
    for r in sorted(rows, key=key):
        done[r.place] = done.get(r.place, 0) + r.size
        for epoch in (0, 1):
            at = (done[r.place] + epoch * source[r.place].source_size) / source[r.place].target
            copies.append((at, r.place, r["_doc"], r.size))
    budget, words, taken = 3 * sum(r.size for r in rows) // 2, 0, {}
    for _, _, doc, size in sorted((c for c in copies if c[3]), key=lambda c: c[:2]):
        words += size
        if words > budget:
            break
        taken[doc] = taken.get(doc, 0) + size
    assert sum(taken.values()) == sum(r.size * r.copies for r in rows)
    for r in rows:
        if r["_doc"] != 3:
            assert r.size * r.copies == taken.get(r["_doc"], 0)


def test_mixture_keeps_columns_and_empty_tables_stay_empty(spark):
    docs = odd_documents(spark, ["a b c", "d e", "f", "g h i j"] * 5)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in docs.collect())
    assert 1.5 * words - 4 <= sum(len((r.text or "").split()) for r in mixed.collect()) <= 1.5 * words
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert rows_of(docs.limit(0))[1] == []
