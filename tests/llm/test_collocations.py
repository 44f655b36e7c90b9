from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import collocations as co

DOCS = "doc_id long, text string, lang string, phrase string, n long, w1 string, rank int"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, first):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(words[i : i + size])] += 1
    found = []
    for lang, own in counts.items():
        wanted = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        lines = []
        for p, a in wanted.items():
            low = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            longer = [f for q, f in wanted.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f >= 80 * a for f in longer):
                lines.append((-low[0], -a, " ".join(p).encode(), own[p[: low[1]]], own[p[low[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:first], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def make(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, "y", 2) for i, (t, g) in enumerate(rows)], DOCS).repartition(5)


def prose(seed, texts=120):
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "stock", "éa", "EXCHANGE", "a b", "\x1cz", "𝒳", "to", "be", "or"]
    weights = [20, 5, 12] + [3] * 11
    rows = []
    for _ in range(texts):
        words = draw.choices(vocabulary, weights, k=draw.randrange(0, 60))
        rows.append(("".join(w + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", ";!"]) for w in words), draw.choice(["en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("least, first", [(3, 1000), (2, 7)])
def test_equals_brute_force(spark, least, first):
    rows = [*prose(1), (None, "en"), ("", None), (" \t.,", "de"), ("one", "de"), ("same words here. " * 50, "en")]
    rows += [("to be or not to be", "en")] * 40
    got = sorted(tuple(r) for r in co.collocations(make(spark, rows), least=least, first=first).collect())
    assert got == brute(rows, least, first)


def test_exploded_phrases_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(co, "BROADCAST_ROWS", 0)
    counts = spark.createDataFrame([("en", 1, "a", 40), ("en", 1, "b", 40), ("en", 2, "a b", 35)], "lang string, size int, phrase string, f long")
    low = co.scored(counts)
    for found in (low, co.uncovered(low)):
        assert [r.phrase for r in found.collect()] == ["a b"]
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_windows_cut_short_or_not_give_the_same(spark):
    rows = prose(2)
    docs = make(spark, rows).select("text", co.F.coalesce("lang", co.F.lit("und")).alias("lang"))
    cells = 1 << 16
    pairs = co.frequent_cells(docs, cells, 4, (1, 2))
    short = co.counted_windows(docs, cells, (pairs, co.frequent_cells(docs, cells, 4, (3, 4), pairs)))
    whole = co.counted_windows(docs, cells, (b"\xff" * (cells // 8),) * 2)
    assert short.count() < whole.count()
    counts = [
        {(r["lang"], *r[1:5]): r["n"] for r in w.rollup("lang", "w1", "w2").agg(co.F.sum("n").alias("n")).withColumn("w3", co.F.lit(0)).withColumn("w4", co.F.lit(0)).collect()}
        for w in (short, whole)
    ]
    assert sum(r["n"] for r in short.collect()) == sum(r["n"] for r in whole.collect())
    for key, n in counts[1].items():
        if n >= 4 and key[2] is not None:
            assert counts[0][key] == n


def test_tokens_of_many_texts_at_once():
    texts = ["Ab c.d", "", "e", "f  g", "é.É", "..", "H"]
    found = co.tokens(pa.array(["skipped", *texts], pa.string()).slice(1), np.arange(len(texts)))
    words = [found.words[int(i)].as_py() for i in found.word]
    assert words == ["ab", "c", "d", "e", "f", "g", "é", "É", "h"]
    assert found.language.tolist() == [0, 0, 0, 2, 3, 3, 4, 4, 6]
    same = [bool(a == b) for a, b in zip(found.piece, found.piece[1:], strict=False)]
    assert same == [True, False, False, False, True, False, False, False]


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 10)
    text = "aaa bbb ccc ddd eee fff. g. h i j k l m n o p q, r"
    assert b"".join(co.cuts(text.encode())).decode() == text
    batch = pa.RecordBatch.from_arrays([pa.array(["x.", text, "", "y", text]), pa.array(list("abcde"))], names=["text", "lang"])
    parts = list(co.blocks(iter([batch])))
    assert "".join("".join(t.to_pylist()) for t, _ in parts) == "x." + text + "y" + text
    assert {g for t, languages in parts for g in languages.to_pylist()} == set("abcde")
    for t, _ in parts:
        for part in t.to_pylist():
            assert part in ("x.", "", "y") or part[-1] in ".,r"


def test_large_counts_are_exact(spark):
    big = 6 * 10**17
    rows = [("en", 1, "a", big + 3), ("en", 1, "b", 3 * big), ("en", 2, "a b", big + 1), ("en", 3, "a b c", big), ("en", 1, "c", big), ("en", 2, "b c", big)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    got = {r["phrase"]: r for r in co.scored(counts).collect()}
    assert got["a b"]["score"] == 2_000_000 * (big + 1) // (4 * big + 3)
    assert got["a b c"]["score"] == min(2_000_000 * big // (2 * big + 3), 2_000_000 * big // (2 * big + 1))
    assert {r["phrase"] for r in co.uncovered(co.scored(counts)).collect()} == {"a b c"}


def test_empty_table(spark):
    got = co.collocations(make(spark, []).limit(0))
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
