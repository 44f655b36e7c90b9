from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from opinara.functions import labels, prompts, resources
from opinara.functions import text as tx
from opinara.functions.numbers import to_number


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def test_rating_bands(spark):
    ratings = [5.0, 4.0, 3.5, 3.0, 2.0, 1.0, 0.0, 7.0, float("nan"), None]
    want = ["positive", "positive", "neutral", "neutral", "negative", "negative", "negative", "positive", "neutral", "neutral"]
    assert values(spark, ratings, "double", labels.rating_to_pnn) == want


def test_score_labels(spark):
    want = ["Negativo", "Negativo", "Neutro", "Positivo", "Positivo", "Desconocido", "Desconocido"]
    assert values(spark, [1, 2, 3, 4, 5, 0, None], "int", labels.score_to_label) == want


def test_answers(spark):
    answers = [" Positivo.", "El sentimiento es negativo", "??", "\nNEUTRO\n", "negativo, no positivo"]
    want = ["Positivo", "Negativo", "DESCONOCIDO", "Neutro", "Positivo"]
    assert values(spark, answers, "string", labels.normalize_answer) == want


def test_numbers(spark):
    got = values(spark, ["4.7", "x", "5d", " 3 ", "1e2", ".5", "-2.", "", None], "string", to_number)
    assert got == [4.7, None, None, 3.0, 100.0, 0.5, -2.0, None, None]


def test_tokens_keep_accents_and_drop_numbers(spark):
    text = ["Don't stop :smile: café 123 ½", "", "ñandú y ÁRBOL"]
    got = values(spark, text, "string", lambda x: tx.drop_numeric(tx.tokenize_words(F.lower(x))))
    assert got == [["don", "t", "stop", "smile", "café"], [], ["ñandú", "y", "árbol"]]
    assert values(spark, ["a :ok: b"], "string", tx.tokenize_words_emoji) == [["a", ":ok:", "b"]]


def test_emoji_contractions_accents(spark):
    assert values(spark, ["hi \U0001f600\U0001f44d", "plain", None], "string", tx.demojize) == [
        "hi :grinning_face::thumbs_up:",
        "plain",
        None,
    ]
    got = values(spark, ["I can’t, won't; he's John's", "Gonna go", "cabin'd"], "string", tx.expand_contractions)
    assert got == ["I cannot, will not; he is John's", "going to go", "cabin'd"]
    assert values(spark, ["ñandú ÁRBOL ﬁn é"], "string", tx.strip_accents) == ["nandu ARBOL ﬁn e"]


def test_lemmas(spark):
    words = ["classes", "buses", "stories", "women", "cats", "was", "glass", "children", "boxes", "status", "app"]
    want = ["class", "bus", "story", "woman", "cat", "was", "glass", "child", "box", "status", "app"]
    got = values(spark, [words], "array<string>", tx.lemmatize_nouns)[0]
    assert got == want


def test_simplify_keeps_negation(spark):
    got = values(spark, ["It's NOT good, the 3 Árboles aren't bad \U0001f600", None], "string", tx.simplify_text)
    assert got == ["not good arbole not bad :grinning_face:", ""]


def test_ngrams(spark):
    got = values(spark, [["a", "b", "c"], ["a"], []], "array<string>", lambda w: tx.ngrams(w, 1, 3))
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    assert values(spark, [["a", "b", "c"]], "array<string>", lambda w: tx.ngrams(w, 2, 2)) == [["a b", "b c"]]


def test_clean_lines(spark):
    answer = "1. Good app.\n\n- 2) Nice\r\n   \n• (great) 5.\n3."
    assert values(spark, [answer, None], "string", tx.clean_lines) == [["Good app", "Nice", "great"], None]


def test_long_runs_of_marks_stay_linear(spark):
    line = "-" * 200_000 + "x" + "." * 200_000 + "y"
    assert len(values(spark, [line], "string", tx.clean_lines)[0][0]) == 200_002


def test_templates_do_not_rescan_values(spark):
    got = values(spark, ["{label}"], "string", lambda x: prompts.fill_template("a {n} b {label}", n=x, label=F.lit("z")))
    assert got == ["a {label} b z"]


def test_unknown_category_fails(spark):
    from opinara.operators.prepare import fit_label_encoder

    train = spark.createDataFrame([("B",), ("a",), ("B",)], "c string")
    encoder = fit_label_encoder(train, ["c"])
    assert [r["c"] for r in encoder.apply(train).collect()] == [0, 1, 0]
    with pytest.raises(Exception, match="unseen value"):
        encoder.apply(spark.createDataFrame([("z",)], "c string")).collect()


def test_lemmas_of_words_that_endings_mislead(spark):
    expected = {
        "always": "always", "perhaps": "perhaps", "news": "news", "series": "series", "movies": "movie", "cookies": "cookie",
        "buses": "bus", "sizes": "size", "caches": "cache", "calves": "calf", "species": "species", "specimen": "specimen",
        "does": "does", "women": "woman", "salesmen": "salesman", "stories": "story", "classes": "class", "boxes": "box",
        "beaches": "beach", "houses": "house", "prizes": "prize", "quizzes": "quiz", "waltzes": "waltz", "glass": "glass",
        "omen": "omen", "cats": "cat", "bus": "bus", "is": "is",
    }
    df = spark.createDataFrame([(w,) for w in expected], "w string")
    assert {r.w: r.l for r in df.select("w", tx.noun_lemma(F.col("w")).alias("l")).collect()} == expected


def test_lexicon_decides_between_suffix_rules(spark):
    from opinara.operators.lemmas import apply_lemmas, lemma_table

    words = ["taxes", "tokens", "wolves", "gnomes", "gnomes", "ladies", "always", "xyzs", None]
    lexicon = spark.createDataFrame([("tax",), ("token",), ("gnome",), ("lady",), ("alway",)], "word string")
    table = lemma_table(spark.createDataFrame([(w,) for w in words], "word string"), lexicon)
    assert {r.word: r.lemma for r in table.collect()} == {
        "taxes": "tax", "tokens": "token", "wolves": "wolf", "gnomes": "gnome", "ladies": "lady", "always": "always", "xyzs": "xyzs"
    }
    rows = spark.createDataFrame([(1, ["taxes", "and", "gnomes", "taxes"]), (2, [])], "row_id long, tokens array<string>")
    assert {r.row_id: r.tokens for r in apply_lemmas(rows, "tokens", table).collect()} == {1: ["tax", "and", "gnome", "tax"], 2: []}


def test_emoji_sequences(spark):
    texts = ["\U0001f44d\U0001f3fd ok", "\U0001f1ea\U0001f1f8", "❤️", "\U0001f468‍\U0001f469 x", "none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    named = [r.v for r in df.select("i", tx.demojize(F.col("t")).alias("v")).orderBy("i").collect()]
    assert named == [":thumbs_up_medium_skin_tone: ok", ":flag_ES:", ":red_heart:", ":man_and_woman: x", "none"]


def test_wide_draws_reach_classes_beyond_31_bits(spark):
    from pyspark.sql import functions as F

    from opinara.functions.rng import wide

    big = 10**10
    ids = list(range(3000)) + [i * (2**31 - 1) + 7 for i in range(3000)] + [2**40 + i for i in range(3000)]
    drawn = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(wide(F.col("i"), 42)).collect()]
    assert len(set(drawn)) >= len(ids) - 1 and all(0 <= d < 2**62 for d in drawn)
    ranks = [d % big for d in drawn]
    assert abs(sum(r >= 2**31 for r in ranks) / len(ranks) - (1 - 2**31 / big)) < 0.03


def test_only_emoji_are_sent_to_python(spark):
    rows = ["\U0001f600", "a\U0001f600 \U0001f1e9\U0001f1ea\U0001f1e9b\U0001f44d", "\n\U0001f44d\U0001f3fd\n", "", None, "x:y: $1\\", "\U0001f468‍\U0001f469 z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    named = df.select("i", tx.demojize(F.col("t")).alias("v"))
    pattern = re.compile(resources.EMOJI_SEQUENCE)
    want = [t and pattern.sub(lambda m: f":{resources.sequence_name(m.group(0))}:", t) for t in rows]
    assert [r.v for r in named.orderBy("i").collect()] == want
    plan = named._jdf.queryExecution().analyzed().toString()
    sent = plan[plan.index("_name_emoji(") :]
    assert sent[: sent.index("#", sent.index("THEN"))].endswith("THEN regexp_extract_all(t")


def test_words_are_looked_at_only_where_their_bytes_say_so(spark):
    words = ["a1", "12", "٣", "é1", "_9", "{", "Zz", "9a", "", "½", None]
    df = spark.createDataFrame([(words, "Él niño 12 cafés número a1 😀 it's")], "words array<string>, text string")
    row = df.select(tx.drop_numeric(F.col("words")).alias("kept"), tx.simplify_text(F.col("text")).alias("clean"))
    assert row.first()["kept"] == ["a1", "é1", "_9", "{", "Zz", "9a", ""]
    assert row.first()["clean"] == "el nino cafe numero a1 :grinning_face:"
    plan = row._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and ">= A)" in plan
