import re
from collections import Counter

import pytest
from helpers import odd_documents
from pyspark.sql import functions as F

from opinara.llm import quality_rules

TEXTS = [
    "a b c d e f g h i j k l", "x y z v w x y z v w x y z v w", "one", "| a # b | c | d | e | f | g | h | i", "same line here\nother\nsame line here\n \nsame line here",
    "a a a a a a a a a a a", "SHOUT LOUD!! SHOUT LOUD!! ALL DAY!! LONG!! AND NIGHT!! TOO!! YES!! NO!!", "é ü \x0b ö ä 🙂", "a b c d e a b c d f a b c d g a b c d e",
]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_measures_agree_with_a_plain_count(spark):
    docs = odd_documents(spark, TEXTS)
    base = quality_rules.BASE_RULES
    rows = quality_rules.measures(docs)
    known = {c: rows[c] for c in rows.columns}
    failed = base[0].rejects(known) | base[1].rejects(known)
    for r in rows.withColumn("failed", failed).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failed) == plain(r.text or ""), r.text


def test_cascade_gives_the_same_verdict_in_any_order(spark):
    docs = odd_documents(spark, TEXTS)
    rules = quality_rules.BASE_RULES + quality_rules.MORE_RULES
    judged = quality_rules.cascade(docs)
    assert judged.columns == [*docs.columns, "kept"]
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.kept) for r in judged.collect())
    assert found == sorted((-1 if r.doc_id is None else r.doc_id, r.kept) for r in quality_rules.cascade(docs, rules[::-1]).collect())
    assert dict(found)[0] and not dict(found)[3] and not dict(found)[6] and not dict(found)[900]
    assert quality_rules.cascade(docs.limit(0)).count() == 0
    assert sorted(r.name for r in quality_rules.plan_cascade(docs, rules)) == sorted(r.name for r in rules)


def test_rejected_texts_reach_no_later_rule(spark):
    docs = odd_documents(spark, TEXTS)
    few = quality_rules.BASE_RULES[0]
    broken = quality_rules.Rule("broken", lambda m: F.when(m["n_words"] < 10, F.raise_error(F.lit("judged"))).otherwise(False).cast("boolean"))
    body = F.coalesce("text", F.lit(""))
    known = quality_rules.expressions(body, quality_rules.word_list(body))
    kept = docs.select(quality_rules.verdict([few, broken], known).alias("kept"))
    assert kept.where("kept").count() == 8
    with pytest.raises(Exception, match="judged"):
        docs.select(quality_rules.verdict([broken, few], known).alias("kept")).collect()


def test_query_takes_extra_measures_in_branches_only(spark, tmp_path):
    odd_documents(spark, TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    plan = quality_rules.op8_quality_rules(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "p{Lu}" in line]
    assert counted and all("CASE WHEN" in line[: line.index("p{Lu}")] for line in counted)


def test_cheap_rules_that_reject_much_come_first_each_time(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "word " * 200 + ("#" * 400 if i % 2 else "") + ("!" * 400 if i % 50 == 0 else "")) for i in range(300)], "doc_id long, text string")
    slow = quality_rules.Rule("slow", lambda m: m["n_repeat_words"] > 10**9)
    orders = {tuple(r.name for r in quality_rules.plan_cascade(docs, (slow, *quality_rules.MORE_RULES[1::-1]))) for _ in range(5)}
    assert orders == {("symbols", "exclamations", "slow")}
