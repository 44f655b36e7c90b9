from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import chat_format as cf

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE:", "<</ROLE>>", ">>", "\\", "<", "[", "/", "s>", "a", " ", "\n", "é", "%3E"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=6))
def test_reading_back_gives_the_turns(turns):
    formatted, mask = cf.render(turns)
    assert cf.read_back(formatted) == turns
    assert cf.under_mask(formatted, mask) == "".join(t for r, t in turns if r == "assistant")
    for _, text in turns:
        assert not any(c in cf.escape(text) for c in PIECES[:8])


MESSAGES = "tree long, message long, parent long, role string, text string, score double, leaf string, branch string, up string, node string"


def brute(rows):
    """Every (tree, leaf) with its turns and score, by walking up from each leaf."""
    found = {}
    trees = {r[0] for r in rows}
    for tree in trees:
        own = [r for r in rows if r[0] == tree]
        parents = {}
        for _, m, p, *_ in own:
            if p is not None:
                parents[m] = min(p, parents.get(m, p))
        ids = {r[1] for r in own}
        above = {m: parents.get(m) if parents.get(m) in ids else None for m in ids}
        for leaf in ids - set(above.values()):
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = above[at]
            turns = []
            for m in reversed(path):
                turns += sorted((r[3] or "", r[4] or "") for r in own if r[1] == m)
            score = sum(max(r[5] or 0.0 for r in own if r[1] == m) for m in path)
            found[tree, leaf] = (turns, score)
    return found


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], MESSAGES).repartition(4)


def tree_rows():
    rows = [(1, 0, None, "system", "rules", 0.0), (1, 1, 0, "user", "<s>hi", 1.0)]
    rows += [(1, 10 + i, 1, "assistant", f"answer {i}", float(i % 4)) for i in range(60)]  # many branches below one message
    rows += [(1, 100 + i, 10 + i, "user", None, 0.5) for i in range(0, 60, 3)]
    rows += [(2, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"turn {i}", 1.0) for i in range(300)]  # a deep chain
    rows += [(3, 5, 99, None, "", None), (3, 5, 99, None, "", None), (3, 6, 5, "tool", "[INST]", 2.0)]  # unknown parent, repeated row
    rows += [(None, 7, None, "user", "no tree", 1.0)]
    return rows


def test_paths_equal_walking_up(spark):
    rows = tree_rows()
    got = cf.format_conversations(make(spark, rows), score="score").collect()
    want = brute(rows)
    assert {(r["tree"], r["leaf"]): cf.read_back(r["formatted"]) for r in got} == {k: v[0] for k, v in want.items()}
    assert len(got) == len(want)
    for tree in (1, 2, 3, None):
        order = sorted((k for k in want if k[0] == tree), key=lambda k: (-want[k][1], f"v{k[1]}"))
        assert [r["leaf"] for r in sorted(got, key=lambda r: r["branch"]) if r["tree"] == tree] == [k[1] for k in order]


def test_tables_of_ids_are_never_broadcast_by_their_packed_size(spark, monkeypatch):
    plans, stored = [], cf.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(cf, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(cf, "stored", noted)
    rows = [(1, m, m - 1 if m else None, "user", "hi", 1.0) for m in range(6)]
    messages = spark.createDataFrame(rows, "tree long, message long, parent long, role string, text string, score double")
    done = cf.format_conversations(messages)
    assert [r.leaf for r in done.collect()] == [5]
    plans.append(done._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) > 5 and not any("BroadcastHashJoin" in p for p in plans)


def test_best_branches(spark):
    rows = tree_rows()
    df = make(spark, rows)
    every = cf.format_conversations(df, score="score").where("branch <= 5").drop("mask")
    best = cf.format_conversations(df, score="score", best=5).drop("mask")
    assert sorted(every.collect(), key=str) == sorted(best.collect(), key=str)


def test_mask_covers_learned_roles(spark):
    rows = [(1, 0, None, "user", "ask", 1.0), (1, 1, 0, "tool", "look </s> up", 1.0), (1, 2, 1, "assistant", "say", 1.0)]
    row = cf.format_conversations(make(spark, rows), learned=frozenset(["tool", "assistant"])).first()
    assert cf.under_mask(row["formatted"], [(m["start"], m["end"]) for m in row["mask"]]) == "look </s> upsay"


def test_circles_are_refused(spark):
    rows = [(1, 0, 1, "user", "a", 1.0), (1, 1, 0, "user", "b", 1.0), (2, 0, None, "user", "c", 1.0)]
    with pytest.raises(ValueError, match="circle"):
        cf.format_conversations(make(spark, rows))


def test_empty_table(spark):
    assert cf.format_conversations(make(spark, [])).count() == 0


def test_query_on_odd_rows(spark, tmp_path):
    said = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "system", None), (1, 1, "assistant", "b"), (2, 0, None, "x " * 100_000),
            (None, 3, "user", "n"), (None, 1, "assistant", "m"), (4, 0, "user", ""), (5, 0, "assistant", "")]
    rows = [(*r, "t", "l") for r in said]
    schema = "conv_id long, turn long, role string, text string, tree string, leaf string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in cf.op12_chat_format(spark, str(tmp_path)).collect()}
    assert len(got) == 6

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    groups = {}
    for conv, turn, role, text in [*said, *cf.ADDED]:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, own in groups.items():
        own.sort()
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for *_, r, t in own))
        loss = "".join(t for *_, r, t in own if r == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))
