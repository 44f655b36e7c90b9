"""Conversations from trees of replies: paths by iterative self-joins, branches ranked by score, turns in a template.

A message names its parent. Paths from a leaf to its root are enumerated by joins of (path, message) rows with a table of
jumps that doubles its length in each round: after k rounds every row knows its messages up to 2 ** k replies away, so a
chain of a million replies takes twenty rounds, and the rows are as many as the paths have messages. Only ids are
joined; texts meet their places once, at the end, when a path is formatted. A path is one conversation and so one row.

The template marks turns by control strings. Where a control string, or one escaped before, stands in a text, a
backslash goes behind its first character, so no text can open or close a turn and reading back gives the same text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.session import lookup_join, stored

# The template: what opens and closes a turn of a role, the last one for every role without its own marks.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<<ROLE:", ">>", "<</ROLE>>")
CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\]|</?SYS>>|<ROLE:|</ROLE>>)"
LEARNED = frozenset(["assistant"])
# Rows of a lookup table of ids that may be broadcast; longer ones are joined by salted keys.
BROADCAST_ROWS = 100_000
SALTS = 8
# Conversations that a function gets at once. Results do not depend on it.
SLICE_ROWS = 500

_ESCAPE = re.compile(CONTROL)
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(
    r"<<SYS>>(?P<system>.*?)<</SYS>>|\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>"
    r"|<<ROLE:(?P<role>[^<>\[\]]*)>>(?P<other>.*?)<</ROLE>>",
    re.DOTALL,
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], learned: frozenset[str] = LEARNED) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation of (role, text) turns, and the spans of it that a model is to learn."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        first, last = MARKS.get(role) or (f"{OTHER[0]}{quote(role, safe='')}{OTHER[1]}", OTHER[2])
        body = escape(text)
        if role in learned:
            mask.append((at + len(first), at + len(first) + len(body)))
        parts += [first, body, last]
        at += len(first) + len(body) + len(last)
    return "".join(parts), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for found in _TURN.finditer(formatted):
        kind = found.lastgroup
        role = unquote(found["role"]) if kind == "other" else kind
        turns.append((role, unescape(found[kind])))
    return turns


def under_mask(formatted: str, mask: list[tuple[int, int]]) -> str:
    return "".join(unescape(formatted[start:end]) for start, end in mask)


def _key(column: str) -> Column:
    """An id as a text that is never null, so that null ids meet in joins."""
    return F.coalesce(F.concat(F.lit("v"), F.col(column).cast("string")), F.lit("n"))


def _id(key: str, kind: str) -> Column:
    return F.when(F.col(key) != "n", F.substring(key, 2, 1 << 30)).cast(kind)


def _lookup(big: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    return lookup_join(big, table, on, max_rows=BROADCAST_ROWS, salts=SALTS)


def enumerate_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up) of every message on the path of every leaf; ``up`` counts the replies from it to the leaf.

    ``nodes`` has one row for each message: tree, node and parent, neither of the first two null. A parent that is null
    or no message of the tree makes a root. Messages that answer each other in a circle are refused.
    """
    named = nodes.select("tree", "node", "parent")
    known = named.select("tree", F.col("node").alias("parent"))
    # Stored ids are packed so well that Spark would broadcast millions of them; these joins are always merged.
    answers = named.join(known.hint("merge"), ["tree", "parent"], "left_semi")
    jumps = stored(answers.select("tree", "node", F.col("parent").alias("to")), "chat-jumps")
    answered = jumps.select("tree", F.col("to").alias("node"))
    leaves = named.join(answered.hint("merge"), ["tree", "node"], "left_anti")
    paths = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "chat-paths")
    messages, step = named.count(), 1
    while not jumps.isEmpty():
        if step > messages:
            raise ValueError("messages answer each other in a circle")
        reached = _lookup(paths, jumps, ["tree", "node"])
        farther = reached.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        paths = paths.unionByName(stored(farther, "chat-paths"))
        after = jumps.select("tree", F.col("node").alias("to"), F.col("to").alias("_to"))
        longer = _lookup(jumps, after, ["tree", "to"])
        jumps = stored(longer.select("tree", "node", F.col("_to").alias("to")), "chat-jumps")
        step *= 2
    return paths


def ranked_branches(paths: DataFrame, scores: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, branch, turns) of the ``best`` branches of each tree (all if None), numbered from 1.

    A branch scores the sum of its messages' scores (null: 0) in ``scores`` (tree, node, score); on ties the smaller
    leaf comes first. Branches are cut to ``best`` in slices of a tree before the tree's own order is made; without a
    bound on branches they are all numbered.
    """
    known = _lookup(paths, scores.select("tree", "node", "score"), ["tree", "node"])
    branches = known.groupBy("tree", "leaf").agg(
        F.sum(F.coalesce(F.col("score"), F.lit(0.0)).cast("decimal(30,9)")).alias("_score"), F.count("*").alias("turns")
    )
    order = [F.col("_score").desc(), F.col("leaf")]
    if best is not None:
        slices = Window.partitionBy("tree", F.pmod(F.xxhash64("leaf"), F.lit(256))).orderBy(*order)
        branches = branches.withColumn("_at", F.row_number().over(slices)).where(F.col("_at") <= best).drop("_at")
    ranked = branches.withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
    return (ranked if best is None else ranked.where(F.col("branch") <= best)).drop("_score")


def format_conversations(
    messages: DataFrame,
    tree: str = "tree",
    message: str = "message",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    replies: DataFrame | None = None,
    best: int | None = None,
    learned: frozenset[str] = LEARNED,
) -> DataFrame:
    """``tree``, ``leaf``, ``branch``, ``formatted`` and ``mask`` (array of start, end) of the best branches of each tree.

    ``replies`` holds tree, message, parent (and score) where ``messages`` itself does not. Rows of null tree form one
    tree; null roles and texts are empty; rows with the same tree and message id stand one after another by role and
    text, as often as they occur, and reply to the least of their parents with the largest of their scores. Other
    columns, whatever their names, are left out. An empty table gives no rows.
    """
    links = messages if replies is None else replies
    nodes = links.select(
        _key(tree).alias("tree"),
        _key(message).alias("node"),
        F.when(F.col(parent).isNotNull(), _key(parent)).alias("parent"),
        (F.col(score).cast("double") if score else F.lit(1.0)).alias("score"),
    )
    nodes = nodes.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
    nodes = stored(nodes, "chat-nodes")
    paths = enumerate_paths(nodes)
    chosen = stored(ranked_branches(paths, nodes, best), "chat-branches")
    placed = paths.join(chosen.hint("merge"), ["tree", "leaf"])
    placed = placed.select("tree", "leaf", "branch", "node", (F.col("turns") - F.col("up")).alias("at"))
    said = messages.select(
        _key(tree).alias("tree"),
        _key(message).alias("node"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # An id shared by many branches is a hot key on the side of ids only; adaptive execution splits such a part.
    worded = placed.join(said.hint("merge"), ["tree", "node"])
    turns = F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns")
    whole = worded.groupBy("tree", "leaf", "branch").agg(turns)
    kinds = dict(messages.dtypes)
    return _rendered(whole, learned).select(
        _id("tree", kinds[tree]).alias(tree), _id("leaf", kinds[message]).alias("leaf"), "branch", "formatted", "mask"
    )


def _rendered(conversations: DataFrame, learned: frozenset[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                done = [render([(t["role"], t["text"]) for t in turns], learned) for turns in batch.column("turns").to_pylist()]
                masks = [[{"start": a, "end": b} for a, b in mask] for _, mask in done]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("tree", "leaf", "branch")],
                        pa.array([f for f, _ in done], pa.string()),
                        pa.array(masks, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    names=["tree", "leaf", "branch", "formatted", "mask"],
                )

    schema = "tree string, leaf string, branch int, formatted string, mask array<struct<start: long, end: long>>"
    return conversations.mapInArrow(run, schema)


def digests(formatted: DataFrame, conversation: str) -> DataFrame:
    """What is read back from formatted conversations: turns and learned text with their digests."""
    kind = dict(formatted.dtypes)[conversation]

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                texts = batch.column("formatted").to_pylist()
                turns = [read_back(f) for f in texts]
                masks = [[(m["start"], m["end"]) for m in mask] for mask in batch.column("mask").to_pylist()]
                loss = [under_mask(f, mask) for f, mask in zip(texts, masks, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(conversation),
                        pa.array([len(t) for t in turns], pa.int64()),
                        pa.array([sha("".join(f"{r}\n{t}\n" for r, t in own)) for own in turns], pa.string()),
                        pa.array([len(x) for x in loss], pa.int64()),
                        pa.array([sha(x) for x in loss], pa.string()),
                        pa.array([len(f) for f in texts], pa.int64()),
                    ],
                    names=[conversation, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                )

    rest = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(conversation, "formatted", "mask").mapInArrow(run, f"`{conversation}` {kind}, {rest}")


# Fixed values of the query contract: the conversation that is added, whose texts are control strings.
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation of ``conversations`` and conversation -1, formatted and read back.

    A turn replies to the one before it, so a conversation is a tree of one branch. Rows of equal turn stand by role and
    text, null turns first; conversations of null id are one. The order inside a conversation is made from its turn
    numbers alone; only its own result row holds its texts together.
    """
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    rows = rows.unionByName(added).withColumn("_turn", F.coalesce("turn", F.lit(-(1 << 63))))
    in_turn = Window.partitionBy("conv_id").orderBy("_turn")
    replies = rows.select("conv_id", "_turn").distinct().withColumn("_before", F.lag("_turn").over(in_turn))
    formatted = format_conversations(rows, "conv_id", "_turn", "_before", replies=replies)
    return digests(formatted, "conv_id")


_FIXED = {role: sum(map(len, marks)) for role, marks in MARKS.items()}
OP12_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in ADDED)})),
sized AS (
  SELECT *, length(regexp_replace(text, '{CONTROL}', '\\1\\\\\\2\\3', 'g')) + CASE role
    {" ".join(f"WHEN '{role}' THEN {size}" for role, size in _FIXED.items())}
    ELSE length(role) + {sum(map(len, OTHER))} END AS chars
  FROM said),
learned AS (
  SELECT conv_id, string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text) AS loss,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM learned
"""
