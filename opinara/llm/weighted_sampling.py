"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

A text is its lower-cased words weighted by how often they occur. For each of the samples every word draws two gamma
variables and a uniform one from hashes of the word; the word of least rank, at the weight level that the draw rounds
to, is the sample. Two texts agree in a sample with the probability of their generalised Jaccard similarity, the sum of
smaller weights over the sum of larger ones. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.session import stored

# Samples of a fingerprint: LANES of them share a row while they are drawn and a 64-bit word afterwards, 16 bits each, so
# that different samples agree by chance once in 65536. Few samples a row keep the generated code small enough for the
# JVM to compile it.
SAMPLES, LANES = 48, 4
LANE_BITS = 16
SPACE = r"[\x20\x09-\x0D]"
UNIT = 2.0**-32


def uniforms(term: Column, seed: Column) -> tuple[Column, Column]:
    """Two uniform numbers above 0 and below 1 from one hash of a term."""
    drawn = F.xxhash64(term, seed)
    low = (drawn.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) * UNIT
    high = (F.shiftrightunsigned(drawn, 32) + 0.5) * UNIT
    return low, high


def draws(term: Column, sample: Column) -> tuple[Column, Column, Column]:
    """Gamma variable r, logarithm of gamma variable c, and uniform b of a term, the same for every text.

    The negative logarithm of a product of two uniforms is a gamma variable of shape 2.
    """
    u, v = uniforms(term, sample * 3)
    w, x = uniforms(term, sample * 3 + 1)
    b, _ = uniforms(term, sample * 3 + 2)
    return -F.ln(u * v), F.ln(-F.ln(w * x)), b


def rank(log_weight: Column, r: Column, log_c: Column, b: Column) -> Column:
    """Logarithm of a word's rank at its weight; the least one wins. Null for a word that a text lacks."""
    level = F.floor(log_weight / r + b)
    return log_c - r * (level - b + 1)


def sampled(terms: DataFrame, keys: list[str], weights: dict[str, str], samples: int = SAMPLES) -> DataFrame:
    """One row per key with the 64-bit words of its fingerprint, as columns name_0, name_1, ... for each weight column.

    ``terms`` has the keys, ``term`` (a hash) and the log-weights, null where a text lacks the term. Draws are made once
    for all weight columns. A text without words has nulls.
    """
    words_of = samples // LANES
    each = terms.select(*keys, "term", *weights.values(), F.explode(F.sequence(F.lit(0), F.lit(words_of - 1))).alias("_part"))
    drawn, least = [], []
    for lane in range(LANES):
        r, log_c, b = draws(F.col("term"), F.col("_part") * LANES + lane)
        drawn += [r.alias(f"_r{lane}"), log_c.alias(f"_c{lane}"), b.alias(f"_b{lane}")]
        for name, weight in weights.items():
            at = rank(F.col(weight), F.col(f"_r{lane}"), F.col(f"_c{lane}"), F.col(f"_b{lane}"))
            least.append(F.min(at).alias(f"{name}{lane}"))
    ranks = each.select(*keys, "_part", *weights.values(), *drawn).groupBy(*keys, "_part").agg(*least)

    def word(name: str) -> Column:
        lanes = [
            F.shiftleft(F.xxhash64(f"{name}{lane}").bitwiseAND(F.lit((1 << LANE_BITS) - 1)), lane * LANE_BITS)
            for lane in range(LANES)
        ]
        whole = lanes[0].bitwiseOR(lanes[1]).bitwiseOR(lanes[2]).bitwiseOR(lanes[3])
        return F.when(F.col(f"{name}0").isNotNull(), whole)

    parts = ranks.select(*keys, "_part", *[word(name).alias(name) for name in weights])
    columns = [
        F.max(F.when(F.col("_part") == part, F.col(name))).alias(f"{name}_{part}") for name in weights for part in range(words_of)
    ]
    return parts.groupBy(*keys).agg(*columns)


def print_of(name: str, samples: int = SAMPLES) -> Column:
    """The fingerprint in hexadecimal digits; empty for a text without words."""
    parts = [F.lpad(F.lower(F.hex(f"{name}_{part}")), 16, "0") for part in range(samples // LANES)]
    return F.coalesce(F.concat(*parts), F.lit(""))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of samples in which two fingerprints agree; two without words agree, one without agrees with none."""
    mask, same = F.lit((1 << LANE_BITS) - 1), F.lit(0)
    for part in range(samples // LANES):
        apart = F.col(f"{a}_{part}").bitwiseXOR(F.col(f"{b}_{part}"))
        for lane in range(LANES):
            same = same + (F.shiftright(apart, lane * LANE_BITS).bitwiseAND(mask) == 0).cast("int")
    none = F.col(f"{a}_0").isNull() | F.col(f"{b}_0").isNull()
    both = F.col(f"{a}_0").isNull() & F.col(f"{b}_0").isNull()
    return F.when(none, both.cast("double")).otherwise(same / F.lit(float(samples)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(common.WORD), F.lit(0))


def weighted_terms(texts: DataFrame, keys: list[str], parts: dict[str, tuple[str, ...]]) -> DataFrame:
    """Terms of each key with the logarithm of their count in each weight column.

    ``parts`` maps a text column to the weight columns that its words count for.
    """
    weights = sorted({w for ws in parts.values() for w in ws})

    def flagged(part: str, counts_for: tuple[str, ...]) -> Column:
        flags = [F.lit(int(name in counts_for)).alias(name) for name in weights]
        return F.transform(words(F.col(part)), lambda w: F.struct(F.xxhash64(w).alias("term"), *flags))

    each = texts.select(*keys, F.explode(F.concat(*[flagged(*part) for part in parts.items()])).alias("_word"))
    each = each.select(*keys, "_word.*")
    counted = each.groupBy(*keys, "term").agg(*[F.sum(w).alias(w) for w in weights])
    return counted.select(*keys, "term", *[F.ln(F.when(F.col(w) > 0, F.col(w))).alias(w) for w in weights])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``key`` (unique per row) with the words ``own_0``, ... and the text ``fingerprint`` of each whole text.

    Null and empty texts, and texts without a word, have an empty fingerprint; an empty table gives none.
    """
    body = docs.select(F.col(key).alias("_own_key"), common.whole_text(text).alias("_text"))
    made = sampled(weighted_terms(body, ["_own_key"], {"_text": ("_own",)}), ["_own_key"], {"own": "_own"}, samples)
    found = docs.select(key).join(made, F.col(key) == F.col("_own_key"), "left").drop("_own_key")
    return found.withColumn("fingerprint", print_of("own", samples))


# A document's key: its id (null as the least number) and the hash of its text.
KEY = ["_doc", "_hash"]


def in_turn(keys: DataFrame) -> DataFrame:
    """``keys`` (_null, KEY, n_chars) with the key of the document that follows by descending id, as _next_doc, _next_hash.

    Null ids come last, equal ids go by the hash of their text, and the last is followed by the first. A distributed
    sort gives places inside its parts; only the first row of each part meets the others.
    """
    ordered = keys.orderBy("_null", F.col("_doc").desc(), "_hash").withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered, "cws-order").withColumn("_part", F.shiftright("_id", 33)).withColumn("_key", F.struct(*KEY))
    heads = ordered.groupBy("_part").agg(F.min(F.struct("_id", "_key"))["_key"].alias("_head"))
    turn = Window.orderBy("_part")  # a row for each part of the sort
    first = F.first("_head").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_part", F.coalesce(F.lead("_head").over(turn), first).alias("_head"))
    inside = F.lead("_key").over(Window.partitionBy("_part").orderBy("_id"))
    after = ordered.join(F.broadcast(heads), "_part").withColumn("_next", F.coalesce(inside, F.col("_head")))
    return after.select(*KEY, "n_chars", F.col("_next._doc").alias("_next_doc"), F.col("_next._hash").alias("_next_hash"))


def once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key; the sort that this needs serves a join on the key as well."""
    before = F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*keys))
    return rows.withColumn("_before", before).where("_before IS NULL").drop("_before")


def edited(texts: DataFrame, turns: DataFrame) -> DataFrame:
    """Texts (KEY, _text) with their last third replaced by the beginning of the next document.

    The result has the edited text's digest, the words' part that both texts share (it ends at white space, so that no
    word crosses it) and what either text has beyond it.
    """
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = turns.select(
        F.col("_next_doc").alias("_doc"), F.col("_next_hash").alias("_hash"),
        F.col("_doc").alias("_to_doc"), F.col("_hash").alias("_to_hash"), cut.alias("_cut"),
    )
    given = texts.join(wanted, KEY).select(
        F.col("_to_doc").alias("_doc"), F.col("_to_hash").alias("_hash"),
        F.substring("_text", F.lit(1), F.col("_cut")).alias("_given"), "_cut",
    )
    kept = F.substring("_text", F.lit(1), F.length("_text") - F.col("_cut"))
    made = texts.join(given, KEY).select(*KEY, "_text", kept.alias("_kept"), "_given")
    shared = F.regexp_extract("_kept", rf"(?s)^(.*{SPACE})", 1)
    rest = lambda column: F.substring(column, F.length("_shared") + 1, F.length(column))
    made = made.withColumn("_shared", shared).withColumn("_edited", F.concat("_kept", "_given"))
    return made.select(
        *KEY,
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        "_shared",
        rest("_text").alias("_own_rest"),
        rest("_edited").alias("_edited_rest"),
    )


def op6_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and of their edited ones. Rows of the same id and text are one document in the order.

    Texts are shuffled once, by their key; a third of each then goes to the document before it. Terms are counted and
    sampled where the text already is.
    """
    body = common.whole_text("text")
    docs = common.documents(spark, folder).select("doc_id", body.alias("_text"))
    docs = docs.withColumns(
        {"_doc": F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")), "_hash": F.xxhash64("_text"), "_null": F.col("doc_id").isNull()}
    )
    keys = docs.groupBy("_null", *KEY).agg(F.max(F.length("_text")).cast("long").alias("n_chars"))
    turns = stored(in_turn(keys), "cws-turns")
    both = edited(once(docs.select(*KEY, "_text"), KEY), turns)
    parts = {"_shared": ("_o", "_e"), "_own_rest": ("_o",), "_edited_rest": ("_e",)}
    made = sampled(weighted_terms(both, KEY, parts), KEY, {"own": "_o", "new": "_e"})
    prints = stored(both.select(*KEY, "edited_sha256").join(made, KEY, "left"), "cws-prints")
    following = prints.select(
        F.col("_doc").alias("_next_doc"),
        F.col("_hash").alias("_next_hash"),
        *[F.col(f"own_{part}").alias(f"after_{part}") for part in range(SAMPLES // LANES)],
    )
    known = turns.join(prints, KEY).join(following, ["_next_doc", "_next_hash"]).select(
        *KEY,
        "n_chars",
        "edited_sha256",
        print_of("own").alias("fingerprint"),
        print_of("new").alias("edited_fingerprint"),
        likeness("own", "new").alias("near_edited"),
        likeness("own", "after").alias("near_next"),
    )
    return docs.select("doc_id", *KEY).join(known, KEY).drop(*KEY)
