"""Batch model jobs as two tables: requests go out, answers come back, joined on prompt_id."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import labels, prompts
from opinara.functions.resources import WHITE_SPACE
from opinara.functions.text import clean_lines, fill_empty
from opinara.operators.distributions import class_deficit, class_distribution, percent_quota, score_distribution, smallest_scores
from opinara.operators.sampling import base_rows, pick_examples, sample_n
from opinara.session import generate_rows

# Score given to generated rows of each class.
BALANCE_TARGETS = {"Negativo": 2, "Neutro": 3}
# Request settings per job (rows per request, examples per request, model options).
BALANCE = {"per_prompt": 30, "examples": 3, "temperature": 0.8, "num_predict": 900}
FIXED = {"per_prompt": 30, "examples": 3, "temperature": 0.5, "num_predict": 900}
PERCENT = {"per_prompt": 10, "examples": 5, "temperature": 0.8, "num_predict": 700}
CLASSIFY = {"temperature": 0.0, "num_predict": 3}
FIXED_ROWS = 1000
SHARE = 0.5
SMALLEST = 3
CANONICAL = ["reviewId", "review", "score", "gender", "location", "date"]


def classify_plan(df: DataFrame, n: int, text: str = "review", row_id: str = "row_id", template: str = prompts.CLASSIFY) -> DataFrame:
    """Sampled rows with their request; a missing text is sent as an empty one."""
    return sample_n(df, n, row_id).select(
        "*",
        F.col(row_id).cast("string").alias("prompt_id"),
        prompts.fill_template(template, text=fill_empty(F.col(text))).alias("prompt"),
        F.lit(CLASSIFY["temperature"]).alias("temperature"),
        F.lit(CLASSIFY["num_predict"]).alias("num_predict"),
    )


def classify_collect(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """Append the class named by each answer; a failed request is unknown and shows its error."""
    answer = F.btrim("response", F.lit(WHITE_SPACE))
    label = F.when(F.col("error").isNull(), labels.normalize_answer(answer)).otherwise(labels.UNKNOWN_ANSWER)
    return (
        plan.join(responses.select("prompt_id", "response", "error"), "prompt_id", "left")
        .withColumn("prediccion", F.coalesce(label, F.lit(labels.UNKNOWN_ANSWER)))
        .withColumn("salida_modelo", F.coalesce("error", answer, F.lit("no response")))
        .drop("response", "error")
    )


def split_quota(quotas: DataFrame, per_prompt: int) -> DataFrame:
    """One row per request: batch number and how many rows it asks for (the last one fewer)."""
    counted = quotas.withColumn("_batches", F.ceil(F.col("quota") / per_prompt))
    size = F.least(F.lit(per_prompt).cast("long"), F.col("quota") - F.col("batch") * per_prompt)
    return generate_rows(counted, "_batches", "batch").drop("_batches").withColumn("size", size)


def augment_plan(df: DataFrame, quotas: DataFrame, group: str, settings: dict, template: str, run: str) -> DataFrame:
    """Requests for every group of ``quotas`` (group, label, target_score, quota)."""
    per_prompt = settings["per_prompt"]
    batches = split_quota(quotas, per_prompt)
    filled = pick_examples(batches, df, group, "review", settings["examples"])
    prompt = prompts.fill_template(
        template, n=F.col("size"), label=F.col("label"), examples=prompts.bullet_list(F.col("examples"))
    )
    return filled.select(
        F.concat_ws("-", F.lit(run), F.col(group).cast("string"), "batch").alias("prompt_id"),
        F.col(group).alias("group"),
        "target_score",
        "quota",
        "batch",
        "size",
        F.lit(per_prompt).alias("per_prompt"),
        prompt.alias("prompt"),
        F.lit(settings["temperature"]).alias("temperature"),
        F.lit(settings["num_predict"]).alias("num_predict"),
    )


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", labels.score_to_label(F.col("score")))


def balance_quotas(df: DataFrame) -> DataFrame:
    distribution = class_distribution(df, labels.score_to_label(F.col("score")))
    return class_deficit(distribution, BALANCE_TARGETS)


def plan_balance(df: DataFrame, run: str = "balance") -> DataFrame:
    """Fill the negative and neutral classes up to the largest class."""
    return augment_plan(_labelled(df), balance_quotas(df), "label", BALANCE, prompts.PARAPHRASE, run)


def fixed_quotas(df: DataFrame, total: int = FIXED_ROWS) -> DataFrame:
    """A constant quota of neutral rows, if there is any neutral row to learn from."""
    neutral = _labelled(df).where(F.col("label") == labels.NEUTRAL).limit(1)
    return neutral.select("label", F.lit(3).alias("target_score"), F.lit(total).cast("long").alias("quota"))


def plan_fixed(df: DataFrame, total: int = FIXED_ROWS, run: str = "fixed") -> DataFrame:
    return augment_plan(_labelled(df), fixed_quotas(df, total), "label", FIXED, prompts.PARAPHRASE_NEUTRAL, run)


def percent_quotas(df: DataFrame, share: float = SHARE, smallest: int = SMALLEST) -> DataFrame:
    quotas = percent_quota(smallest_scores(score_distribution(df), smallest), share)
    return quotas.where(F.col("quota") > 0).select(
        "score", labels.score_to_label(F.col("score")).alias("label"), F.col("score").alias("target_score"), "quota"
    )


def plan_percent(df: DataFrame, share: float = SHARE, run: str = "percent") -> DataFrame:
    """Half as many rows again for each of the three rarest scores."""
    return augment_plan(df, percent_quotas(df, share), "score", PERCENT, prompts.PARAPHRASE, run)


def infer(plan: DataFrame, model: Callable[[str, float, int], str]) -> DataFrame:
    """(prompt_id, response, error) from any Python callable, run on the executors."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            responses, errors = [], []
            for prompt, heat, length in zip(batch["prompt"], batch["temperature"], batch["num_predict"], strict=True):
                try:
                    responses.append(model(prompt, heat, length))
                    errors.append(None)
                except Exception as problem:  # a failed request must not fail the job
                    responses.append(None)
                    errors.append(str(problem))
            yield pd.DataFrame({"prompt_id": batch["prompt_id"], "response": responses, "error": errors})

    asked = plan.select("prompt_id", "prompt", "temperature", "num_predict")
    return asked.mapInPandas(call, "prompt_id string, response string, error string")


def generated_lines(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """Clean answer lines, at most the asked number per request, numbered within their group."""
    usable = responses.where(F.col("error").isNull()).select("prompt_id", clean_lines(F.col("response")).alias("lines"))
    found = plan.drop("prompt").join(usable, "prompt_id")
    return (
        found.select("*", F.posexplode("lines").alias("pos", "line"))
        .where(F.col("pos") < F.col("size"))
        .withColumn("number", F.col("batch") * F.col("per_prompt") + F.col("pos"))
        .drop("lines")
    )


def generated_id(*parts, digits: int = 16):
    """``gen_`` and the first hex digits of a hash of the parts, so a retried task repeats its ids."""
    return F.concat(F.lit("gen_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, digits))


def augment_collect(
    plan: DataFrame, responses: DataFrame, df: DataFrame, group: str, carry: list[str], run: str, digits: int = 16
) -> DataFrame:
    """Generated rows in the columns of the review table; ``carry`` comes from one random in-group row."""
    lines = generated_lines(plan, responses).withColumnRenamed("group", group)
    given = base_rows(lines, df, group, "number", carry)
    return given.select(
        generated_id(F.lit(run), F.col("prompt_id"), F.col("pos").cast("string"), digits=digits).alias("reviewId"),
        F.col("line").alias("review"),
        F.col("target_score").cast("int").alias("score"),
        *carry,
    )


def union_generated(df: DataFrame, generated: DataFrame) -> DataFrame:
    """All original and generated rows, told apart by ``is_generated``."""
    columns = generated.columns
    return df.select(*columns, F.lit(False).alias("is_generated")).unionByName(
        generated.withColumn("is_generated", F.lit(True))
    )


def augment_remaining(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """(group, target_score, quota, received, remaining) for the next round.

    A group whose requests brought nothing is stopped: it is left out.
    """
    received = generated_lines(plan, responses).groupBy("group").agg(F.count("*").alias("received"))
    quotas = plan.groupBy("group", "target_score").agg(F.first("quota").alias("quota"))
    remaining = F.col("quota") - F.col("received")
    return quotas.join(received, "group").withColumn("remaining", remaining).where(F.col("remaining") > 0)
