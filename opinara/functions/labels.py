"""Rating and answer labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.resources import WHITE_SPACE

# Scores belonging to each sentiment band.
BANDS = {"negative": [1, 2], "neutral": [3], "positive": [4, 5]}

# Class names used by the labelling and augmentation jobs.
NEGATIVE, NEUTRAL, POSITIVE = "Negativo", "Neutro", "Positivo"
UNKNOWN_SCORE = "Desconocido"
UNKNOWN_ANSWER = "DESCONOCIDO"

# Characters deleted from a model answer before it is matched.
ANSWER_PUNCTUATION = ".,:;\"'()\n"


def rating_to_pnn(score: Column) -> Column:
    """>=4 positive, <=2 negative, otherwise neutral; a missing or NaN rating is neutral."""
    known = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
    return F.when(known >= 4, "positive").when(known <= 2, "negative").otherwise("neutral")


def score_to_label(score: Column) -> Column:
    return (
        F.when(score.isin(1, 2), NEGATIVE)
        .when(score == 3, NEUTRAL)
        .when(score.isin(4, 5), POSITIVE)
        .otherwise(UNKNOWN_SCORE)
    )


def sentiment_band(score: Column) -> Column:
    """Band of a whole score 1..5, null for anything else."""
    band = F.lit(None).cast("string")
    for name, scores in BANDS.items():
        band = F.when(score.isin(*scores), name).otherwise(band)
    return band


def normalize_answer(answer: Column) -> Column:
    """Class named in a free-text answer; the first class found in the order below wins."""
    clean = F.translate(F.lower(F.btrim(answer, F.lit(WHITE_SPACE))), ANSWER_PUNCTUATION, "")
    return (
        F.when(clean.contains("positivo"), POSITIVE)
        .when(clean.contains("negativo"), NEGATIVE)
        .when(clean.contains("neutro"), NEUTRAL)
        .otherwise(UNKNOWN_ANSWER)
    )
