"""Request texts for the labelling and paraphrase jobs. The wording is a parameter everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def classify_template(subject: str = "review", labels: tuple[str, ...] = ("Positivo", "Negativo", "Neutro")) -> str:
    return f"Sentiment of this {subject}, as one of {', '.join(labels)}:\n{{text}}\nSentiment:"


def paraphrase_template(subject: str = "review", tone: str = "{label}") -> str:
    return (
        f"Below are some texts of the kind: {subject}. Their tone is {tone}. Make {{n}} others like them, in their language"
        " and with their meaning but not their words. Output: {n} lines and nothing else.\n{examples}\n"
    )


CLASSIFY = classify_template()
PARAPHRASE = paraphrase_template()
PARAPHRASE_NEUTRAL = paraphrase_template(tone="neutral, neither for nor against")


def fill_template(template: str, **values: Column) -> Column:
    """Replace each ``{name}`` by a column; values are never scanned for further names."""
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in values if "{" + name + "}" in rest]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def bullet_list(texts: Column) -> Column:
    return F.array_join(F.transform(texts, lambda text: F.concat(F.lit("- "), text)), "\n")
