"""Small inputs with nulls, empty and repeated texts for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string, node string, size string"


def odd_documents(spark, texts):
    """``texts`` as documents with columns named like those that operators add, then null, empty and repeated rows."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \n\t"), (None, "one two"), (0, texts[0])]
    full = [(i, t, "en", None if (i or 0) % 3 else "s", len(t or ""), "x", "y", "z", "w") for i, t in rows]
    return spark.createDataFrame(full, DOCS)
