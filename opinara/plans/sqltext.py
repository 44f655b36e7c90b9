"""SQL fragments shared by the check queries."""

from __future__ import annotations

from opinara.functions import resources, text

REVIEWS = """reviews AS (
  SELECT d.doc_id AS row_id, concat('r', CAST(d.doc_id AS VARCHAR)) AS "reviewId", d.text AS review,
         CASE WHEN l.quality = 0 THEN 1 + CAST(d.doc_id % 2 AS INT) WHEN l.toxic = 1 THEN 3
              WHEN l.quality = 1 THEN 4 + CAST(d.doc_id % 2 AS INT) END AS score,
         d.lang AS gender, CASE WHEN d.doc_id % 11 <> 0 THEN d.source END AS location,
         concat('2024-01-', lpad(CAST(1 + d.doc_id % 28 AS VARCHAR), 2, '0')) AS date,
         CASE WHEN d.doc_id % 7 <> 0 THEN CAST(d.n_chars AS DOUBLE) END AS n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

RATED = REVIEWS + """,
rated AS (SELECT * FROM reviews WHERE score IS NOT NULL)"""

PNN = "CASE WHEN {0} IS NULL OR isnan(CAST({0} AS DOUBLE)) THEN 'neutral' WHEN {0} >= 4 THEN 'positive' WHEN {0} <= 2 THEN 'negative' ELSE 'neutral' END"
SPANISH = "CASE WHEN {0} IN (1, 2) THEN 'Negativo' WHEN {0} = 3 THEN 'Neutro' WHEN {0} IN (4, 5) THEN 'Positivo' ELSE 'Desconocido' END"

WORDS = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+')"
WORDS_EMOJI = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|:[\p{{L}}\p{{N}}_]+:')"
WORDS2 = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
NO_NUMBERS = r"list_filter({0}, lambda w: NOT regexp_full_match(w, '\p{{N}}+'))"


def pnn(col: str) -> str:
    return PNN.format(col)


def spanish(col: str) -> str:
    return SPANISH.format(col)


def lehmer(expr: str, seed: int = 0) -> str:
    value = f"(({expr}) + {seed})"
    return f"((({value} % 2147483648 + ({value} // 2147483648) % 2147483647 * 1327217885) % 2147483647) * 48271 % 2147483647)"


def wide(expr: str, seed: int = 0) -> str:
    low = lehmer(lehmer(f"({expr}) % 2147483629", seed + 1))
    return f"({lehmer(lehmer(expr, seed))} * 2147483648 + {low})"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def no_stopwords(expr: str, keep: list[str] | None = None) -> str:
    return f"list_filter({expr}, lambda w: w NOT IN ({quoted(resources.stop_words('english', keep))}))"


def lemma(word: str = "w") -> str:
    known = text.irregular_nouns()
    irregular = " ".join(f"WHEN {word} = '{a}' THEN '{b}'" for a, b in known.items())
    size = f"length({word})"
    return (
        f"CASE {irregular} "
        f"WHEN regexp_matches({word}, '(ch|sh|x|zz|tz|ss)es$') AND {size} > 4 THEN left({word}, {size} - 2) "
        f"WHEN suffix({word}, 'ies') AND {size} > 4 THEN concat(left({word}, {size} - 3), 'y') "
        f"WHEN suffix({word}, 's') AND {size} > 3 AND NOT regexp_matches({word}, '(ss|us|is)$') THEN left({word}, {size} - 1) "
        f"ELSE {word} END"
    )


def lemmas(expr: str) -> str:
    return f"list_transform({expr}, lambda w: {lemma()})"


# The same short forms as word-boundary patterns, for an engine without look-behind.
_SHORT_FORMS = [
    ("won't", "will not"), ("can't", "cannot"), ("shan't", "shall not"), ("ain't", "are not"), ("let's", "let us"),
    ("y'all", "you all"), ("gonna", "going to"), ("wanna", "want to"), ("gotta", "got to"), ("gimme", "give me"),
    ("lemme", "let me"),
]
_SHORT_ENDINGS = [("n't", " not"), ("'re", " are"), ("'ve", " have"), ("'ll", " will")]


def contractions(expr: str) -> str:
    rules = [(rf"(?i)\b{word}\b", full) for word, full in _SHORT_FORMS]
    rules += [(rf"(?i){end}\b", full) for end, full in _SHORT_ENDINGS]
    rules += [(r"(?i)\bi'm\b", "I am")]
    rules += [(rf"(?i)\b({resources.WOULD_WORDS})'d\b", r"\1 would"), (rf"(?i)\b({resources.IS_WORDS})'s\b", r"\1 is")]
    for pattern, full in rules:
        expr = f"regexp_replace({expr}, '{pattern.replace(chr(39), chr(39) * 2)}', '{full}', 'g')"
    return expr


def topic_tokens(expr: str) -> str:
    words = NO_NUMBERS.format(WORDS.format(f"lower(coalesce({expr}, ''))"))
    return lemmas(no_stopwords(words))


def vocabulary(grams: str, rows: str, low: int = 5, high: float = 0.8) -> str:
    """Body of a CTE: terms of ``grams`` (row_id, term) kept by document frequency."""
    return f"""SELECT term, count(DISTINCT row_id) AS df FROM {grams} GROUP BY term
      HAVING count(DISTINCT row_id) >= {low} AND count(DISTINCT row_id) <= {high} * (SELECT count(*) FROM {rows})"""
