"""Text cleaning as column expressions; only emoji names need an Arrow function."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from opinara.functions import resources

# Letters, digits and underscore of any script; plain \w would be ASCII only on the JVM.
WORD = r"[\p{L}\p{N}_]+"
WORD_OR_EMOJI = r"[\p{L}\p{N}_]+|:[\p{L}\p{N}_]+:"
TWO_CHAR_WORD = r"[\p{L}\p{N}_]{2,}"
NUMERIC = r"^\p{N}+$"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"


@F.pandas_udf(ArrayType(StringType()))
def _name_emoji(found: pd.Series) -> pd.Series:
    def name(sequence: str) -> str:
        named = resources.sequence_name(sequence)
        return f":{named}:" if named else sequence

    return found.map(lambda sequences: [name(s) for s in sequences], na_action="ignore")


def demojize(text: Column) -> Column:
    """Replace emoji by :names:. Only the emoji of texts that hold some are sent to Python, never the texts."""
    found = F.regexp_extract_all(text, F.lit(resources.EMOJI_SEQUENCE), F.lit(0))
    names = _name_emoji(F.when(text.rlike(resources.EMOJI_CLASS), found))
    # A piece in front of each sequence, and one behind the last.
    pieces = F.split(text, resources.EMOJI_SEQUENCE, -1)
    woven = F.zip_with(pieces, names, lambda piece, name: F.concat(piece, F.coalesce(name, F.lit(""))))
    return F.when(names.isNotNull(), F.array_join(woven, "")).otherwise(text)


def expand_contractions(text: Column) -> Column:
    """Write out English short forms; a text without apostrophe or slang is left alone."""
    straight = F.translate(text, "’", "'")
    for pattern, replacement in resources.CONTRACTIONS:
        straight = F.regexp_replace(straight, pattern, replacement)
    return F.when(text.rlike("['’]|(?i:gonna|wanna|gotta|gimme|lemme)"), straight).otherwise(text)


def fill_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokenize_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def tokenize_words_emoji(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_OR_EMOJI), F.lit(0))


def drop_numeric(tokens: Column) -> Column:
    # Most words start with an ASCII letter, which two comparisons of bytes tell; only the others meet the pattern.
    return F.filter(tokens, lambda word: ((word >= "A") & (word < "{")) | ~word.rlike(NUMERIC))


def remove_stopwords(tokens: Column, language: str = "english", keep: list[str] | None = None) -> Column:
    words = resources.stop_words(language, keep)
    return F.filter(tokens, lambda word: ~word.isin(*words))


def remove_stopwords_keep_negation(tokens: Column, language: str = "english") -> Column:
    return remove_stopwords(tokens, language, resources.KEPT_NEGATIONS)


def irregular_nouns() -> dict[str, str]:
    """Plurals that no ending decides, with their singulars; words that only look like plurals stand for themselves."""
    known = dict(resources.IRREGULAR_NOUNS)
    known.update({word: word for word in resources.INVARIABLE_NOUNS})
    known.update({f"{word}s": word for word in resources.IE_NOUNS + resources.CHE_NOUNS})
    known.update({f"{word}es": word for word in resources.US_NOUNS})
    known.update({f"{word}men": f"{word}man" for word in resources.MAN_PREFIXES})
    return known


def noun_lemma(word: Column) -> Column:
    """Singular of an English noun by a list of exceptions and the usual endings; see ``operators.lemmas`` for a lexicon."""
    size = F.length(word)
    known = irregular_nouns()
    irregular = word
    for plural, singular in known.items():
        if plural != singular:
            irregular = F.when(word == plural, singular).otherwise(irregular)
    cut = lambda n: word.substr(F.lit(1), size - n)
    after_hiss = word.rlike("(ch|sh|x|zz|tz|ss)es$")
    singular_end = word.rlike("(ss|us|is)$")
    plural_s = (
        F.when(after_hiss & (size > 4), cut(2))
        .when(word.endswith("ies") & (size > 4), F.concat(cut(3), F.lit("y")))
        .when((size > 3) & ~singular_end, cut(1))
        .otherwise(word)
    )
    # Most words do not end so, and leave after two cheap tests.
    ending = word.endswith("s") | word.isin(*[plural for plural in known if not plural.endswith("s")])
    return F.when(~ending, word).when(word.isin(*known), irregular).otherwise(plural_s)


def lemmatize_nouns(tokens: Column) -> Column:
    return F.transform(tokens, noun_lemma)


@functools.cache
def _accents() -> tuple[str, str]:
    return resources.accent_table()


def strip_accents(text: Column) -> Column:
    accented, plain = _accents()
    return F.regexp_replace(F.translate(text, accented, plain), r"\p{Mn}", "")


def simplify_text(text: Column, language: str = "english") -> Column:
    """The classifier's cleaning: emoji, short forms, lower case, words, stop words, lemma, accents."""
    words = tokenize_words_emoji(F.lower(expand_contractions(demojize(fill_empty(text)))))
    kept = remove_stopwords_keep_negation(drop_numeric(words), language)
    # Word by word, as few words have more bytes than characters and need a look at their accents.
    plain = F.transform(
        lemmatize_nouns(kept), lambda word: F.when(F.octet_length(word) > F.length(word), strip_accents(word)).otherwise(word)
    )
    return F.array_join(plain, " ")


def topic_tokens(text: Column, language: str = "english") -> Column:
    """The topic job's cleaning: lower case, words, numbers and stop words out, lemma."""
    words = drop_numeric(tokenize_words(F.lower(fill_empty(text))))
    return lemmatize_nouns(remove_stopwords(words, language))


def concat_texts(*columns: Column) -> Column:
    return F.concat_ws(" ", *[fill_empty(column) for column in columns])


def two_char_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TWO_CHAR_WORD), F.lit(0))


def ngrams(words: Column, low: int, high: int) -> Column:
    """All runs of low..high words joined by a blank, repeats kept.

    Runs grow by zipping with the shifted words, so ``words`` is never looked at once per element.
    """
    run, runs = words, [words] if low == 1 else []
    for n in range(2, high + 1):
        longer = F.zip_with(run, F.slice(words, n, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
        run = F.filter(longer, lambda gram: gram.isNotNull())
        if n >= low:
            runs.append(run)
    return F.concat(*runs)


def clean_lines(answer: Column) -> Column:
    """Lines of a generated answer with list marks stripped from both ends, blank lines dropped."""
    marks, space = F.lit(resources.LIST_MARKS), F.lit(resources.WHITE_SPACE)
    lines = F.transform(
        F.split(answer, LINE_BREAK), lambda line: F.btrim(F.btrim(F.btrim(line, space), marks), space)
    )
    return F.filter(lines, lambda line: line != "")
