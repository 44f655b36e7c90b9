"""Small language tables. Lists are fixed values in their usual public order."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.ml.feature import StopWordsRemover

# The common public English stop list.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both
each few more most other some such no nor not only own same so than too very s t can will just
don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Negations the classifier keeps.
KEPT_NEGATIONS = ["no", "not"]

# Words that may carry a short "would" or a short "is".
WOULD_WORDS = "he|she|it|i|we|you|they|that|there|who|what|how"
IS_WORDS = "he|she|it|that|there|here|who|what|where|when|why|how"

# English short forms as (pattern, replacement), special cases first.
# Each pattern starts with a plain letter or apostrophe and looks back from there, so the search
# does not try a word boundary at every character.
CONTRACTIONS = [
    (r"(?i)w(?<=\bw)on't\b", "will not"),
    (r"(?i)c(?<=\bc)an't\b", "cannot"),
    (r"(?i)s(?<=\bs)han't\b", "shall not"),
    (r"(?i)a(?<=\ba)in't\b", "are not"),
    (r"(?i)l(?<=\bl)et's\b", "let us"),
    (r"(?i)y(?<=\by)'all\b", "you all"),
    (r"(?i)g(?<=\bg)onna\b", "going to"),
    (r"(?i)w(?<=\bw)anna\b", "want to"),
    (r"(?i)g(?<=\bg)otta\b", "got to"),
    (r"(?i)g(?<=\bg)imme\b", "give me"),
    (r"(?i)l(?<=\bl)emme\b", "let me"),
    (r"n't\b|N'T\b|n'T\b|N't\b", " not"),
    (r"'[rR][eE]\b", " are"),
    (r"'[vV][eE]\b", " have"),
    (r"'[lL][lL]\b", " will"),
    (r"(?i)i(?<=\bi)'m\b", "I am"),
    (rf"'(?<=\b(?i:{WOULD_WORDS})')[dD]\b", " would"),
    (rf"'(?<=\b(?i:{IS_WORDS})')[sS]\b", " is"),
]

# Irregular English noun plurals.
IRREGULAR_NOUNS = {
    "children": "child",
    "feet": "foot",
    "teeth": "tooth",
    "geese": "goose",
    "mice": "mouse",
    "lice": "louse",
    "oxen": "ox",
    "knives": "knife",
    "lives": "life",
    "wives": "wife",
    "leaves": "leaf",
    "wolves": "wolf",
    "shelves": "shelf",
    "halves": "half",
    "selves": "self",
    "calves": "calf",
    "thieves": "thief",
    "loaves": "loaf",
    "elves": "elf",
    "scarves": "scarf",
    "hooves": "hoof",
    "criteria": "criterion",
    "phenomena": "phenomenon",
    "quizzes": "quiz",
    "axes": "axe",
    "men": "man",
    "women": "woman",
}

# Words in s that are no plurals.
INVARIABLE_NOUNS = """
always perhaps news series species does was has is this his its us as yes thus plus gas bus lens bias atlas alias canvas
chaos cosmos christmas pants jeans scissors trousers mathematics physics politics economics ethics athletics gymnastics
diabetes means headquarters crossroads whereas besides towards afterwards sometimes nevertheless unless
""".split()

# Nouns in ie, in us and in che, whose plurals look like those of nouns in y, se and ch.
IE_NOUNS = """
movie cookie zombie tie pie lie die rookie selfie calorie genie brownie hoodie smoothie veggie birdie cutie newbie
junkie hippie indie foodie goalie prairie
""".split()
US_NOUNS = """
bus virus bonus status campus census circus chorus focus genus minus plus surplus walrus cactus crocus lotus octopus
platypus sinus
""".split()
CHE_NOUNS = "cache ache headache toothache stomachache niche creche avalanche moustache mustache quiche cliche psyche".split()

# What comes before "men" in plurals of "man".
MAN_PREFIXES = """
sales fire police gentle business fisher work crafts spokes chair congress snow fresh post milk door horse states sports
country bats camera middle mad air sea clergy noble lay hench french english irish dutch
""".split()

# Noun suffix rules as (ending, replacement), tried in this order where a lexicon decides.
NOUN_SUFFIXES = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

# Characters stripped from both ends of a generated line.
LIST_MARKS = "-•0123456789. )("

# White space stripped from both ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Usual short names that differ from the Unicode character name.
EMOJI_SHORT_NAMES = {
    "❤": "red_heart",
    "⭐": "star",
    "\U0001f44d": "thumbs_up",
    "\U0001f44e": "thumbs_down",
    "\U0001f44c": "OK_hand",
    "\U0001f44f": "clapping_hands",
    "\U0001f4af": "hundred_points",
    "\U0001f3b6": "musical_notes",
    "\U0001f60d": "smiling_face_with_heart-eyes",
    "\U0001f621": "enraged_face",
    "\U0001f64f": "folded_hands",
    "\U0001f603": "grinning_face_with_big_eyes",
    "\U0001f604": "grinning_face_with_smiling_eyes",
    "\U0001f601": "beaming_face_with_smiling_eyes",
    "\U0001f60a": "smiling_face_with_smiling_eyes",
    "\U0001f62d": "loudly_crying_face",
}

# Character ranges treated as emoji (with the optional variation selector after them).
EMOJI_CLASS = "[☀-➿⭐⭕\U0001f1e6-\U0001f1ff\U0001f300-\U0001f64f\U0001f680-\U0001f6ff\U0001f900-\U0001faff]"
# Skin tones by their place in Unicode.
SKIN_TONES = ("light", "medium-light", "medium", "medium-dark", "dark")
FIRST_TONE, LAST_TONE, FIRST_LETTER, LAST_LETTER = "\U0001f3fb", "\U0001f3ff", "\U0001f1e6", "\U0001f1ff"
# A flag of two letters, or emoji with tones and variation marks, joined ones as one.
_ONE = f"{EMOJI_CLASS}\ufe0f?[{FIRST_TONE}-{LAST_TONE}]?"
EMOJI_SEQUENCE = f"[{FIRST_LETTER}-{LAST_LETTER}]{{2}}|{_ONE}(?:\u200d{_ONE})*"


def stop_words(language: str = "english", keep: list[str] | None = None) -> list[str]:
    if language == "english":
        words = ENGLISH_STOP_WORDS
    else:
        words = StopWordsRemover.loadDefaultStopWords(language)
    return [word for word in words if word not in set(keep or [])]


def accent_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one base letter plus marks, and that letter."""
    accented, plain = [], []
    for point in range(0x80, min(0xFFFF, sys.maxunicode)):
        char = chr(point)
        bare = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if len(bare) == 1 and bare[0] != char and not 0xD800 <= point <= 0xDFFF:
            accented.append(char)
            plain.append(bare[0])
    return "".join(accented), "".join(plain)


def sequence_name(sequence: str) -> str:
    """Name of an emoji sequence: a flag by its letters, parts joined by ``_and_``, a tone behind its emoji."""
    if len(sequence) == 2 and all(FIRST_LETTER <= c <= LAST_LETTER for c in sequence):
        return "flag_" + "".join(chr(ord("A") + ord(c) - ord(FIRST_LETTER)) for c in sequence)
    parts = []
    for part in sequence.replace("\ufe0f", "").split("\u200d"):
        name = emoji_name(part[0])
        if len(part) > 1:
            name += f"_{SKIN_TONES[ord(part[1]) - ord(FIRST_TONE)]}_skin_tone"
        parts.append(name)
    return "_and_".join(parts) if all(parts) else ""


def emoji_name(char: str) -> str:
    if char in EMOJI_SHORT_NAMES:
        return EMOJI_SHORT_NAMES[char]
    return unicodedata.name(char, "").lower().replace(" ", "_")
