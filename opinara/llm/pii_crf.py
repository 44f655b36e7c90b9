"""Personal data by base patterns and a semi-Markov conditional random field.

The field scores whole segments: shape, digit groups, checksums, neighbours and cue words of a candidate decide on its
type together. Dynamic programming over segments of bounded length picks boundaries and types at once, within windows
around digits, at-signs and their written-out forms, outside of which no segment can score. It runs over a stretch of
any length in blocks that end where no candidate crosses, which gives the same as one run, and scores segments that
differ in their digits alone once.

The field is trained here, by gradient ascent on the likelihood, on windows around base matches of a bounded sample and
on written variants of them (other separators, spelled-out signs) among look-alikes that are no personal data. Windows
with further long numbers, of which the base patterns cannot tell what they are, are left out.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.llm.spans import Span, digests, with_spans

KINDS = ("email", "ip", "card", "phone")
# Fixed values of the base patterns. A look-behind only spares starts inside a run that has failed already.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
LONG_NUMBER = re.compile(r"[0-9](?:[().\x20-]*[0-9]){6,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# A written sign with its brackets and spaces is one token.
SIGN = (
    r"[ \t]*[\[({][ \t]?(?:at|dot)[ \t]?[\])}][ \t]*|(?<=\w)[ \t]+dot[ \t]+(?=\w)"
    r"|(?<=\w)[ \t]+at[ \t]+(?=[\w-]+[ \t]+(?:[\[({][ \t]?)?dot\b)"
)
TOKEN = re.compile(rf"{SIGN}|[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL | re.IGNORECASE)
WRITTEN_AT = r"[\[({]\s?at\s?[\])}]|\bat\b(?=\s[\w-]+\s(?:[\[({]\s?)?dot\b)"
SEED = re.compile(rf"[0-9@]|{WRITTEN_AT}", re.IGNORECASE)
AT = re.compile(rf"@|{WRITTEN_AT}", re.IGNORECASE)
DOT = re.compile(r"\s*(?:[\[({]\s?dot\s?[\])}]|\bdot\b)\s*", re.IGNORECASE)
DOT_BEFORE = re.compile(r"\w\s*(?:[\[({]\s?dot\s?[\])}]|\bdot)\s*\Z", re.IGNORECASE)
# Characters of context around a seed, and the most tokens of a segment.
REACH, LONGEST = 48, 18
# Tokens after which a block of the dynamic programme may end, and scores of segments that are kept. Results do not
# depend on them.
BLOCK_TOKENS, KEPT_SCORES = 4_096, 200_000
# Documents that training windows are taken from at most, windows from them, and written examples.
SAMPLE_DOCS, SAMPLE_WINDOWS, EXAMPLES, EPOCHS = 200, 150, 320, 6
CUES = {
    "email": ("email", "mail", "e-mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "mastercard", "amex", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
CUE_OF = {word: kind for kind, words in CUES.items() for word in words}
CUE_TOKENS = 6


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> Iterator[Span]:
    yield from emails(text)
    if not SEED.search(text):
        return
    for m in IP.finditer(text):
        if small_parts(m.group()):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            yield "card", *m.span()
    for m in PHONE.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= len(digits_of(m.group())) <= PHONE_DIGITS[1]:
            yield "phone", *m.span()


def bucket(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n > b for b in bounds)


def cue_before(tokens: Iterable[str]) -> str:
    """The kind that the nearest of the tokens before a segment hints at."""
    return next((CUE_OF[t.lower()] for t in reversed(list(tokens)) if t.lower() in CUE_OF), "")


MASK = str.maketrans("0123456789", "9999999999")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")


def segment_key(text: str, start: int, end: int, cue: str) -> tuple:
    """What the features of a span depend on: the span and what stands around it with all digits alike, and the checks
    that look at the digits themselves."""
    span = text[start:end]
    digits = digits_of(span)
    luhns = luhn(digits) if 13 <= len(digits) <= 19 else None
    parts = small_parts(span) if QUAD.fullmatch(span) else None
    signs = ("@" in span or "at" in span.lower()) and AT.search(span) is not None
    around = (text[max(0, start - 12) : start], text[end : end + 24]) if signs else (text[max(0, start - 1) : start], text[end : end + 2])
    return span.translate(MASK), around[0].translate(MASK), around[1].translate(MASK), cue, luhns, parts


def segment_features(text: str, start: int, end: int, cue: str) -> list[str]:
    """Features of the whole span text[start:end]; ``cue`` is the kind that a word shortly before it hints at."""
    span = text[start:end]
    digits = digits_of(span)
    groups = re.findall(r"[0-9]+", span)
    shape = re.sub(r"9+", "9", re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", re.sub(r"\s+", "_", span))))
    before, after = text[start - 1 : start], text[end : end + 1]
    found = [
        f"digits:{bucket(len(digits), (0, 3, 6, 8, 9, 11, 12, 13, 15, 16, 19))}",
        f"shape:{shape[:28]}",
        f"groups:{'-'.join(str(len(g)) for g in groups[:6])}",
        f"cue:{cue}",
        f"ats:{min(len(AT.findall(span)), 2)}",
    ]
    if before and (before.isalnum() or before in "_@%+-./#$&="):
        found.append("joined before")
    if after and (after.isalnum() or after in "_@%+/"):
        found.append("joined after")
    if re.match(r"[.,:-]\d", text[end : end + 2]):
        found.append("goes on")
    if span.startswith("+"):
        found.append("plus")
    if 13 <= len(digits) <= 19 and not re.search(r"[^0-9 -]", span):
        found.append(f"luhn:{luhn(digits)}")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span):
        found.append(f"quad:{small_parts(span)}")
    at = AT.search(span)
    if at:
        name, domain = span[: at.start()].strip(), DOT.sub(".", span[at.end() :].strip())
        whole = re.fullmatch(r"[\w.%+-]+", DOT.sub(".", name)) and re.fullmatch(r"[\w-]+(\.[\w-]+)*\.[a-z]{2,10}", domain)
        found.append(f"address:{bool(whole)}")
        found.append(f"sign:{at.group() == '@'}")
        more = DOT.match(text, end)
        if more and text[more.end() : more.end() + 1].isalnum() or DOT_BEFORE.search(text[max(0, start - 12) : start]):
            found.append("written dot beside")
    if not span[0].isalnum() and span[0] not in "+(" or not span[-1].isalnum():
        found.append("ragged")
    return found


@dataclass
class Window:
    """A stretch of a text with its tokens' bounds and the segments that may be personal data."""

    text: str
    bounds: list[int]
    spans: list[tuple[int, int]]
    features: list[list[str]]


def window(text: str) -> Window:
    bounds = [0, *(m.end() for m in TOKEN.finditer(text))]
    tokens = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    blank = [t.isspace() for t in tokens]
    seeds = [0] * (len(bounds))
    token = 0
    for m in SEED.finditer(text):
        while bounds[token + 1] <= m.start():
            token += 1
        seeds[token] = 1
    total = np.concatenate([[0], np.cumsum(seeds)]).tolist()
    spans, features = [], []
    for i, token in enumerate(tokens):
        if blank[i]:
            continue
        cue = cue_before(tokens[max(0, i - CUE_TOKENS) : i])
        for j in range(i + 1, min(i + LONGEST, len(tokens)) + 1):
            if not blank[j - 1] and total[j] > total[i] and "\n" not in token:
                spans.append((i, j))
                features.append(segment_features(text, bounds[i], bounds[j], cue))
    return Window(text, bounds, spans, features)


class Field:
    """Weights of features by kind; the segment outside is one token with score 0."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.weights = np.zeros((1, len(KINDS)))
        self.kept: dict[tuple, tuple[float, int]] = {}

    def scores(self, features: list[list[str]]) -> np.ndarray:
        """Rows of segments, columns of kinds; a segment of a shape never met starts from the bias alone."""
        unknown = self.weights[0]
        get = self.index.get
        rows = [[0, *(k for k in map(get, f) if k is not None)] for f in features]
        return np.array([self.weights[row].sum(axis=0) for row in rows]) if rows else np.zeros((0, len(unknown)))

    def learn(self, examples: list[tuple[Window, set[Span]]], epochs: int = EPOCHS, rate: float = 0.5) -> None:
        """Adagrad on the log-likelihood of the segmentations, with a light pull towards 0."""
        for w, _ in examples:
            for row in w.features:
                for f in row:
                    self.index.setdefault(f, len(self.index) + 1)
        self.weights = np.zeros((len(self.index) + 1, len(KINDS)))
        self.weights[0] = -3.0
        self.kept.clear()
        squares = np.full_like(self.weights, 1e-2)
        order = random.Random(11)
        rows = {id(w): [np.array([0, *(self.index[f] for f in row)]) for row in w.features] for w, _ in examples}
        for _ in range(epochs):
            order.shuffle(examples)
            for w, gold in examples:
                if not w.spans:
                    continue
                known = rows[id(w)]
                score = np.array([self.weights[row].sum(axis=0) for row in known])
                share = self.marginals(w, score)
                for n, (i, j) in enumerate(w.spans):
                    for k, kind in enumerate(KINDS):
                        if (kind, w.bounds[i], w.bounds[j]) in gold:
                            share[n, k] -= 1.0
                gradient = np.zeros_like(self.weights)
                for row, part in zip(known, share, strict=True):
                    if np.abs(part).max() > 1e-4:
                        gradient[row] += part
                touched = np.flatnonzero(np.abs(gradient).sum(axis=1))
                step = gradient[touched] + 1e-3 * self.weights[touched]
                squares[touched] += step**2
                self.weights[touched] -= rate * step / np.sqrt(squares[touched])

    def marginals(self, w: Window, score: np.ndarray) -> np.ndarray:
        """Probability of each segment and kind, by sums forward and backward over all segmentations."""
        n = len(w.bounds) - 1
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for number, (i, j) in enumerate(w.spans):
            ending[j].append(number)
            starting[i].append(number)
        whole = np.logaddexp.reduce(score, axis=1)
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[w.spans[s][0]] + whole[s] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[w.spans[s][1]] + whole[s] for s in starting[i])])
        first = np.array([i for i, _ in w.spans])
        last = np.array([j for _, j in w.spans])
        return np.exp(score + (ahead[first] + behind[last] - ahead[n])[:, None])

    def best(self, w: Window) -> list[Span]:
        """The spans of the likeliest segmentation."""
        score = self.scores(w.features)
        if not len(score) or score.max() <= 0:
            return []
        n = len(w.bounds) - 1
        kind, top = score.argmax(axis=1), score.max(axis=1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for number in np.flatnonzero(top > 0).tolist():
            ending[w.spans[number][1]].append(number)
        value, choice = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for number in ending[j]:
                reached = value[w.spans[number][0]] + float(top[number])
                if reached > value[j]:
                    value[j], choice[j] = reached, number
        found, j = [], n
        while j > 0:
            number = choice[j]
            if number < 0:
                j -= 1
                continue
            i = w.spans[number][0]
            found.append((KINDS[kind[number]], w.bounds[i], w.bounds[j]))
            j = i
        return found[::-1]

    def score(self, text: str, start: int, end: int, cue: str) -> tuple[float, int]:
        """The best kind of a segment and its score."""
        key = segment_key(text, start, end, cue)
        found = self.kept.get(key)
        if found is None:
            if len(self.kept) >= KEPT_SCORES:
                self.kept.clear()
            row = self.scores([segment_features(text, start, end, cue)])[0]
            found = self.kept[key] = (float(row.max()), int(row.argmax()))
        return found

    def decode(self, text: str, block: int = BLOCK_TOKENS) -> Iterator[Span]:
        """The spans of ``best(window(text))``, of a text of any length.

        Tokens come one by one; a block ends at a token bound that no candidate of positive score crosses, which is
        known LONGEST tokens later.
        """
        seeds = SEED.finditer(text)
        seed = next(seeds, None)
        # The last tokens: start, whether blank, number of seed tokens up to it, cue before it.
        recent: deque[tuple[int, bool, int, str]] = deque(maxlen=LONGEST)
        cues: deque[str] = deque(maxlen=CUE_TOKENS)
        value, choice, bound = [0.0], [None], [0]
        lowest: deque[int] = deque(maxlen=LONGEST)  # by end, the first start of a candidate, as a place in the block
        seen = 0
        for m in TOKEN.finditer(text):
            begin, end = m.span()
            token = m.group()
            blank = token.isspace()
            recent.append((begin, blank, seen, "" if blank else cue_before(cues)))
            cues.append(token)
            if seed is not None and seed.start() < end:
                seen += 1
                while seed is not None and seed.start() < end:
                    seed = next(seeds, None)
            value.append(value[-1])
            choice.append(None)
            bound.append(end)
            here = len(value) - 1
            first = here
            if not blank and seen > recent[0][2]:
                for back in range(len(recent)):
                    start, empty, before, cue = recent[-1 - back]
                    if empty or before == seen:
                        continue
                    top, kind = self.score(text, start, end, cue)
                    if top > 0:
                        place = here - 1 - back
                        first = place
                        if place >= 0 and value[place] + top > value[here]:
                            value[here], choice[here] = value[place] + top, (place, kind)
            lowest.append(first)
            if here >= block and len(lowest) == LONGEST:
                cut = here - LONGEST + 1
                if min(list(lowest)[1:]) >= cut:
                    yield from self._spans(choice[: cut + 1], bound)
                    base = value[cut]
                    value = [v - base for v in value[cut:]]
                    choice = [c if c is None else (c[0] - cut, c[1]) for c in choice[cut:]]
                    choice[0] = None
                    bound = bound[cut:]
                    lowest = deque((x - cut for x in lowest), maxlen=LONGEST)
        yield from self._spans(choice, bound)

    @staticmethod
    def _spans(choice: list, bound: list[int]) -> list[Span]:
        found, j = [], len(choice) - 1
        while j > 0:
            if choice[j] is None:
                j -= 1
                continue
            i, kind = choice[j]
            found.append((KINDS[kind], bound[i], bound[j]))
            j = i
        return found[::-1]


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around seeds that hold all context a segment can use, cut at white space."""
    start = end = -1
    for m in SEED.finditer(text):
        reach = REACH if len(m.group()) == 1 else 2 * REACH  # written-out addresses are longer
        a, b = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if a <= end:
            end = b
            continue
        if end >= 0:
            yield widened(text, start, end)
        start, end = a, b
    if end >= 0:
        yield widened(text, start, end)


def widened(text: str, start: int, end: int) -> tuple[int, int]:
    """The stretch without a word cut at either side; a word longer than REACH stays cut."""
    left = start
    while left > 0 and start - left < REACH and not text[left - 1].isspace():
        left -= 1
    right = end
    while right < len(text) and right - end < REACH and not text[right].isspace():
        right += 1
    return left, right


def merged(spans: Iterable[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def finder(trained: Field):
    def find(text: str) -> tuple[list[Span], list[Span]]:
        base = list(base_spans(text))
        more = set()
        starts, ends = merged(base)
        for start, end in stretches(text):
            for kind, a, b in trained.decode(text[start:end]):
                a, b = a + start, b + start
                before = bisect_left(starts, b) - 1  # the last covered stretch that begins before the span ends
                if before < 0 or ends[before] <= a:
                    more.add((kind, a, b))
        return base, list(more)

    return find


def written_examples(rng: random.Random, words: list[str], count: int) -> Iterator[tuple[str, set[Span]]]:
    """Sentences with personal data written in many ways, and with numbers that are none."""
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda: re.sub(r"[^a-z]", "", rng.choice(words).lower()) or "name"

    def card() -> str:
        body = rng.choice("3456") + number(rng.choice((14, 14, 14, 13)))
        digits = next(body + d for d in "0123456789" if luhn(body + d))
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return rng.choice(("", " ", "-", ".")).join(parts)

    def email() -> str:
        name = rng.choice(("{0}.{1}", "{0}{2}", "{0}_{1}", "{0}.{2}")).format(word(), word(), number(2))
        at = rng.choice(("@", "@", " [at] ", " (at) ", " at ", "[at]"))
        dot = "." if at == "@" else rng.choice((" dot ", " [dot] ", ".")) if at != " at " else " dot "
        if dot not in ".@" and rng.random() < 0.3:
            name = f"{word()}{dot}{word()}"
        labels = [*(word() for _ in range(rng.choice((1, 1, 2, 3)))), rng.choice(("com", "org", "net", "de", "fr", "uk"))]
        return f"{name}{at}{dot.join(labels)}"

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice(
            ("+1 ({0}) {1}-{2}", "({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "+44 {0} {1} {2}", "001 {0} {1} {2}", "1-{0}-{1}-{2}")
        ).format(a, b, c)

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def lookalike() -> str:
        bad = next(x for x in iter(lambda: number(16), None) if not luhn(x))
        return rng.choice(
            (
                f"20{number(2)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", number(4), f"{number(1)}.{number(1)}.{number(2)}",
                "".join(rng.choices("0123456789abcdef", k=32)), f"${number(3)}.{number(2)}", f"#{number(6)}", bad, f"@{word()}",
                f"{number(2)}:{number(2)}", f"{number(1)},{number(3)},{number(3)}", f"{word()}{number(2)}", f"{number(2)}%", f"{number(3)}.{number(3)}.{number(3)}.{number(3)}9",
                f"{number(8)}", f"{number(12)}x", f"{number(2)}/{number(2)}/{number(4)}", f"{word()} @ {word()}", f"{number(1)} - {number(2)}",
            )
        )

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    for _ in range(count):
        text, gold = "", set()
        for _ in range(rng.randint(1, 3)):
            text += " ".join(rng.choices(words, k=rng.randint(2, 6))) + rng.choice((" ", " ", ", ", ". "))
            if rng.random() < 0.4:
                text += lookalike()
            else:
                kind = rng.choice(KINDS)
                if rng.random() < 0.4:
                    text += rng.choice(CUES[kind]) + rng.choice((" ", ": "))
                value = makers[kind]()
                gold.add((kind, len(text), len(text) + len(value)))
                text += value
            text += rng.choice((" ", " ", ". ", ", ", "### ", " "))
        yield text + " ".join(rng.choices(words, k=3)), gold


def fit(docs: DataFrame, text: str = "text") -> Field:
    """A field trained on windows of at most SAMPLE_DOCS documents that hold a seed, and on written examples."""
    body = common.whole_text(text)
    rows = docs.select(body.alias("_t")).where(F.col("_t").rlike(r"[0-9]{4}|@")).take(SAMPLE_DOCS)
    rng = random.Random(5)
    words = ["the", "of", "and", "der", "que", "les", "una", "with", "report", "ending"]
    examples = []
    for (whole,) in rows:
        gold = list(base_spans(whole))
        words += whole[:400].split()[:20]
        for start, end in stretches(whole):
            if len(examples) < SAMPLE_WINDOWS and end - start < 400:
                own = {(k, a - start, b - start) for k, a, b in gold if start <= a and b <= end}
                if any(not any(a <= m.start() and m.end() <= b for _, a, b in own) for m in LONG_NUMBER.finditer(whole[start:end])):
                    continue
                examples.append((window(whole[start:end]), own))
    words = [w for w in words if w.isalpha()]
    examples += [(window(t), gold) for t, gold in written_examples(rng, words, EXAMPLES)]
    field = Field()
    field.learn(examples)
    return field


def scan(docs: DataFrame, field: Field | None = None, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with its personal data as an array of (kind, start, end, base) in order of start and kind.

    Null and empty texts have none; whole texts are scanned, however long; repeated rows get the same spans; a column
    named ``spans`` is replaced; an empty table stays empty. Spans of the field that overlap a base span are left out.
    """
    trained = field or fit(docs, text)
    return with_spans(docs, text, spans, KINDS, lambda: finder(trained))


def op9_pii_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder).select("doc_id", "text")
    return digests(scan(docs).drop("text"), KINDS)
