import random
import re
import time

import numpy as np
import pytest
from helpers import odd_documents

from opinara.llm import pii_crf
from opinara.llm.spans import digests


def plain(text):
    found = {("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)}
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.add(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii_crf.luhn(digits):
            found.add(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.add(("phone", *m.span()))
    return found


def test_base_spans_agree_with_the_patterns():
    rng = random.Random(1)
    alphabet = "aZ09@@..+--  ()%_é1234567890"
    texts = ["a@b.c@d.e", "x@y@z.com", "1.2.3.4.5.6.7.8", "001.2.3.255 1.2.3.256", "4111 1111 1111 1111", "+1 (017) 555-7713.", "@a.b", "a@.b"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(5, 60))) for _ in range(3000)]
    for text in texts:
        assert set(pii_crf.base_spans(text)) == plain(text), text


def test_long_runs_take_linear_time():
    assert list(pii_crf.base_spans("1" * 300_000 + "@")) == []
    assert len(list(pii_crf.base_spans("a" * 300_000 + "@b.c"))) == 1


@pytest.fixture(scope="module")
def field(spark):
    return pii_crf.fit(spark.createDataFrame([(1, "write to a.b@mail.example.com now")], "doc_id long, text string"))


def test_marginals_are_those_of_all_segmentations(field):
    w = pii_crf.window("tel 555-1234567 x")
    assert 10 < len(w.spans) < 70
    score = field.scores(w.features)
    total, expected = 0.0, np.zeros_like(score)
    n = len(w.bounds) - 1

    def walk(at, weight, used):
        nonlocal total
        if at == n:
            total += weight
            for s, k in used:
                expected[s, k] += weight
            return
        walk(at + 1, weight, used)
        for s, (i, j) in enumerate(w.spans):
            if i == at:
                for k in range(score.shape[1]):
                    walk(j, weight * np.exp(score[s, k]), [*used, (s, k)])

    walk(0, 1.0, [])
    assert np.allclose(field.marginals(w, score), expected / total, atol=1e-6)


def test_blocks_give_the_same_as_one_run(field):
    rng = random.Random(8)
    texts = [t for t, _ in pii_crf.written_examples(rng, ["the", "report", "und"], 120)]
    whole = " ".join(texts)
    for text in [*texts, whole, "1-2 " * 300, "+1 " * 200, "a@b.c " * 100, "x at y dot z " * 60]:
        want = field.best(pii_crf.window(text))
        for block in (1, 19, pii_crf.BLOCK_TOKENS):
            assert list(field.decode(text, block)) == want, (block, text[:80])
    assert len(field.best(pii_crf.window(whole))) > 100


@pytest.mark.parametrize("piece", ["12 345 ", "a@b.c ", " at x dot y", "1", "@", "555-123-4567 "])
def test_field_takes_linear_time(field, piece):
    find = pii_crf.finder(field)
    find(piece * 100)

    def seconds(size):
        began = time.perf_counter()
        find(piece * (size // len(piece)))
        return time.perf_counter() - began

    assert seconds(160_000) < 12 * max(seconds(40_000), 0.05)


def test_spans_that_overlap_a_base_span_are_left_out(field):
    find = pii_crf.finder(field)
    base, more = find("mail a.b@c.de or a.b [at] c [dot] de, call (017) 555-7713 or +1 (017) 555-7713 today")
    assert {k for k, *_ in base} == {"email", "phone"} and {k for k, *_ in more} == {"email", "phone"}
    assert not any(a < y and x < b for _, a, b in more for _, x, y in base)
    assert pii_crf.merged([("a", 5, 9), ("b", 1, 3), ("c", 8, 12), ("d", 3, 4)]) == ([1, 3, 5], [3, 4, 12])


def test_field_finds_unseen_variants_and_spares_look_alikes(field):
    rng = random.Random(99)
    words = ["alpha", "report", "of", "the", "und", "les"]
    right = wrong = missed = 0
    for text, gold in pii_crf.written_examples(rng, words, 150):
        spans = set(field.best(pii_crf.window(text)))
        right, wrong, missed = right + len(spans & gold), wrong + len(spans - gold), missed + len(gold - spans)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.85


def test_written_addresses_with_several_dots(field):
    for address in (
        "john.smith [at] example [dot] co [dot] uk", "john (at) example (dot) co (dot) uk", "john dot smith at mail dot example dot co dot uk",
        "mary [dot] jones [at] physics [dot] university [dot] ac [dot] uk", "a.b [at] c [dot] d [dot] e [dot] com",
    ):
        text = f"please write to {address}, the report says"
        found = pii_crf.finder(field)(text)[1]
        assert ("email", 16, 16 + len(address)) in found, (address, found)


def test_frame(spark, field):
    docs = odd_documents(spark, ["mail me: a.b@c.de, or call (017) 555-7713 today", "no data here", "on 2024-01-05 at 12:30"])
    found = {r.doc_id: r for r in digests(pii_crf.scan(docs, field), pii_crf.KINDS).where("doc_id > 0 OR n_email > 0").collect()}
    assert found[0].n_email == 1 and found[0].spans.startswith("email:9:17")
    assert "phone" in found[0].spans and found[0].n_phone == 0
    assert found[1].spans == found[2].spans == found[900].spans == ""
    assert pii_crf.scan(docs.limit(0), field).count() == 0
