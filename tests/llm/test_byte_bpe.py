import base64
import random

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import Row

from opinara.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.RANKS)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(texts):
    return [ids.tolist() for ids in byte_bpe.Tokenizer(PATH, public_tokenizers.PATTERN).encode_batch(texts)]


def test_agrees_with_the_library_on_hard_texts():
    rng = random.Random(3)
    alphabet = "aaabct  \t\n\r\x0b\x1c\x1f\x85\xa0 　'sé٣५中文字🙂🙂́‍<|endoftext|>.,!?0123456789Ǆßſ"
    texts = ["", "a" * 5000, "ab" * 3000, "the" * 999, "\x1c\x1d \x1e\x1f", "I'll we've DON'T", "<|endoftext|>"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(600)]
    texts += ["".join(chr(rng.choice([c for c in (rng.randint(1, 0xFFFF), 65) if not 0xD800 <= c < 0xE000])) for _ in range(80)) for _ in range(200)]
    for text, ids in zip(texts, encoded(texts), strict=True):
        assert ids == LIBRARY.encode_ordinary(text), text
        assert LIBRARY.decode_bytes(ids) == text.encode()


def test_every_code_point_is_split_alike():
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)} {chr(c)}1" for c in points[k : k + 512]) for k in range(0, len(points), 512)]
    assert encoded(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_queue_pops_lowest_rank_first_and_forgets_nothing():
    queue = byte_bpe.RankQueue(50_000)
    for rank in (4097, 63, 64, 49_999, 63):
        queue.push(rank, np.array([rank]))
    popped = []
    while (found := queue.pop()) is not None:
        popped.append((found[0], found[1].tolist()))
    assert popped == [(63, [63, 63]), (64, [64]), (4097, [4097]), (49_999, [49_999])]


def test_long_piece_takes_linear_time_and_right_ids():
    text = "abcdefgh" * 20_000
    (ids,) = encoded([text])
    assert byte_bpe.vocabulary(PATH).decode(np.array(ids)) == text.encode()
    assert encoded([text[:4000]]) == [LIBRARY.encode_ordinary(text[:4000])]


def test_frame_with_nulls_repeats_and_clashing_columns(spark):
    rows = [Row(doc_id=1, text="It's me", token_ids="x"), Row(doc_id=None, text=None, token_ids=None)] + [
        Row(doc_id=2, text="", token_ids="y")
    ] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    found = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.text or "", bytes(r.decoded).decode()) for r in found) == [
        (0, "", ""), (1, "It's me", "It's me"), (2, "", ""), (2, "", "")
    ]
    at_once = byte_bpe.encode(docs, decoded="decoded").collect()
    assert sorted(map(str, at_once)) == sorted(map(str, found))
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs.limit(0)))).count() == 0
