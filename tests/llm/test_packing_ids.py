"""Ids by way of pieces and runs against the plain tokenizer, on random signs."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tablelab.llm.packing import ChunkIds

SIGNS = "abcdefgxyzstréèßüñçøÿĀāőŉǅDÉÑİıſK'’`´.,;:!?#*-_/\\()[]{}<>@&%$0123456789\t\n   ̧́日本한ªº²½µ×÷\U0001f600 \x85\x1f\x00"
WORDS = ["it's", "'tis", "don't", "we'll", "l'été", "word***", "thing.", "a1b2", "x...y", "ÉTÉ", "straße,", "naïve!", "<|endoftext|>", "'S", "can''t", "ﬁ", "ǅ", "ó", "ó"]


def test_ids_are_the_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, ids = Tokenizer.from_file(path), ChunkIds(path, limit=2000)
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) if rng.random() < 0.7 else " ".join(rng.choice(WORDS) for _ in range(8))
        assert np.frombuffer(ids.encode([text])[0], ids.kind).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert ids.old
