"""Words a worker hasn't seen are asked for in one fast call; the bytes tell whose the tokens are."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from postroom.llm import token_ids

WORDS = public_tokenizers.path("word_bpe_49k.json")


def fresh_words(n):
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzàçéßøłśž"
    return sorted({"".join(draw.choices(letters, k=draw.randint(1, 18))) for _ in range(n)}) + [".", "!?", "...;:"]


class Spy:
    def __init__(self, real):
        self.real, self.slow = real, 0

    def encode(self, *a, **k):
        self.slow += 1
        return self.real.encode(*a, **k)

    def encode_batch_fast(self, *a, **k):
        return self.real.encode_batch_fast(*a, **k)


def cut(ids, lengths):
    ends = lengths.cumsum()
    return [ids[e - n : e].tolist() for e, n in zip(ends, lengths)]


def test_fast_call_gives_the_tokens_of_each_word():
    encoder, words = token_ids.WordEncoder(WORDS, 2), fresh_words(3000)
    encoder.pieces = Spy(encoder.pieces)
    library = Tokenizer.from_file(WORDS)
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert cut(*encoder._slices(words, False)) == want and encoder.pieces.slow == 0
    assert cut(*encoder._slices(words[:50], True)) == want[:50]


def test_other_lengths_of_tokens_take_the_slow_call():
    encoder, words = token_ids.WordEncoder(WORDS, 2), fresh_words(300)
    want = cut(*encoder._slices(words, False))
    encoder.pieces = Spy(encoder.pieces)
    encoder.n_bytes = encoder.n_bytes + 1
    assert cut(*encoder._slices(words, False)) == want and encoder.pieces.slow == 1
