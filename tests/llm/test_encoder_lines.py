"""Pieces with line feeds in the encoder of whole texts."""

import random

import public_tokenizers

from creditlake.llm.encoding import Encoder

PARTS = ["a", "B.", "don't", "word", "\n", "\n", " ", "\t", "\r", "　", "\xa0", "中", "12", "!", "x" * 60, " \n", "\n\n", "\x1f", "'s"]


def test_words_beside_a_line_feed_are_kept_one_by_one():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"the end{i}.\nNext{i % 7} one" for i in range(50)]
    for text in texts:
        assert encoder.encode(text) == encoder._library(text)
    assert not any("\n" in piece for piece in [*encoder.first, *encoder.later])


def test_ids_are_those_of_the_library_around_line_feeds():
    pick = random.Random(3)
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2000):
        text = "".join(pick.choices(PARTS, k=pick.randint(1, 12)))
        assert encoder.encode(text) == encoder._library(text), repr(text)
