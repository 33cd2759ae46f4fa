"""Texts that are encoded together."""

import random

import public_tokenizers
import pytest

from creditlake.llm.encoding import Encoder

PARTS = ["a", "B.", "don't", "word", "\n", " ", "\t ", "\r", "　", "\xa0", "中", "12", "!", "x" * 60, "\x0b", "\x1f", "'s", "é,", "<|endoftext|>"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_together_have_the_ids_of_each(name):
    pick = random.Random(4)
    encoder = Encoder(public_tokenizers.path(name))
    texts = ["", " ", *("".join(pick.choices(PARTS, k=pick.randint(0, 12))) for _ in range(1500))]
    assert encoder.encode_all(texts) == [encoder._library(text) for text in texts]
    assert encoder.encode_all([]) == [] and encoder.encode_all([""]) == [b""]


def test_a_word_is_looked_up_once_for_all_texts():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    asked = []

    class Asked(dict):
        def __getitem__(self, word):
            asked.append(word)
            return b"1234" if word else b""

    encoder.first = Asked()
    assert encoder.encode_all(["b a a", "", "a\n b"]) == [b"1234" * 3, b"", b"1234" * 2]
    assert sorted(filter(None, asked)) == ["a", "b"]
