"""Words with marks after them are encoded by their parts, with the library's ids."""

from __future__ import annotations

import random

import public_tokenizers

from trilayer.llm.token_files import Encoder


def _encoder() -> Encoder:
    return Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_marks_after_letters_need_no_cutting_by_the_library():
    encode, cut = _encoder(), []
    split = encode.split
    encode.split = lambda piece: cut.append(piece) or split(piece)
    text = "mots&&& école### été%%% words. mots*** été&&& mots... Ünder,\nmots, été"
    assert encode.encode(text) == encode.whole(text)
    assert not [piece for piece in cut if any(c.isalpha() for c in piece)]


def test_pieces_of_any_characters_have_the_ids_of_the_library():
    some, encode = random.Random(7), _encoder()
    letters = "abcSé'’.,!\"#&&()-_ \n\t09日本́ªº²½ⅷǅʰ\x85\xa0<|>"
    for _ in range(4000):
        text = "".join(some.choices(letters, k=some.randint(1, 14)))
        assert encode.encode(text) == encode.whole(text), repr(text)
