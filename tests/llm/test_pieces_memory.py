"""What a Python worker keeps of the words it has encoded stays small, and small tables change no ids."""

from __future__ import annotations

from itertools import product

import numpy as np
import public_tokenizers

from trilayer.llm.pieces import Pieces


def test_few_words_are_kept():
    model = public_tokenizers.path("piece_bpe_32k.model")
    coder = Pieces(model)
    words = ["".join(w) for w in product(*["bdfghklmnprst", "aeiou"] * 2, "xyz", "aeiou", "lmnr")]
    for at in range(0, len(words), 10_000):
        batch = " ".join(words[at : at + 10_000])
        ids = coder.encode_batch([batch])[0]
        assert len(coder.known) + len(coder.older) <= 130_000
    small = Pieces(model, kept_words=10)
    assert small.encode_batch([batch]) == [ids] and small.decode(ids) == batch
    # In the order of a later batch, with words known, forgotten and new.
    mixed = " ".join(words[::977])
    assert coder.encode_batch([mixed]) == Pieces(model).encode_batch([mixed])
    assert len(words) > 200_000


def test_a_character_is_looked_up_once():
    coder = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["unhappiness unhappily, happily ever after", "naïve 日本語 ſtraße \U0001f600 ▁▁ ▁a", "q" * 200]
    # The pieces that end at a prefix come from the end before and one character, the longest first.
    for word in coder.model.normalize(texts[0]).split("▁"):
        end = coder.end("")
        for i, c in enumerate(word):
            end = coder.move(end, c)
            longer = [word[j : i + 1] for j in range(i) if word[j : i + 1] in coder.ids]
            assert [p for p, _, _ in end.pieces] == [*longer, c]
            assert len(end.text) <= max(map(len, coder.ids))
    found = coder.encode_batch(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [coder.model.encode(t) for t in texts]
    # A known move is not made again, and forgetting all of them changes nothing.
    coder.known.clear()
    coder.older.clear()
    made = coder.moves
    assert coder.encode_batch(texts[:1]) == found[:1] and coder.moves == made
    coder.known.clear()
    coder.moves = coder.tested = 1 << 30
    assert coder.encode_batch(texts) == found
