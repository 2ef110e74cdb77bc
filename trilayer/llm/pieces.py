"""SentencePiece encoding and decoding with a trie of words.

Texts are normalized by the model and cut before each word mark. The distinct marked words
of a batch are sorted, so that walking through them is a depth-first walk of their trie: forward
states of a prefix are kept and reused by all words that share it. The state of a prefix is
its last piece: a piece may follow a state if the two stay apart when the model joins pieces, and
exactly one piece fits each prefix, so the path back from a word's end is the encoding the model's own merges
give. (A model of this kind joins pieces by rank; its scores add up to nothing, so a best-sum path would
give other ids than the model.)
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.llm.common import read, slices

MARK = "▁"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class End:
    """The end of a text as the walk sees it: ``text``, the longest part at the end that begins a piece, the ``pieces`` that end there, each
    with its length and what is known of its staying apart, and the ends ``after`` a further character.
    """

    __slots__ = ("text", "pieces", "after")

    def __init__(self, text: str, pieces: list[tuple[str, int, dict[str, bool]]]):
        self.text, self.pieces, self.after = text, pieces, {}


class Pieces:
    """The pieces of a model and the trie walk."""

    def __init__(self, model_file: str, kept_words: int = 50_000):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = m.get_piece_size()
        self.names = [m.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.rank = {self.names[i]: m.get_score(i) for i in plain}
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        self.unknown = m.unk_id()
        # The beginnings of pieces. What ends a text is known by the longest of them that ends it.
        self.beginnings = {p[:i] for p in self.ids for i in range(len(p) + 1)}
        # Words can be cut before a mark only if no piece holds a mark after another character.
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces of this model cross word marks")
        shown = [b"" if m.is_control(i) or m.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.names)]
        for b, i in self.bytes.items():
            shown[i] = bytes([b])
        self.shown = shown
        self.ends: dict[str, End] = {}
        self.apart: dict[str, dict[str, bool]] = {}
        self.tested = self.moves = 0
        self.packed: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept_words = kept_words

    def merged(self, text: str) -> list[str]:
        """Pieces of a short string: join the adjacent pair of highest rank, leftmost first."""
        parts, get, none = list(text), self.rank.get, -np.inf
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (best := max(ranks)) > none:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            # Only the pairs beside the new part change.
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether joining leaves ``b`` whole after ``a``, which is empty at the start of a word."""
        if self.tested > 400_000:
            for known in self.apart.values():
                known.clear()
            self.tested = 0
        self.tested += 1
        return self.merged(a + b) == ([a, b] if a else [b])

    def end(self, text: str) -> End:
        """The end of ``text``: that of its longest part at the end that begins a piece. Ends of one such part are one object."""
        while text not in self.beginnings:
            text = text[1:]
        if text not in self.ends:
            pieces = [text[i:] for i in range(len(text) - 1) if text[i:] in self.ids]
            # One character is always a piece.
            pieces += [text[-1]] if text else []
            self.ends[text] = End(text, [(p, len(p), self.apart.setdefault(p, {})) for p in pieces])
        return self.ends[text]

    def move(self, end: End, c: str) -> End:
        """The end that follows ``end`` after ``c``; kept with it."""
        if self.moves > 400_000:
            for e in self.ends.values():
                e.after.clear()
            self.moves = 0
        self.moves += 1
        following = self.end(end.text + c)
        if not following.pieces:
            # No piece begins with this character, so it is kept nowhere.
            return End("", [(c, 1, {})])
        end.after[c] = following
        return following

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Each of the sorted ``words`` with its pieces. ``last[i]`` is the last piece of the prefix of length i, ``ends[i]`` its end.

        The end of a prefix has the pieces that end there, the longest first, so only these are tried.
        """
        last, ends, previous = [""], [self.end("")], ""
        for word in words:
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], ends[shared + 1 :]
            at = ends[shared]
            for to, c in enumerate(word[shared:], shared + 1):
                following = at.after.get(c)
                at = self.move(at, c) if following is None else following
                ends.append(at)
                for piece, n, known in at.pieces:
                    before = last[to - n]
                    found = known.get(before)
                    if found is None:
                        found = self.stay_apart(before, piece)
                        known[before] = found
                    if found:
                        last.append(piece)
                        break
                else:
                    raise ValueError(f"no piece ends at {to} of {word!r}")
            found, to = [], len(word)
            while to:
                found.append(last[to])
                to -= len(last[to])
            yield word, found[::-1]
            previous = word

    def piece_ids(self, piece: str) -> bytes:
        """The ids of a piece as little-endian 32-bit numbers: its own, or those of its bytes."""
        if piece in self.ids:
            ids = [self.ids[piece]]
        else:
            ids = [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode the words not yet known. What was used before stays as an older generation when the table is full."""
        if len(self.known) >= self.kept_words:
            self.older, self.known = self.known, {}
        for w in words & self.older.keys():
            self.known.setdefault(w, self.older[w])
        packed = self.packed
        for word, found in self.walk(sorted(words - self.known.keys())):
            for p in found:
                if p not in packed:
                    packed[p] = self.piece_ids(p)
            self.known[word] = b"".join([packed[p] for p in found])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        marked = [_MARKED.findall(self.model.normalize(t)) if t else [] for t in texts]
        self.learn(set().union(*marked) if marked else set())
        return [b"".join([self.known[w] for w in ws]) for ws in marked]

    def decode(self, ids: bytes) -> str:
        """The normalized text, without the blank put before it."""
        shown = self.shown
        text = b"".join([shown[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text.removeprefix(" ")


def pieces(model_file: str, _kept: dict = {}) -> Pieces:
    """One walker for each Python worker."""
    if model_file not in _kept:
        _kept[model_file] = Pieces(model_file)
    return _kept[model_file]


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, 32-bit little-endian) and ``decoded``, the text made from the ids again.

    Null and empty texts have no ids. Every row of ``docs`` gives one row; other columns are ignored. No shuffle.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model_file)
        for batch in slices(batches, rows=200, most_bytes=1 << 19):
            ids = coder.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([coder.decode(i) for i in ids], pa.string())], ["doc_id", "ids", "decoded"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(encode, "doc_id bigint, ids binary, decoded string")


def encoded_digest(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, text_sha256`` of the documents' pieces and of the text decoded from them."""
    return encode_documents(docs, model_file).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded_digest(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
