"""Token ids in compressed binary files.

Documents are range-partitioned and sorted by id, encoded, and packed into blocks. Each
document is a zstandard frame of its own, made with a dictionary shared by all blocks, so a
short document compresses well and can be read alone through the block's index. Spark's
Parquet writer carries the blocks: a lost executor repeats only its own blocks.

A block, little-endian:
    magic ``TIDS``, uint8 id width, uint32 n, 32 bytes SHA-256 of the dictionary,
    n int64 doc ids, n uint8 (1: the doc id is null), n uint32 id counts, n+1 uint64 frame offsets, frames.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.llm.common import read, slices
from trilayer.operators.settle import scratch_path

MAGIC = b"TIDS"
HEAD = struct.Struct("<4sBI32s")

# Unicode white space, as the tokenizer's own patterns see it.
_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")
#: Marks that are one unit when they stand in a row; an apostrophe may begin one with letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _plainly_spaced(text: str) -> bool:
    """Whether all white space is single spaces and line ends between words."""
    return not (
        text[0] in " \n" or text[-1] in " \n" or any(r in text for r in _RUNS)
        or not text.isascii() and _OTHER_SPACE.search(text)
    )


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


class _Pieces(dict):
    """Ids of text pieces as bytes, for the last ``most`` to twice as many distinct pieces.

    When full, what was used lately stays as the older generation, so memory is bounded and
    frequent pieces are not encoded again.
    """

    def __init__(self, encode, most: int = 200_000):
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts by the tokenizers library, with each distinct piece encoded once.

    The vocabulary's pre-tokenizer never lets a token span the border between white space and
    the word before it, so texts are cut there and the ids of pieces are joined. A text
    that holds the string of a special token is encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        self.spaced, self.bare = _Pieces(self._spaced), _Pieces(self._bare)
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.code = "H" if self.width == 2 else "I"
        letters = byte_letters()
        self.letters, self.space = "".join([letters[b] for b in range(256)]), letters[32]

    def _word(self, spelled: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _spelled(self, letters: str) -> str:
        return letters if letters.isascii() else codecs.charmap_decode(letters.encode(), "strict", self.letters)[0]

    def _bare(self, piece: str) -> bytes:
        """Ids of ``piece``. Letters are one unit, as are marks after them."""
        stem = piece.rstrip(_MARKS)
        if stem.isalpha():
            return self._word(self._spelled(piece)) if len(stem) == len(piece) else self.bare[stem] + self.bare[piece[len(stem) :]]
        return b"".join([self._word(w) for w, _ in self.split(piece)])

    def _spaced(self, piece: str) -> bytes:
        """Ids of a space and ``piece``. A space and letters are one unit, as are marks after them."""
        stem = piece.rstrip(_MARKS)
        if stem.isalpha():
            if len(stem) == len(piece):
                return self._word(self.space + self._spelled(piece))
            return self.spaced[stem] + self.bare[piece[len(stem) :]]
        return self._bare(" " + piece)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        bare, spaced = self.bare, self.spaced.__getitem__
        if not _plainly_spaced(text):
            return b"".join([bare[c] for c in _CHUNK.findall(text)])
        out, end = [], bare["\n"]
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(bare[first])
            out += map(spaced, rest)
            out.append(end)
        return b"".join(out[:-1])


def encoder(tokenizer_file: str, _kept: dict = {}) -> Encoder:
    """One encoder for each Python worker."""
    if tokenizer_file not in _kept:
        _kept[tokenizer_file] = Encoder(tokenizer_file)
    return _kept[tokenizer_file]


def train_dictionary(docs: DataFrame, tokenizer_file: str, end_id: int, samples: int = 1000, size: int = 32 << 10, longest: int = 4000) -> bytes:
    """A zstandard dictionary from id arrays of up to ``samples`` texts of at most ``longest`` characters.

    The sample goes by the hashes of all texts; it bounds what
    reaches the driver and is the only sampled thing here. Too little text gives an
    empty dictionary, which compresses plainly.
    """
    # About four times as many come through the threshold, so that the sort handles few.
    chance, steps = 4 * samples / max(1, docs.count()), 1 << 30
    texts = docs.where(F.length("text").between(1, longest)).select("text")
    if chance < 1:
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < int(chance * steps))
    texts = texts.orderBy(F.xxhash64("text"), "text").limit(samples).collect()
    encode = encoder(tokenizer_file)
    end = np.array([end_id], encode.kind).tobytes()
    try:
        return zstandard.train_dictionary(size, [encode.encode(r["text"]) + end for r in texts]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def pack(rows: list[tuple[int | None, int, bytes]], width: int, dictionary_hash: bytes) -> bytes:
    """A block from (doc_id, number of ids, frame) of each document."""
    n = len(rows)
    offsets = np.zeros(n + 1, "<u8")
    np.cumsum([len(f) for _, _, f in rows], out=offsets[1:])
    return b"".join([
        HEAD.pack(MAGIC, width, n, dictionary_hash),
        np.array([r[0] or 0 for r in rows], "<i8").tobytes(), np.array([r[0] is None for r in rows], "u1").tobytes(),
        np.array([r[1] for r in rows], "<u4").tobytes(), offsets.tobytes(), *[f for _, _, f in rows],
    ])


class Block:
    """A block's index; ``ids(i)`` decompresses one document and no other."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, n, said = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        if said != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = HEAD.size
        self.data, self.n = data, n
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.nulls = np.frombuffer(data, "u1", n, at + 8 * n).astype(bool)
        self.counts = np.frombuffer(data, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 13 * n)
        self.frames = at + 13 * n + 8 * (n + 1)
        kept = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.decompressor = zstandard.ZstdDecompressor(**kept)

    def ids(self, i: int) -> np.ndarray:
        start, end = (self.frames + int(self.offsets[j]) for j in (i, i + 1))
        raw = self.decompressor.decompress(self.data[start:end], max_output_size=int(self.counts[i]) * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")


FILE_SCHEMA = "slice int, ids_before bigint, n_ids bigint, n_docs int, first_doc_id bigint, last_doc_id bigint, dictionary_sha256 string, block binary"


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, block_bytes: int = 2 << 20, level: int = 3
) -> bytes:
    """Write the ids of ``docs`` (``doc_id``, ``text``) in ascending ``doc_id`` order; return the dictionary.

    A null or empty text is the end id alone. Null ids come first, rows with one id are
    ordered by text and all kept. Other columns are ignored. An empty table gives no blocks.
    The dictionary is also written beside the blocks.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    dictionary = train_dictionary(docs, tokenizer_file, end_id)
    digest = hashlib.sha256(dictionary).digest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        end = np.array([end_id], encode.kind).tobytes()
        kept = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compress = zstandard.ZstdCompressor(level=level, **kept).compress
        part, before, rows, held, ids = TaskContext.get().partitionId(), 0, [], 0, 0

        def block() -> pa.RecordBatch:
            known = [r[0] for r in rows if r[0] is not None]
            values = [part, before, ids, len(rows), min(known, default=None), max(known, default=None), digest.hex(), pack(rows, encode.width, digest)]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [c.split()[0] for c in FILE_SCHEMA.split(", ")])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = encode.encode(text) + end
                rows.append((doc_id, n := len(raw) // encode.width, frame := compress(raw)))
                held, ids = held + len(frame), ids + n
                if held >= block_bytes:
                    yield block()
                    before, rows, held, ids = before + ids, [], 0, 0
        if rows:
            yield block()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, FILE_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    docs.sparkSession.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    return dictionary


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document from its files.

    ``start`` counts the ids of all documents before: the slice's place comes from one row
    per written slice (no more than the writer had partitions), the rest from the blocks.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    blocks = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/blocks")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1):
            block = Block(batch.column(2)[0].as_py(), dictionary)
            starts = batch.column(1)[0].as_py() + np.concatenate([[0], np.cumsum(block.counts.astype(np.int64))[:-1]])
            sums = [zlib.crc32(block.ids(i).astype("<u4").tobytes()) for i in range(block.n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[0].as_py()] * block.n, pa.int32()), pa.array(block.doc_ids, pa.int64(), mask=block.nulls),
                 pa.array(starts, pa.int64()), pa.array(block.counts.astype(np.int64)), pa.array(sums, pa.int64())],
                ["slice", "doc_id", "start", "n_tokens", "ids_crc32"],
            )

    rows = blocks.select("slice", "ids_before", "block").mapInArrow(documents, "slice int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = {r["slice"]: r["ids"] for r in blocks.groupBy("slice").agg(F.sum("n_ids").alias("ids")).collect()}
    bases, total = {}, 0
    for part in sorted(sizes):
        bases[part], total = total, total + sizes[part]
    base = spark.createDataFrame(list(bases.items()), "slice int, base bigint")
    return rows.join(F.broadcast(base), "slice").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path)
