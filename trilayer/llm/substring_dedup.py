"""Removal of passages of words that an earlier document holds, by prefix-partitioned suffix trees.

Suffixes begin at words. Two equal windows of ``WINDOW`` words have the smallest hash of ``GRAM`` words at the same place,
their anchor, so only suffixes at anchors are needed, and of these only those whose first words stand in several documents.
A suffix goes to the group of its first ``GRAM`` words with as many words before it as a window can hold.

A group of more than ``LIMIT`` different suffixes is split by longer prefixes: the windows that begin late share more
words behind the anchor, those that begin early share words before it, so each half is grouped by what all of its windows
share and keeps only what they hold. Groups of a single kind of window have one member each.

In a task, the suffixes of a group are sorted and what neighbours share gives the tree. The leaves below a node as deep as a window
behind the anchor, told apart by the words before it, are the documents that hold the window; the smallest is noted.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.llm.common import joined_by_size, read, rolling, slices, span_hashes
from trilayer.llm.suffix_dedup import sliding
from trilayer.operators import keyed_left_join, settle
from trilayer.operators.settle import scratch_path

#: Words of a window, words whose hash makes an anchor, and the most words of a window before its anchor.
WINDOW, GRAM = 13, 6
BEFORE = WINDOW - GRAM
#: Different suffixes of a group, up to which one tree is built.
LIMIT = 20_000
#: Bytes of a text that are split into words at a time.
PART = 4 << 20
#: Anchors a task looks through for repeats of its own.
HELD = 1_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_FIRST = -(1 << 63)


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, own, text``: ``doc`` is the id with null as the smallest, ``own`` tells rows of one id apart by their text."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(_FIRST)).alias("doc"), F.xxhash64(text).alias("own"), text.alias("text"))


def _row() -> Column:
    return F.xxhash64("doc", "own")


def parts(text: bytes, size: int = PART) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``size`` bytes at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def overlapping(text: bytes, size: int = PART) -> Iterator[tuple[int, list[bytes]]]:
    """The number of the first word and the words of each part; every window is whole in one of them."""
    first, kept = 0, []
    for words in parts(text, size):
        words = kept + words
        yield first, words
        kept = words[-(WINDOW - 1) :]
        first += len(words) - len(kept)


class Stretch:
    """Words of several texts side by side with their anchors: ``word`` numbers in the stretch, ``text`` and ``hash``."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([len(w) for w in texts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.empty(0, np.int64)
        self.end = self.begin + sizes
        self.data = b" ".join(b" ".join(w) for w in texts if w)
        bytes_ = np.frombuffer(self.data, np.uint8)
        gaps = np.flatnonzero(bytes_ == 32)
        self.starts = np.concatenate([[0], gaps + 1])
        self.stops = np.concatenate([gaps, [len(bytes_)]])
        self.word = self.text = np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        n = int(sizes.sum())
        if n < WINDOW:
            return
        sums, down = rolling(bytes_)
        grams = span_hashes(sums, down, self.starts[: n - GRAM + 1], self.stops[GRAM - 1 :])
        short = (grams >> np.uint64(32)).astype(np.uint32)
        smallest = sliding(short, BEFORE + 1, True).astype(np.uint64) + np.uint64(1)
        # Windows that would leave their text count for nothing.
        left = np.repeat(self.end, sizes)[: len(smallest)] - np.arange(len(smallest))
        smallest[left < WINDOW] = 0
        padded = np.concatenate([np.zeros(BEFORE, np.uint64), smallest, np.zeros(BEFORE, np.uint64)])
        self.word = np.flatnonzero(sliding(padded, BEFORE + 1, False)[: len(short)] == short.astype(np.uint64) + np.uint64(1))
        self.text = np.searchsorted(self.begin, self.word, side="right") - 1
        self.hash = grams[self.word]

    def between(self, first: int, end: int) -> bytes:
        return self.data[self.starts[first] : self.stops[end - 1]] if end > first else b""


def _stretches(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[list[int], list[int], Stretch]]:
    """Row numbers, numbers of the first words and the stretch of the parts of a batch; long texts have stretches of their own."""
    rows, firsts, held = [], [], []
    for i, value in enumerate(batch.column(text).to_pylist()):
        if len(value) <= PART:
            rows.append(i)
            firsts.append(0)
            held.append(value.split())
            continue
        for first, words in overlapping(value):
            yield [i], [first], Stretch([words])
    if rows:
        yield rows, firsts, Stretch(held)


# --- suffixes that may repeat -----------------------------------------------------


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``x, doc, row, at, seen``: anchors by hash. ``seen`` tells that a task met the hash in two documents.

    Such anchors need no further look, so each task sends only one row (``at`` -1) to the place where its hash is
    counted: a hash that stands in a third of all texts costs that place one row a stretch of anchors.
    """
    held: list[tuple[np.ndarray, ...]] = []

    def part() -> pa.RecordBatch:
        x, doc, row, at = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((doc, x))
        x, doc, row, at = x[order], doc[order], row[order], at[order]
        new = np.concatenate([[True], x[1:] != x[:-1]])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(x)]]) - 1
        twice = doc[first] != doc[last]
        seen = twice[group]
        marks = first[twice]
        columns = [
            np.concatenate([x, x[marks]]).view(np.int64), np.concatenate([doc, doc[marks]]), np.concatenate([row, row[marks]]),
            np.concatenate([at, np.full(len(marks), -1)]).astype(np.int64), np.concatenate([seen, np.ones(len(marks), bool)]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["x", "doc", "row", "at", "seen"])

    for batch in slices(batches):
        doc, row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
        for rows, firsts, stretch in _stretches(batch):
            of, first = np.array(rows)[stretch.text], np.array(firsts)[stretch.text]
            held.append((stretch.hash, doc[of], row[of], stretch.word - stretch.begin[stretch.text] + first))
        if sum(len(h[0]) for h in held) > HELD:
            yield part()
    if held and sum(len(h[0]) for h in held):
        yield part()


def _in_two_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, at`` of anchors from rows sorted by ``x, doc``: those seen twice, and those whose hash has two documents or a mark."""
    held: pa.RecordBatch | None = None

    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        x, doc, at, seen = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("x", "doc", "at", "seen"))
        new = np.concatenate([[True], x[1:] != x[:-1]])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(x)]]) - 1
        marked = np.logical_or.reduceat(at < 0, first)
        group = np.cumsum(new) - 1
        keep = ((doc[first] != doc[last]) | marked)[group] | seen
        return rows.select(["row", "at"]).filter(pa.array(keep & (at >= 0)))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([held, batch]) if held is not None else batch
        x = rows.column("x").to_numpy()
        # The last hash may go on in the next batch.
        whole = int(np.searchsorted(x, x[-1]))
        if whole:
            yield kept(rows.slice(0, whole))
        held = rows.slice(whole)
    if held is not None:
        yield kept(held)


def _spots(rows: DataFrame) -> DataFrame:
    """``row, spots``: the words of each text at which a suffix may repeat, 64 to a number."""
    anchors = rows.select("doc", _row().alias("row"), "text").mapInArrow(_anchors, "x bigint, doc bigint, row bigint, at bigint, seen boolean")
    # Anchors known to repeat need not meet their hash, so they are dealt out by their text.
    dealt = anchors.withColumn("to", F.when(F.col("seen") & (F.col("at") >= 0), F.col("row")).otherwise(F.col("x")))
    sorted_ = dealt.repartition("to").sortWithinPartitions("x", "doc").drop("to")
    found = sorted_.mapInArrow(_in_two_documents, "row bigint, at bigint")
    bits = found.groupBy("row", F.floor(F.col("at") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b")
    )
    return settle(bits.groupBy("row").agg(F.collect_list(F.struct("w", "b")).alias("spots")))


# --- their contexts ----------------------------------------------------------------


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``x, doc, own, at, before, after`` of the chosen suffixes: the words of all windows around the anchor."""
    for batch in slices(batches):
        doc, own = batch.column("doc").to_numpy(), batch.column("own").to_numpy()
        wanted = [{s["w"]: s["b"] for s in spots or ()} for spots in batch.column("spots").to_pylist()]
        for rows, firsts, stretch in _stretches(batch):
            out = []
            for word, i, x in zip(stretch.word.tolist(), stretch.text.tolist(), stretch.hash.view(np.int64).tolist()):
                row, begin, end = rows[i], int(stretch.begin[i]), int(stretch.end[i])
                at = word - begin + firsts[i]
                if wanted[row].get(at >> 6, 0) >> (at & 63) & 1:
                    out.append((x, doc[row], own[row], at, stretch.between(max(begin, word - BEFORE), word), stretch.between(word, min(end, word + WINDOW))))
            if out:
                types = [pa.int64()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["x", "doc", "own", "at", "before", "after"])


def contexts(rows: DataFrame) -> DataFrame:
    """The suffixes at anchors whose first words stand in several documents."""
    chosen = joined_by_size(rows.withColumn("row", _row()), _spots(rows).withColumnRenamed("row", "s_row"), [("row", "s_row")], "spots")
    found = chosen.where("spots is not null").select("doc", "own", "text", "spots").mapInArrow(
        _contexts, "x bigint, doc bigint, own bigint, at bigint, before binary, after binary"
    )
    # Neighbouring contexts share most of their words, which zstandard finds.
    path = scratch_path(rows.sparkSession, "contexts")
    found.withColumns({"before": F.col("before").cast("string"), "after": F.col("after").cast("string")}).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


# --- trees ---------------------------------------------------------------------------


def shared_words(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def smallest_by_window(group: list[tuple[list[bytes], list[bytes], int]], low: int, high: int) -> list[list[int | None]]:
    """For each (words after, words before, document) of a group the smallest document of each of its windows.

    Windows have ``low`` to ``high`` words before the anchor; those that leave the text are None. ``group`` is sorted by the words
    after the anchor, so the leaves below a node stand side by side and a node of some depth ends where neighbours share less.
    """
    out: list[list[int | None]] = [[None] * (high - low + 1) for _ in group]
    shared = [0, *[shared_words(a[0], b[0]) for a, b in zip(group, group[1:])]]
    for before in range(low, high + 1):
        depth, at = WINDOW - before, 0
        while at < len(group):
            end = at + 1
            while end < len(group) and shared[end] >= depth:
                end += 1
            least: dict[tuple[bytes, ...], int] = {}
            leaves = []
            for i in range(at, end):
                after, ahead, doc = group[i]
                if len(after) < depth or len(ahead) < before:
                    continue
                window = tuple(ahead[len(ahead) - before :])
                leaves.append((i, window))
                if doc < least.get(window, doc + 1):
                    least[window] = doc
            for i, window in leaves:
                out[i][before - low] = least[window]
            at = end
    return out


def _trees(low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``k1, k2, least`` of suffixes that lose a window in some document, from rows sorted by ``key``; one group is held at a time."""
        key, rows, out = None, [], []

        def finish() -> None:
            group = sorted(((after.split(), before.split(), first, last, k1, k2) for after, before, first, last, k1, k2 in rows), key=lambda r: r[0])
            for r, least in zip(group, smallest_by_window([r[:3] for r in group], low, high)):
                if any(n is not None and n < r[3] for n in least):
                    out.append((r[4], r[5], least))

        def part() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), ()]
            out.clear()
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["k1", "k2", "least"])

        for batch in batches:
            for own, *row in zip(*[batch.column(c).to_pylist() for c in ("key", "after", "before", "first", "last", "k1", "k2")]):
                if own != key:
                    finish()
                    key, rows = own, []
                    if len(out) > 20_000:
                        yield part()
                rows.append(row)
        finish()
        yield part()

    return run


def _named(low: int, high: int) -> list[Column]:
    return [F.xxhash64(F.lit(low), F.lit(high), "before", "after").alias("k1"), F.xxhash64("after", F.lit(high), "before", F.lit(low)).alias("k2")]


def least_documents(suffixes: DataFrame, low: int = 0, high: int = BEFORE, limit: int = LIMIT) -> DataFrame:
    """``k1, k2, least`` for ``suffixes`` (key, before, after, first, last; each once): the smallest document of each window.

    Suffixes that no document loses a window by are left out. ``key`` names the group; ``first`` and ``last`` are the smallest and the largest
    document with the suffix.
    """
    suffixes = settle(suffixes.select("key", "first", "last", F.col("before"), F.col("after"), *_named(low, high)))
    columns = [F.col(c).cast("binary").alias(c) if c in ("after", "before") else F.col(c) for c in ("key", "after", "before", "first", "last", "k1", "k2")]
    large = settle(suffixes.groupBy("key").count().where(F.col("count") > limit).select(F.col("key").alias("large")))
    schema = "k1 bigint, k2 bigint, least array<bigint>"
    # Groups of one kind of window have one member, so nothing is left to split there.
    if low == high or large.isEmpty():
        sorted_ = suffixes.select(*columns).repartition("key").sortWithinPartitions("key")
        return settle(sorted_.mapInArrow(_trees(low, high), schema))
    marked = keyed_left_join(suffixes, large, [("key", "large")])
    small = marked.where("large is null").select(*columns).repartition("key").sortWithinPartitions("key")
    found = small.mapInArrow(_trees(low, high), schema)
    wide = settle(marked.where("large is not null").drop("large"))
    middle = (low + high) // 2
    halves = []
    for a, b in ((low, middle), (middle + 1, high)):
        # What all windows of the half share names the group, what they hold is kept.
        cut = wide.select(
            "k1", "k2", "first", "last",
            F.substring_index("before", " ", -b).alias("before"), F.substring_index("after", " ", WINDOW - a).alias("after"),
        )
        key = F.xxhash64(F.lit(a), F.substring_index("before", " ", -a), F.substring_index("after", " ", WINDOW - b))
        kept = cut.groupBy(key.alias("key"), "before", "after").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        least = least_documents(kept, a, b, limit).select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("least").alias("half"))
        own = cut.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), *_named(a, b))
        nothing = F.array_repeat(F.lit(None).cast("bigint"), b - a + 1)
        halves.append(keyed_left_join(own, least, [("k1", "c1"), ("k2", "c2")]).select("o1", "o2", F.coalesce("half", nothing).alias("half")))
    left, right = halves[0], halves[1].select(F.col("o1").alias("p1"), F.col("o2").alias("p2"), F.col("half").alias("rest"))
    both = keyed_left_join(left, right, [("o1", "p1"), ("o2", "p2")])
    return settle(found.unionAll(both.select(F.col("o1").alias("k1"), F.col("o2").alias("k2"), F.concat("half", "rest").alias("least"))))


# --- removal -------------------------------------------------------------------------


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, own, spans`` (first word and end of each removed run) from rows sorted by row and place."""
    key, starts, out = None, set(), []

    def finish() -> None:
        if starts:
            spans: list[int] = []
            for s in sorted(starts):
                if spans and s <= spans[-1]:
                    spans[-1] = s + WINDOW
                else:
                    spans += [s, s + WINDOW]
            out.append((*key, spans))
        starts.clear()

    def part() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        out.clear()
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc", "own", "spans"])

    for batch in batches:
        for doc, own, at, least in zip(*[batch.column(c).to_pylist() for c in ("doc", "own", "at", "least")]):
            if (doc, own) != key:
                finish()
                key = (doc, own)
                if len(out) > 20_000:
                    yield part()
            starts.update(at - a for a, n in enumerate(least) if n is not None and n < doc)
    finish()
    yield part()


def removed_spans(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc, own, spans`` of the rows that lose words; ``rows`` are from ``numbered``."""
    found = contexts(rows)
    suffixes = found.groupBy(F.col("x").alias("key"), "before", "after").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    least = least_documents(suffixes, limit=limit).select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), "least")
    hits = keyed_left_join(found.select("doc", "own", "at", *_named(0, BEFORE)), least, [("k1", "l1"), ("k2", "l2")])
    hits = hits.where("least is not null").select("doc", "own", "at", "least")
    sorted_ = hits.repartition("doc", "own").sortWithinPartitions("doc", "own")
    return settle(sorted_.mapInArrow(_spans, "doc bigint, own bigint, spans array<int>"))


def _reported(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                digest, n, gone, any_, kept = hashlib.sha256(), 0, 0, False, []
                spans = spans or []
                for words in parts(text):
                    left, last = [], 0
                    for s, e in zip(spans[::2], spans[1::2]):
                        s, e = min(max(s - n, 0), len(words)), min(max(e - n, 0), len(words))
                        left += words[last:s]
                        gone += e - s
                        last = max(last, e)
                    left += words[last:]
                    if left:
                        joined = (b" " if any_ else b"") + b" ".join(left)
                        digest.update(joined)
                        any_ = True
                        if with_text:
                            kept.append(joined)
                    n += len(words)
                out.append((n, gone, digest.hexdigest(), b"".join(kept) if with_text and gone else None))
            columns = [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.binary()))]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def substring_report(docs: DataFrame, limit: int = LIMIT, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs``.

    A word goes if a window of ``WINDOW`` words around it also stands in a document with a smaller ``doc_id``. Null texts have no
    words; a null id is smaller than all others, and rows with one id are one document, so none loses words to another. Texts with fewer words than
    a window stay whole. ``kept`` is what is left of a text that loses words, joined by blanks, if ``with_text``; else it is null. Other
    columns are ignored; an empty table gives no rows.
    """
    rows = numbered(docs)
    gone = removed_spans(rows, limit).select(F.col("doc").alias("g_doc"), F.col("own").alias("g_own"), "spans")
    joined = joined_by_size(rows, gone, [("doc", "g_doc"), ("own", "g_own")], "spans")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _reported(with_text), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary"
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(read(spark, sf_dir, "documents")).drop("kept")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
starts AS (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
windows AS (SELECT rid, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS words FROM starts),
least AS (SELECT words, min(doc_id) AS least FROM windows GROUP BY words),
gone AS (SELECT DISTINCT rid, i + j AS pos FROM windows JOIN least USING (words), range(13) r(j) WHERE least < doc_id),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
kept AS (SELECT w.rid, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY w.pos) FILTER (gone.pos IS NULL) AS kept
    FROM words w LEFT JOIN gone ON w.rid = gone.rid AND w.pos = gone.pos GROUP BY w.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
