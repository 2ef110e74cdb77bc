"""Grouping of spelling variants by sorted-list dynamic programming.

Two words one edit apart agree in all but a piece of the shorter one. Each word enters the blocks of all words that agree
with it outside such a piece: first the ranges of the vocabulary that share a first half or a second half. A block
of more than ``LIMIT`` words is cut into those of half the piece, down to pieces of one letter, so no block grows with the vocabulary.

In a block the words are sorted. Each shorter word is compared with the sorted list: the rows of the edit matrix, banded to one
cell beside the diagonal, are kept for every letter of the last word, the next word takes them over as far as the two agree, and
once all cells of a row exceed one edit the scan goes on behind all words that share the letters up to there.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.llm.common import read, slices
from trilayer.operators import keyed_left_join, settle

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, once A-Z is lower-cased.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
#: Words of a block from which it is cut further.
LIMIT = 48
#: Different runs a task counts before it hands the counts on.
HELD = 300_000


# --- vocabulary -----------------------------------------------------------------


def spelled(doc_id: int | None, run: bytes, part: int = 97) -> bytes:
    """``run`` as it is, or without one letter if ``part`` divides the CRC-32 of ``<doc_id>:<run>``; a null id is an empty text."""
    h = zlib.crc32(run, zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode())))
    if h % part:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def part() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            for run, n in Counter(RUN.findall((text or b"").lower())).items():
                counts[run if zlib.crc32(run, start) % 97 else spelled(doc_id, run)] += n
            if len(counts) > HELD:
                yield part()
    if counts:
        yield part()


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of all words of so many letters and occurrences. Null and empty texts have none; other columns are ignored."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(_counted, "word string, n bigint").where(F.length("word") >= least_length)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- blocks ---------------------------------------------------------------------


def _pieces(m: Column, start: Column, end: Column) -> Column:
    """The two halves of a piece, as an array of structs."""
    middle = F.floor((start + end) / 2).cast("int")
    return F.array(F.struct(m.alias("m"), start.alias("start"), middle.alias("end")), F.struct(m.alias("m"), middle.alias("start"), end.alias("end")))


def _block_of(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, m, start, end) with ``block``, the letters outside the piece, and ``mid``, those inside.

    ``m`` is the length of the shorter word of a pair; a word of ``m + 1`` letters has one more in the piece.
    """
    size = F.length("word")
    end = F.col("end") + size - F.col("m")
    before, after = F.col("word").substr(F.lit(1), F.col("start")), F.col("word").substr(end + 1, size)
    key = F.concat_ws("|", F.col("m").cast("string"), F.col("start").cast("string"), F.col("end").cast("string"), before, after)
    return rows.withColumns({"block": key, "mid": F.col("word").substr(F.col("start") + 1, end - F.col("start"))})


def blocks(words: DataFrame, least_length: int = 5, limit: int = LIMIT) -> DataFrame:
    """``block, mid, word, n, m, start, end``: every word in all its blocks, none above ``limit`` words unless its piece is one letter."""
    size = F.length("word")
    shorter = F.filter(F.array(size, size - 1), lambda m: m >= least_length)
    open_ = words.select("word", "n", F.explode(F.flatten(F.transform(shorter, lambda m: _pieces(m, F.lit(0), m)))).alias("piece")).select("word", "n", "piece.*")
    done = []
    while True:
        placed = settle(_block_of(open_))
        # Both halves of a block of one letter are the block, so it stays.
        large = placed.groupBy("block").count().where(F.col("count") > limit).select(F.col("block").alias("large"))
        marked = settle(keyed_left_join(placed, large, [("block", "large")]).withColumn("cut", F.col("large").isNotNull() & (F.col("end") - F.col("start") > 1)).drop("large"))
        done.append(marked.where("not cut").drop("cut"))
        if marked.where("cut").isEmpty():
            break
        piece = F.explode(_pieces(F.col("m"), F.col("start"), F.col("end")))
        open_ = marked.where("cut").select("word", "n", piece.alias("piece")).select("word", "n", "piece.*")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


# --- comparison -----------------------------------------------------------------

_FAR = 2


def shared_letters(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def behind(shared: Sequence[int]) -> list[int]:
    """For each place in a sorted list the next one that shares fewer letters with the word before it."""
    out, stack = [len(shared)] * len(shared), []
    for i, n in enumerate(shared):
        while stack and shared[stack[-1]] > n:
            out[stack.pop()] = i
        stack.append(i)
    return out


def within_one_edit(query: str, words: Sequence[str], shared: Sequence[int], skip: Sequence[int]) -> Iterator[int]:
    """Places in the sorted ``words`` at most one edit from ``query``.

    ``shared[i]`` counts the letters that words i - 1 and i share, ``skip`` is from ``behind``. A row for
    d letters holds the cells for d - 1, d and d + 1 letters of the query, capped at ``_FAR``.
    """
    size = len(query)
    rows = [(_FAR, 0, 1)]
    i = 0
    while i < len(words):
        word = words[i]
        # Rows of letters that the last word had too stand already.
        del rows[min(shared[i], len(rows) - 1) + 1 :]
        d = len(rows) - 1
        low, at, high = rows[-1]
        length = len(word)
        while d < length:
            letter = word[d]
            d += 1
            # Cells for d - 1, d and d + 1 letters of the query; those outside it are far.
            a = min(low + (not (1 < d <= size + 1 and query[d - 2] == letter)), at + 1) if 1 <= d <= size + 1 else _FAR
            b = min(at + (not (d <= size and query[d - 1] == letter)), high + 1, a + 1) if d <= size else _FAR
            c = min(high + (not (d < size and query[d] == letter)), b + 1) if d < size else _FAR
            low, at, high = a if a < _FAR else _FAR, b if b < _FAR else _FAR, c if c < _FAR else _FAR
            if low == at == high == _FAR:
                break
            rows.append((low, at, high))
        if low == at == high == _FAR:
            i += 1
            while i < len(words) and shared[i] >= d:
                i = skip[i]
            continue
        if -1 <= size - length <= 1 and (low, at, high)[size - length + 1] < _FAR:
            yield i
        i += 1


def near_in_block(start: int, end: int, m: int, mids: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places in ``mids``, sorted and different, whose words are one edit apart, each pair in one block only.

    An edit can be placed anywhere in a stretch of one letter; the last place counts, and only the block that holds it gives the pair.
    """
    shared = [0, *[shared_letters(a, b) for a, b in zip(mids, mids[1:])]]
    skip = behind(shared)
    width = end - start
    for q, query in enumerate(mids):
        if len(query) != width:
            continue
        for i in within_one_edit(query, mids, shared, skip):
            if len(mids[i]) == width:
                if i > q:
                    yield q, i
            elif end == m or shared_letters(query, mids[i]) < width:
                yield q, i


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words from rows sorted by block and mid; one block is held at a time."""
    out: list[tuple[str, str, int]] = []
    key, place, rows = None, (0, 0, 0), []

    def finish() -> None:
        if len(rows) > 1:
            for a, b in near_in_block(*place, [r[0] for r in rows]):
                out.append((rows[a][1], rows[b][1], rows[b][2]))
                out.append((rows[b][1], rows[a][1], rows[a][2]))

    def part() -> pa.RecordBatch:
        columns = list(zip(*out)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["word", "near", "near_n"])

    for batch in batches:
        for block, mid, word, n, m, start, end in zip(*[batch.column(c).to_pylist() for c in ("block", "mid", "word", "n", "m", "start", "end")]):
            if block != key:
                finish()
                key, place, rows = block, (start, end, m), []
                if len(out) > 50_000:
                    yield part()
            rows.append((mid, word, n))
    finish()
    yield part()


def near_words(words: DataFrame, least_length: int = 5, limit: int = LIMIT) -> DataFrame:
    """``word, near, near_n`` for every word of ``words`` (word, n; each once) and each other one exactly one edit away."""
    placed = blocks(words, least_length, limit)
    # Words of one block and mid are equal, so a block has no ties.
    sorted_ = placed.repartition("block").sortWithinPartitions("block", "mid")
    return sorted_.select("block", "mid", "word", "n", "m", "start", "end").mapInArrow(_compared, "word string, near string, near_n bigint")


def forms(words: DataFrame, near: DataFrame, factor: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n``: the near word of largest n, the smallest of several, if it has ``factor`` times the word's n."""
    best = near.groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = keyed_left_join(words, best, [("word", "of")])
    chosen = -F.col("best.less") >= factor * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: where their forms lead in the end.

    Each round joins every word with what its own target leads to, so the rounds grow with the logarithm of the longest chain;
    counts at least double along a chain, so that is 63 words at most.
    """
    links = settle(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("from"), F.col("root").alias("next"))
        moved = settle(keyed_left_join(links, ahead, [("root", "from")]).select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        links = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return links


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, factor: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary of ``docs``.

    Words without a near word, or with none frequent enough, are their own root. An empty table, or texts without words of
    the length and count, give no rows.
    """
    words = settle(vocabulary(docs, least_length, least_count))
    formed = settle(forms(words, near_words(words, least_length), factor))
    ends = roots(formed).select(F.col("word").alias("of"), "root")
    joined = keyed_left_join(formed, ends, [("word", "of")])
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


# --- the same in SQL -------------------------------------------------------------

# Words one edit apart agree when one letter is taken from each at the same place, or one letter from the longer.
SQL = r"""
WITH RECURSIVE crc(x, i, k) AS (SELECT i, i, 0 FROM range(256) r(i)
    UNION ALL SELECT (CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)::BIGINT, i, k + 1 FROM crc WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS t FROM crc WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
-- Letters from U+00C0 on are two bytes: 195 and their number less 64.
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS h FROM counted, tab),
spelt AS (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i) p),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
led(word, root) AS (SELECT word, word FROM formed WHERE form IS NULL UNION ALL SELECT f.word, led.root FROM formed f JOIN led ON f.form = led.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN led USING (word)
"""
