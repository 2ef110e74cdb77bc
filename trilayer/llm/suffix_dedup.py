"""Removal of long byte strings that stand anywhere else, by merging sorted suffixes.

Sorting every suffix of a corpus would move each byte many times, so only suffixes at anchors are sorted. An anchor is
the smallest hash of ``GRAM`` bytes in some window of ``WINDOW`` bytes; equal windows have their anchor at the same place,
so no repeat is missed. Anchors whose bytes occur once are dropped first.

At the others, tasks sort the suffixes (``WINDOW`` bytes, with what may stand before them in a window), front-code them into
runs and exchange the runs. A loser tree merges the runs of a bucket; it keeps how much of each
candidate agrees with the last output and never compares that part again. Suffixes that agree in ``GRAM`` bytes come out side by side, and each
window around them is looked up among the windows of its neighbours.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilayer.llm.common import joined_by_size, mixed, read, rolling, slices, span_hashes
from trilayer.llm.ngram_join import _repeated_tokens
from trilayer.operators import keyed_left_join, settle

GRAM = 64
_ENTRY = struct.Struct("<BBBI16s")


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of ``values[i : i + width]`` for each i that has so many."""
    n, step = len(values), np.minimum if least else np.maximum
    filler = np.iinfo(values.dtype).max if least else 0
    rows = np.full(-(-n // width) * width, filler, values.dtype)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    ahead = step.accumulate(rows, axis=1).ravel()
    behind = step.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return step(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, position and hash of every anchor. Texts shorter than a window have none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < window:
        return none, none, none.view(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sums, down = rolling(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(sums, down, places, places + GRAM)
    short = (grams >> np.uint64(32)).astype(np.uint32)
    width = window - GRAM + 1
    smallest = sliding(short, width, True).astype(np.uint64) + np.uint64(1)
    # Windows that would leave their text count for nothing.
    left = np.repeat(starts + sizes, sizes)[: len(smallest)] - np.arange(len(smallest))
    smallest[left < window] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), smallest, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(sliding(padded, width, False)[: len(short)] == short.astype(np.uint64) + np.uint64(1))
    text = np.searchsorted(starts, at, side="right") - 1
    return text, at - starts[text], grams[at]


def common_length(a: bytes, b: bytes, start: int) -> int:
    """Length of the common beginning of two strings known to agree up to ``start``."""
    low, high = start, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def pack_run(entries: list[tuple[bytes, bytes, bytes, int]]) -> bytes:
    """Sorted (suffix, bytes before it, hash, count), each suffix without what it shares with the one before."""
    out, last = [], b""
    for suffix, before, key, n in entries:
        shared = common_length(last, suffix, 0)
        out += [_ENTRY.pack(shared, len(suffix) - shared, len(before), n, key), suffix[shared:], before]
        last = suffix
    return b"".join(out)


def unpack_run(run: bytes) -> Iterator[tuple[int, bytes, bytes, bytes, int]]:
    """(agreement with the suffix before, suffix, bytes before it, hash, count) in order."""
    at, last = 0, b""
    while at < len(run):
        shared, rest, before, n, key = _ENTRY.unpack_from(run, at)
        at += _ENTRY.size
        last = last[:shared] + run[at : at + rest]
        at += rest
        yield shared, last, run[at : at + before], key, n
        at += before


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes, bytes, int]]:
    """One sorted run of all, by a loser tree over the heads.

    ``agrees[r]`` is what the head of run r shares with the last output (or, for the losers on
    the winner's path, with the string that beat them). The head that shares more is the smaller; only
    heads that share equally are compared, from there on.
    """
    sources = [unpack_run(r) for r in runs]
    heads = [next(s, None) for s in sources]
    size = 1
    while size < len(runs):
        size *= 2
    heads += [None] * (size - len(heads))
    agrees, losers = [0] * size, [0] * size

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None
        if agrees[a] != agrees[b]:
            return agrees[a] > agrees[b]
        x, y = heads[a][1], heads[b][1]
        n = common_length(x, y, agrees[a])
        first = x[n:] <= y[n:] if n in (len(x), len(y)) else x[n] < y[n]
        agrees[b if first else a] = n
        return first

    def build(node: int) -> int:
        if node >= size:
            return node - size
        a, b = build(2 * node), build(2 * node + 1)
        winner, losers[node] = (a, b) if beats(a, b) else (b, a)
        return winner

    winner = build(1)
    while heads[winner] is not None:
        yield (agrees[winner], *heads[winner][1:])
        heads[winner] = next(sources[winner], None)
        if heads[winner] is not None:
            agrees[winner] = heads[winner][0]
        node = (winner + size) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def _window_keys(contexts: list[tuple[bytes, bytes, bytes, int]], groups: list[int], window: int, low: int, high: int) -> tuple[np.ndarray, ...]:
    """Context, bytes before the suffix and key of the windows that begin ``low`` to ``high - 1`` bytes before their suffix."""
    data = np.frombuffer(b"".join(chain.from_iterable((before, suffix) for suffix, before, _, _ in contexts)), np.uint8)
    before = np.array([len(c[1]) for c in contexts])
    suffix = np.array([len(c[0]) for c in contexts])
    at = np.concatenate([[0], np.cumsum(before + suffix)[:-1]]) + before
    sums, down = rolling(data)
    ahead = np.arange(low, high)
    rows, d = np.nonzero((ahead <= before[:, None]) & (window - ahead <= suffix[:, None]))
    d = d + low
    starts = at[rows] - d
    own = np.array(groups, np.uint64)[rows] * np.uint64(window) + d.astype(np.uint64)
    return rows, d, mixed(span_hashes(sums, down, starts, starts + window) + mixed(own))


def repeated_windows(
    contexts: list[tuple[bytes, bytes, bytes, int]], groups: list[int], window: int, most: int = 500_000, block: int = 2_000
) -> Iterator[tuple[bytes, int, int]]:
    """``(hash, lo, hi)``: the windows that begin lo to hi bytes before the suffix stand in another place too.

    Only windows of one group that begin equally far before their suffix are compared. One window can be near several
    anchors, or hold the bytes of an anchor twice; so it never meets itself. About ``most`` windows are held at a time: those of
    some distances before the suffix, found from ``block`` contexts after the other.
    """
    times = np.array([c[3] for c in contexts])
    hits = []
    step = max(1, most // len(contexts))
    for low in range(0, window - GRAM + 1, step):
        high = min(low + step, window - GRAM + 1)
        found = []
        for i in range(0, len(contexts), block):
            rows, d, keys = _window_keys(contexts[i : i + block], groups[i : i + block], window, low, high)
            found.append((rows + i, d, keys))
        rows, d, keys = (np.concatenate(c) for c in zip(*found))
        _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        hit = (n[which] > 1) | (times[rows] > 1)
        hits.append((rows[hit].astype(np.int32), d[hit].astype(np.int16)))
    rows, d = (np.concatenate(c) for c in zip(*hits))
    if len(rows):
        order = np.lexsort((d, rows))
        rows, d = rows[order], d[order]
        cut = np.flatnonzero((np.diff(rows) != 0) | (np.diff(d) != 1)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(rows)]]) - 1):
            yield contexts[rows[a]][2], int(d[a]), int(d[b])


def _bucket_repeats(runs: list[bytes], window: int, chunk: int = 2_000) -> Iterator[tuple[bytes, int, int]]:
    """Repeated windows from all runs of a bucket, the groups of about ``chunk`` contexts at a time."""
    done: list[tuple[bytes, bytes, bytes, int]] = []
    of: list[int] = []
    group: list[tuple[bytes, bytes, bytes, int]] = []

    def close() -> None:
        # Equal suffixes with equal bytes before them are one context that stands in several places.
        merged: dict[bytes, list] = {}
        for suffix, before, key, n in group:
            merged.setdefault(key, [suffix, before, key, 0])[3] += n
        if len(merged) > 1 or any(c[3] > 1 for c in merged.values()):
            of.extend([of[-1] + 1 if of else 0] * len(merged))
            done.extend(map(tuple, merged.values()))
        group.clear()

    for agrees, suffix, before, key, n in merge_runs(runs):
        if agrees < GRAM and group:
            close()
            if len(done) >= chunk:
                yield from repeated_windows(done, of, window)
                done.clear()
                of.clear()
        group.append((suffix, before, key, n))
    close()
    if done:
        yield from repeated_windows(done, of, window)


_PLACED = "own struct<id:bigint,h:bigint>"


def _keyed(docs: DataFrame) -> DataFrame:
    """Text as bytes with a key of id and content: rows that agree in both share their fate."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    own = F.struct(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text).alias("h"))
    return docs.select(own.alias("own"), text.alias("text"))


def repeated_anchors(keyed: DataFrame, window: int) -> DataFrame:
    """``gram, own, at`` of every anchor whose hash occurs twice or more."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=2 << 20):
            text, at, grams = anchors(batch.column(1).to_pylist(), window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), batch.column(0).take(pa.array(text)), pa.array(at.astype(np.int32))], ["gram", "own", "at"]
            )

    schema = f"gram bigint, {_PLACED}, at int"
    rows = keyed.mapInArrow(find, schema).repartition("gram").sortWithinPartitions("gram")
    return rows.mapInArrow(_repeated_tokens, schema)


def _contexts(window: int, buckets: int):
    """Occurrences of contexts, and the contexts themselves in front-coded runs, one for each bucket and task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        kept: dict[bytes, list] = {}

        def runs() -> pa.RecordBatch:
            by_bucket: dict[int, list] = {}
            for key, (suffix, before, n) in kept.items():
                by_bucket.setdefault(xxhash.xxh3_64_intdigest(suffix[:GRAM]) % buckets, []).append((suffix, before, key, n))
            kept.clear()
            # Front coding leaves the text itself, which shrinks to a third.
            small = zstandard.ZstdCompressor(level=3)
            packed = [small.compress(pack_run(sorted(entries, key=lambda e: e[:2]))) for entries in by_bucket.values()]
            n = len(packed)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, schema), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(list(by_bucket), pa.int32()), pa.array(packed, pa.binary())],
                ["own", "at", "key", "bucket", "run"],
            )

        size = 0
        for batch in slices(batches):
            schema = batch.column(0).type
            rows, places, keys = [], [], []
            for i, (text, at) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for p in at:
                    before, suffix = text[max(0, p - window + GRAM) : p], text[p : p + window]
                    key = xxhash.xxh3_128_digest(bytes([len(before)]) + before + suffix)
                    entry = kept.get(key)
                    if entry is None:
                        kept[key] = [suffix, before, 1]
                        size += len(before) + len(suffix)
                    else:
                        entry[2] += 1
                    rows.append(i)
                    places.append(p)
                    keys.append(key)
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()), pa.array(keys, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                ["own", "at", "key", "bucket", "run"],
            )
            if size > 32 << 20:
                yield runs()
                size = 0
        if kept:
            yield runs()

    return cut


def _merged_buckets(window: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(bucket_runs: list[bytes]) -> pa.RecordBatch:
            found = list(_bucket_repeats([zstandard.ZstdDecompressor().decompress(r) for r in bucket_runs], window))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), *(pa.array([f[i] for f in found], pa.int32()) for i in (1, 2))], ["key", "lo", "hi"]
            )

        now, held = None, []
        for batch in slices(batches):
            for bucket, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and held:
                    yield rows(held)
                    held = []
                now = bucket
                held.append(run)
        if held:
            yield rows(held)

    return merge


def _window_rows(window: int):
    """The windows around anchors as rows: ``own``, first byte and two hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64, most_bytes=1 << 20):
            for i, (text, at) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                places = np.array(at, np.int64)[:, None] - np.arange(window - GRAM + 1)
                places = np.unique(places[(places >= 0) & (places + window <= len(text))])
                sums, down = rolling(np.frombuffer(text, np.uint8))
                raw = (sums[places + window] - sums[places]) * down[places]
                other = np.array([xxhash.xxh3_64_intdigest(text[p : p + window]) for p in places.tolist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(places), i))), pa.array(places.astype(np.int32)), pa.array(mixed(raw).view(np.int64)), pa.array(other.view(np.int64))],
                    ["own", "at", "w1", "w2"],
                )

    return cut


def removable(docs: DataFrame, window: int = 200, hot: int = 100_000, buckets: int | None = None) -> DataFrame:
    """``own`` and the byte ranges ``spans`` (start, end, start, end ...) that stand elsewhere too.

    Anchors met more than ``hot`` times leave the merge: their windows are counted one by one in an aggregation with
    partial sums, which no single task has to hold.
    """
    keyed = _keyed(docs)
    found = settle(repeated_anchors(keyed, window))
    frequent = found.groupBy("gram").count().where(F.col("count") > hot).select(F.col("gram").alias("f"))
    found = keyed_left_join(found, frequent, [("gram", "f")]).withColumn("hot", F.col("f").isNotNull())
    # Only the anchors of one text meet in one row.
    places = found.groupBy("own").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("at"))).alias("at"), F.collect_set(F.when(F.col("hot"), F.col("at"))).alias("hot_at")
    ).withColumnRenamed("own", "o")
    if buckets is None:
        # So many that the contexts of a bucket, were none equal, take about 16 MB.
        buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), found.count() * (2 * window) >> 24)
    # Texts stay where they are while what is known of them is small.
    places = settle(places.withColumn("size", F.concat("at", "hot_at")))
    joined = joined_by_size(keyed, places, [("own", "o")], "size").where("o is not null").drop("o", "size")
    parts = settle(joined.select("own", "text", "at").mapInArrow(_contexts(window, buckets), f"{_PLACED}, at int, key binary, bucket int, run binary"))
    runs = parts.where("bucket is not null").select("bucket", "run").repartition("bucket").sortWithinPartitions("bucket")
    repeats = settle(runs.mapInArrow(_merged_buckets(window), "key binary, lo int, hi int"))
    repeats = repeats.select(F.col("key").alias("k"), "lo", "hi")
    occurrences = parts.where("key is not null").select("own", "at", "key")
    h, k = F.xxhash64("key"), F.xxhash64("k")
    spans = occurrences.withColumn("_h", h).join(repeats.withColumn("_k", k), (F.col("_h") == F.col("_k")) & (F.col("key") == F.col("k"))).select(
        "own", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + window).alias("end")
    )
    if not frequent.isEmpty():
        hot_rows = joined.where(F.size("hot_at") > 0).select("own", "text", F.col("hot_at").alias("at"))
        rows = settle(hot_rows.mapInArrow(_window_rows(window), f"{_PLACED}, at int, w1 bigint, w2 bigint"))
        again = rows.groupBy("w1", "w2").count().where("count > 1").select(F.col("w1").alias("r1"), F.col("w2").alias("r2"))
        again = keyed_left_join(rows, again, [("w1", "r1"), ("w2", "r2")]).where("r1 is not null")
        spans = spans.unionAll(again.select("own", F.col("at").alias("start"), (F.col("at") + window).alias("end")))
    sorted_ = spans.repartition("own").sortWithinPartitions("own", "start")
    return settle(sorted_.mapInArrow(_joined_spans, "own struct<id:bigint,h:bigint>, spans array<int>"))


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``own`` and its ``spans`` (start, end, start, end ...), which no longer overlap or touch, from rows sorted by both."""
    key, now, out = None, [], []

    def part() -> pa.RecordBatch:
        owns = pa.array([k for k, _ in out], pa.struct([("id", pa.int64()), ("h", pa.int64())]))
        spans = pa.array([s for _, s in out], pa.list_(pa.int32()))
        out.clear()
        return pa.RecordBatch.from_arrays([owns, spans], ["own", "spans"])

    for batch in batches:
        for own, start, end in zip(*[batch.column(c).to_pylist() for c in ("own", "start", "end")]):
            if own != key:
                if now:
                    out.append((key, now))
                    if len(out) > 20_000:
                        yield part()
                key, now = own, []
            if now and start <= now[-1]:
                now[-1] = max(end, now[-1])
            else:
                now += [start, end]
    if now:
        out.append((key, now))
    yield part()


def without_repeats(docs: DataFrame, window: int = 200, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) for every row of ``docs``.

    A byte goes if a string of ``window`` bytes that covers it also starts anywhere else, in this text or
    another; strings are judged on the input. Null and empty texts have no bytes. Rows with null or equal ids
    are all kept as rows. Other columns are ignored. Without repeats, or for an empty table, nothing is removed.
    """
    found = removable(docs, window, **options).withColumnRenamed("own", "o")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = list(zip(spans[::2], spans[1::2])) if spans else []
                kept, at = [], 0
                for start, end in spans:
                    kept.append(text[at:start])
                    at = end
                rows.append((len(text), sum(e - s for s, e in spans), len(spans), b"".join([*kept, text[at:]])))
            n_bytes, removed, n_spans, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (n_bytes, removed, n_spans)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    joined = joined_by_size(_keyed(docs), found, [("own", "o")], "spans").select("own.id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
