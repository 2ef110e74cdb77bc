"""Personal data by bootstrapped contextual extraction.

Four base patterns find emails, IP addresses, card and phone numbers. Every base match is a seed: the words
around it form lexical patterns, whatever the form of the value. Spark holds the graph of patterns and the values
met in them, scores patterns by the values already known and values by their patterns, and patterns that end with
high confidence mark further identifiers in all texts.

Texts are read again for each step, so that only words in a pattern under test leave a scan. Scans let through
by a table of slots of fixed size; joins in Spark then compare whole hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.llm.common import mixed, read, rolling, slices, span_hashes
from trilayer.operators import keyed_left_join, settle

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit before the start would have begun the match earlier, so the look-behind changes nothing
# but keeps long runs of digits linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

#: What separates words here: spaces, the end of a text and marks that values do not hold.
_GAP = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r\0:=;,|<>\"'()[]{}!?*#$%&", np.uint8))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: A value that no base pattern knows has up to this many words.
LONGEST = 5
#: Tables of slots have 2 to this power, so that a scan takes the same memory with any number of patterns.
SLOT_BITS = 23
#: Kind of a row that says that its pattern holds too many values.
_DEAD = 99
_EDGE, _LEFT, _BOTH = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: from each @ outwards, which is linear in any text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, (end := m.end())
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every base match, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    if _DIGITS.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(found)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


class Words:
    """The words of many texts as arrays; a text of its own ends at a zero byte."""

    def __init__(self, texts: list[str]):
        parts = [t.encode() for t in texts]
        data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
        gap = _GAP[data]
        for _ in range(3):  # dots that close a word
            gap[:-1] |= (data[:-1] == ord(".")) & gap[1:]
        edge = np.diff(np.concatenate([[1], gap]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.n = len(self.starts)
        self.begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        self.doc = np.searchsorted(self.begins, self.starts, "right") - 1
        # Number of characters up to and with each byte.
        self.chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        count = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        breaks, digits = count(data == ord("\n")), count((data >= 48) & (data <= 57))
        self.line = breaks[self.starts] + self.doc
        self.digits = digits[self.ends] > digits[self.starts]
        self.sums, self.down = rolling(_LOWER[data])
        hashes = span_hashes(self.sums, self.down, self.starts, self.ends)
        same = self.doc[1:] == self.doc[:-1]
        self.before, self.after = np.full(self.n, _EDGE), np.full(self.n, _EDGE)
        self.before[1:][same], self.after[:-1][same] = hashes[:-1][same], hashes[1:][same]
        self.base = np.zeros(self.n, bool)

    def seeds(self, spans: list[list[tuple[int, int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last word and kind of each base span; marks their words."""
        found = [(d, s, e, k) for d, base in enumerate(spans) for s, k, e in base]
        d, s, e, kind = np.array(found, np.int64).reshape(-1, 4).T
        at = self.chars[self.begins[d]]
        first = np.searchsorted(self.ends, np.searchsorted(self.chars, at + s + 1) - 1, "right")
        last = np.searchsorted(self.starts, np.searchsorted(self.chars, at + e), "left") - 1
        ok = last >= first
        first, last, kind = first[ok], last[ok], kind[ok]
        marks = np.bincount(first, minlength=self.n + 1) - np.bincount(last + 1, minlength=self.n + 1)
        self.base = np.cumsum(marks)[: self.n] > 0
        return first, last, kind

    def left(self, first: np.ndarray) -> np.ndarray:
        return mixed(self.before[first] ^ _LEFT)

    def both(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed(mixed(self.before[first] + _BOTH) ^ self.after[last])

    def values(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return span_hashes(self.sums, self.down, self.starts[first], self.ends[last])

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First and last words of all runs in one line without a word of a base span, by length."""
        first = np.flatnonzero(~self.base)
        for n in range(LONGEST):
            first = first[first + n < self.n]
            last = first + n
            keep = (self.line[first] == self.line[last]) & ~self.base[last]
            first, last = first[keep], last[keep]
            yield first, last

    def in_patterns(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, last word and pattern of the runs that stand in a pattern of ``table``.

        Between two words a value is all that stands there. After one word it is the words with digits that follow, or one word.
        """
        out, more, end = [], None, None
        for n, (first, last) in enumerate(self.runs()):
            pattern = self.both(first, last)
            hit = _in(pattern, table)
            out.append((first[hit], last[hit], pattern[hit]))
            if n == 0:
                end, more = np.arange(self.n), self.digits.copy()
            else:
                grows = np.zeros(self.n, bool)
                grows[first] = more[first] & self.digits[last]
                end, more = np.where(grows, end + 1, end), grows
        first = np.flatnonzero(~self.base)
        pattern = self.left(first)
        hit = _in(pattern, table)
        out.append((first[hit], end[first[hit]], pattern[hit]))
        return tuple(np.concatenate(c) for c in zip(*out))

    def with_values(self, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First and last words of the runs whose value is in ``table``."""
        for first, last in self.runs():
            hit = _in(self.values(first, last), table)
            yield first[hit], last[hit]

    def places(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of runs, in characters of their text."""
        zero = self.chars[self.begins[self.doc[first]]]
        return self.chars[self.starts[first]] - zero, self.chars[self.ends[last]] - zero


def _in(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[hashes >> np.uint64(64 - SLOT_BITS)]


def _table(slots: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << SLOT_BITS, bool)
    table[slots] = True
    return table


def _caps(ready: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the patterns in order and the largest ``cap`` of each; never more than there are slots."""
    slot = F.shiftrightunsigned("pattern", 64 - SLOT_BITS).cast("int")
    rows = ready.groupBy(slot.alias("s")).agg(F.max("cap").alias("cap")).toArrow()
    slots, caps = rows.column("s").to_numpy().astype(np.int32), rows.column("cap").to_numpy()
    order = np.argsort(slots)
    return slots[order], caps[order]


def _cap(belief: Column, confidence: float) -> Column:
    """How many distinct values a pattern with so much belief may hold and still be trusted; never too few for rounding."""
    return F.floor(belief / confidence + 1e-6).cast("bigint") - 1


class Emitted:
    """What one task has sent of each pattern. A pattern that held more than its cap is dead and sends nothing more."""

    def __init__(self, slots: np.ndarray, caps: np.ndarray):
        self.slots, self.caps = slots, caps
        self.values: dict[int, set[int]] = {}
        self.dead: set[int] = set()

    def new(self, found: np.ndarray) -> np.ndarray:
        """Rows (pattern, value, 0) to send, and (pattern, 0, ``_DEAD``) of the patterns that die."""
        order = np.argsort(found[:, 0], kind="stable")
        patterns, first = np.unique(found[order, 0], return_index=True)
        out = []
        for p, rows in zip(patterns.tolist(), np.split(order, first[1:])):
            if p in self.dead:
                continue
            sent = self.values.setdefault(p, set())
            fresh = [v for v in found[rows, 1].tolist() if v not in sent]
            sent.update(fresh)
            if len(sent) > self.caps[np.searchsorted(self.slots, p >> (64 - SLOT_BITS))]:
                self.dead.add(p)
                del self.values[p]
                out.append((p, 0, _DEAD + 1))
            else:
                out += [(p, v, 0) for v in fresh]
        return np.array(out, np.uint64).reshape(-1, 3) if out else np.zeros((0, 3), np.uint64)


def _slots(hashes: DataFrame, column: str) -> np.ndarray:
    """The slots that the hashes fall into; never more than there are slots."""
    rows = hashes.select(F.shiftrightunsigned(column, 64 - SLOT_BITS).cast("int").alias("s")).distinct()
    return rows.toArrow().column(0).to_numpy().astype(np.int32)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.astype(np.uint64).view(np.int64))


def _edges(docs: DataFrame, patterns: tuple[np.ndarray, np.ndarray] | None = None, values: np.ndarray | None = None) -> DataFrame:
    """``pattern, value, kind`` of the base matches, or with kind -1 of all other values in the patterns that the slots let through.

    ``patterns`` are slots with caps: a pattern in which a task meets more values than its cap leaves a row of kind ``_DEAD`` and no
    more values. With slots of values instead, all patterns of those values. Patterns and values are hashes. Most repetitions are dropped.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = values if values is not None else patterns and patterns[0]
        table = None if slots is None else _table(slots)
        emitted = Emitted(*patterns) if patterns else None
        held, rows = [], 0

        def part() -> pa.RecordBatch:
            found = np.concatenate([np.zeros((0, 3), np.uint64), *held])
            # Sorting one number a row is several times faster than sorting rows.
            found = found[np.unique(mixed(found[:, 0] + mixed(found[:, 1] + mixed(found[:, 2]))), return_index=True)[1]]
            found = emitted.new(found) if emitted else found
            return pa.RecordBatch.from_arrays([_signed(found[:, 0].copy()), _signed(found[:, 1].copy()), pa.array(found[:, 2].astype(np.int64).astype(np.int32) - 1)], ["pattern", "value", "kind"])

        for batch in slices(batches, most_bytes=1 << 20):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            words = Words(texts)
            first, last, kind = words.seeds([base_spans(t) for t in texts])
            if values is not None:
                first, last = (np.concatenate(c) for c in zip(*words.with_values(table)))
                kind = np.full(len(first), -1)
            if patterns is None:
                found = [(p, words.values(first, last), kind + 1) for p in (words.left(first), words.both(first, last))]
            else:
                first, last, pattern = words.in_patterns(table)
                found = [(pattern, words.values(first, last), np.zeros(len(first)))]
            for columns in found:
                held.append(np.column_stack([c.astype(np.uint64) for c in columns]))
                rows += len(held[-1])
            if rows > 200_000:
                yield part()
                held, rows = [], 0
        yield part()

    return docs.select("text").mapInArrow(find, "pattern bigint, value bigint, kind int")


SCAN = "doc_id bigint, row bigint, base string, counts array<bigint>, found array<struct<at:bigint,upto:bigint,pattern:bigint>>"


def scan(docs: DataFrame, patterns: np.ndarray) -> DataFrame:
    """Base spans of each whole text and what stands in the patterns. ``row`` tells rows with one id apart."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("at", pa.int64()), ("upto", pa.int64()), ("pattern", pa.int64())])
        table = _table(patterns)
        for batch in slices(batches, most_bytes=1 << 20):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            base, found = [base_spans(t) for t in texts], [[] for _ in texts]
            if len(patterns):
                words = Words(texts)
                words.seeds(base)
                first, last, pattern = words.in_patterns(table)
                columns = (words.doc[first], *words.places(first, last), pattern.view(np.int64))
                for d, at, upto, p in zip(*(c.tolist() for c in columns)):
                    found[d].append({"at": at, "upto": upto, "pattern": p})
            spans = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b) for b in base]
            counts = [[sum(k == n for _, k, _ in b) for n in range(len(KINDS))] for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.string()), pa.array(counts, pa.list_(pa.int64())), pa.array(found, pa.list_(item))],
                ["doc_id", "row", "base", "counts", "found"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(find, SCAN)


def _semi(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Rows of ``left`` whose ``column`` is in ``right``."""
    keys = right.select(F.col(column).alias("_k")).distinct()
    return keyed_left_join(left, keys, [(column, "_k")]).where("_k is not null").drop("_k")


def trusted_patterns(docs: DataFrame, confidence: float = 0.8, support: int = 3) -> DataFrame:
    """``pattern, kind, score`` of the patterns in which values of one kind are met reliably.

    A pattern is the word before a value, or the words before and after it. Its belief in a kind is the mean belief of its
    distinct values, damped for few values (``n / (n + 1)``); base matches have belief 1. At least ``support`` distinct known values
    must stand behind a trusted pattern; known are base matches and, from the next round on, the values that trusted patterns
    hold, with the score of their best pattern as belief. Rounds go on until no new pattern is trusted; each but the last trusts
    one more at least, so there are as many as the longest chain of patterns that lead to each other, and one.

    A pattern with belief b cannot be trusted once it holds more than ``b / confidence - 1`` values. Tasks stop sending values of such a
    pattern, and it is tested again only when its belief has grown. This changes no result: it bounds what a frequent word costs.
    """
    seeds = settle(_edges(docs).groupBy("pattern", "value").agg(F.max("kind").alias("kind")))
    contexts = seeds.select("pattern", "value")
    known = settle(seeds.select("value", "kind", F.lit(1.0).alias("belief")).distinct())

    def beliefs(edges: DataFrame) -> DataFrame:
        met = keyed_left_join(edges, known.withColumnRenamed("value", "v"), [("value", "v")]).where("kind is not null")
        return met.groupBy("pattern", "kind").agg(F.sum("belief").alias("b"), F.sum((F.col("belief") >= confidence).cast("int")).alias("support"))

    pair = "pattern bigint, value bigint"
    spark = docs.sparkSession
    # ``cap`` is null where all values of the pattern are known, else what the pattern was found to exceed.
    edges, tested = spark.createDataFrame([], pair), spark.createDataFrame([], "pattern bigint, cap bigint")
    trusted = spark.createDataFrame([], "pattern bigint, kind int, score double")
    while True:
        wanted = beliefs(contexts).where(F.col("support") >= support).groupBy("pattern").agg(F.max("b").alias("b"))
        wanted = wanted.select("pattern", _cap(F.col("b"), confidence).alias("cap"))
        before = tested.select(F.col("pattern").alias("t"), F.col("cap").alias("old"))
        # A dead pattern is looked at again only when more is known of it than when it died.
        ready = settle(keyed_left_join(wanted, before, [("pattern", "t")]).where("t is null or old < cap").select("pattern", "cap"))
        if not ready.isEmpty():
            met = settle(_semi(_edges(docs, _caps(ready)), ready, "pattern").distinct())
            held = met.groupBy("pattern").agg(F.count("*").alias("n"), F.max("kind").alias("worst"))
            held = held.withColumnRenamed("pattern", "h")
            over = (F.col("worst") == _DEAD) | (F.col("n") > F.col("cap"))
            state = keyed_left_join(ready, held, [("pattern", "h")]).select("pattern", F.when(over, F.col("cap")).alias("cap"))
            state = settle(state)
            tested = settle(tested.join(state.select("pattern"), "pattern", "left_anti").unionByName(state))
            live = state.where("cap is null")
            edges = edges.unionByName(_semi(met.where(F.col("kind") < 0), live, "pattern").select("pattern", "value"))
        # Values found outside patterns under test stand in ``contexts`` too.
        edges = settle(edges.unionByName(_semi(contexts, tested.where("cap is null"), "pattern")).distinct())
        sizes = edges.groupBy(F.col("pattern").alias("p")).agg(F.count("*").alias("n"))
        scored = keyed_left_join(beliefs(edges), sizes, [("pattern", "p")]).withColumn("score", F.col("b") / (F.col("n") + 1))
        best = F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("best")
        scored = scored.where((F.col("score") >= confidence) & (F.col("support") >= support)).groupBy("pattern").agg(best)
        fresh = settle(scored.select("pattern", "best.*").join(trusted, "pattern", "left_anti"))
        if fresh.isEmpty():
            return trusted
        trusted = settle(trusted.unionByName(fresh))
        new = keyed_left_join(edges, fresh.withColumnRenamed("pattern", "p"), [("pattern", "p")]).where("kind is not null")
        new = new.groupBy("value", "kind").agg(F.max("score").alias("belief"))
        new = settle(new.join(known.select("value").distinct(), "value", "left_anti"))
        if new.isEmpty():
            return trusted
        known = settle(known.unionByName(new))
        also = _semi(_edges(docs, values=_slots(new, "value")), new, "value").select("pattern", "value")
        contexts = settle(contexts.unionByName(also).distinct())


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, counts and hash of the base spans, and all ``spans`` with those the trusted patterns add.

    Every row of ``docs`` gives one row, null texts as empty ones. Added spans never overlap base ones and
    carry the kind their pattern was learned from. Other columns are ignored.
    """
    trusted = trusted_patterns(docs, **options)
    scanned = settle(scan(docs, _slots(trusted, "pattern")))
    each = scanned.select("row", F.inline("found"))
    trusted = trusted.select(F.col("pattern").alias("p"), F.col("kind").alias("as_kind"), "score")
    added = keyed_left_join(each, trusted, [("pattern", "p")]).where("as_kind is not null")
    # Only the spans of one document meet in one row. Of those that overlap the leftmost longest stays.
    span = F.struct("at", (-F.col("upto")).alias("end"), (-F.col("score")).alias("rank"), F.col("as_kind").alias("k"))
    added = added.groupBy("row").agg(F.array_sort(F.collect_set(span)).alias("more"))
    added = added.withColumn("more", F.expr("""aggregate(more, cast(array() as array<struct<at:bigint,k:int,upto:bigint>>),
        (kept, s) -> if(size(kept) > 0 and s.at < element_at(kept, -1).upto, kept, concat(kept, array(named_struct('at', s.at, 'k', s.k, 'upto', -s.end)))))"""))
    named = F.array(*map(F.lit, KINDS))
    split = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(
        F.element_at(F.split(x, ":"), 2).cast("bigint").alias("at"),
        (F.array_position(named, F.element_at(F.split(x, ":"), 1)) - 1).cast("int").alias("k"),
        F.element_at(F.split(x, ":"), 3).cast("bigint").alias("upto"),
    ))
    joined = keyed_left_join(scanned.drop("found"), added.withColumnRenamed("row", "r"), [("row", "r")])
    spans = F.array_sort(F.concat(split, "more"))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(named, s["k"] + 1), s["at"], s["upto"])), ",")
    counts = [F.col("counts")[i].alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return joined.select(
        "doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.when(F.col("more").isNull(), F.col("base")).otherwise(text).alias("spans"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))
