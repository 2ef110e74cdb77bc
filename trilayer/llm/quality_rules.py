"""Quality rules as a learned decision list.

Statistics of whole texts are computed once. Sequential covering grows conjunctions of
threshold tests that describe low-quality documents on two thirds of a labelled sample, prunes
each on the rest, and keeps it only while it stays precise. The list becomes one
ordered Spark conditional expression.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.llm.common import read, slices
from trilayer.llm.labelled import training_sample
from trilayer.operators import settle

SYMBOLS = "#*$%&|<>"
_SPACE_TABLE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct")


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS`` of one whole text; null counts as empty."""
    text = text or ""
    # Bytes split exactly at the white space that separates words here.
    words = text.encode().split()
    bare = text.translate(_SPACE_TABLE)
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(seen := Counter(windows)) < len(windows):
        inside = np.zeros(len(words), bool)
        for i, w in enumerate(windows):
            if seen[w] > 1:
                inside[i : i + 3] = True
        repeated = int(inside.sum())
    return (
        len(words), len(bare), sum(text.count(s) for s in SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
        sum(map(str.isupper, bare)), sum(text.count(d) for d in "0123456789"), text.count("!") + text.count("?"), len(set(words)),
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts. Every row of ``docs`` gives one row; other columns are ignored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows))], ["doc_id", *COUNTS]
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(count, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def per(total: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(total) / F.col(of)).otherwise(F.lit(0.0))


#: What the rules may test, as expressions over the counts.
FEATURES = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: per("word_chars", "n_words"),
    "symbols": lambda: per("n_symbols", "n_words"),
    "duplicate_lines": lambda: per("n_dup_lines", "n_lines"),
    "repeated_words": lambda: per("n_repeat_words", "n_words"),
    "words_a_line": lambda: per("n_words", "n_lines"),
    "upper_case": lambda: per("n_upper", "word_chars"),
    "digits": lambda: per("n_digits", "word_chars"),
    "marks": lambda: per("n_marks", "n_words"),
    "distinct_words": lambda: per("n_distinct", "n_words"),
}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    at: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value > F.lit(self.at) if self.above else value <= F.lit(self.at)

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.at if self.above else x[self.feature] <= self.at

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.at:g}"


def _matches(rule: list[Test], x: dict[str, np.ndarray]) -> np.ndarray:
    found = np.ones(len(next(iter(x.values()))), bool)
    for test in rule:
        found &= test.rows(x)
    return found


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int, cuts: int) -> list[Test]:
    """Add the test with the largest information gain until no clean row matches."""
    rule, inside = [], np.ones(len(bad), bool)
    while len(rule) < longest and (p0 := int((inside & bad).sum())) and p0 < inside.sum():
        before, best = np.log2(p0 / inside.sum()), (1e-9, None)
        for name, values in x.items():
            for at in np.unique(np.quantile(values[inside], np.linspace(0, 1, cuts), method="lower")):
                for above in (True, False):
                    now = inside & (values > at if above else values <= at)
                    p = int((now & bad).sum())
                    if p and (gain := p * (np.log2(p / now.sum()) - before)) > best[0]:
                        best = gain, Test(name, above, float(at))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].rows(x)
    return rule


def _worth(rule: list[Test], x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    found = _matches(rule, x)
    p, n = int((found & bad).sum()), int((found & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], bad: np.ndarray, pruning: np.ndarray, most: int = 12, precision: float = 0.95, longest: int = 4, cuts: int = 40) -> list[list[Test]]:
    """Rules that describe the rows in ``bad``, in the order found. ``pruning`` marks rows kept from growing."""
    rules: list[list[Test]] = []
    left = np.ones(len(bad), bool)
    part = lambda rows: {k: v[rows] for k, v in x.items()}
    while len(rules) < most:
        grow, prune = left & ~pruning, left & pruning
        if bad[grow].sum() < 3:
            break
        rule = _grow(part(grow), bad[grow], longest, cuts)
        if not rule:
            break
        # Drop tests from the end while the rule gets no worse on rows it was not grown on.
        while len(rule) > 1 and _worth(rule[:-1], part(prune), bad[prune]) >= _worth(rule, part(prune), bad[prune]):
            rule = rule[:-1]
        found = _matches(rule, x) & left
        if not found.any() or bad[found].mean() < precision or _worth(rule, part(prune), bad[prune]) < 2 * precision - 1:
            break
        rules.append(rule)
        left &= ~found
    return rules


def fit(stats: DataFrame, labels: DataFrame, most_rows: int = 20_000, **options) -> list[list[Test]]:
    """Learn from at most ``most_rows`` labelled rows that are not held out; only their numbers reach the driver."""
    low = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    rows = training_sample(stats.join(low, "doc_id"), most_rows)
    rows = rows.select("doc_id", "_quality", *[f().alias(n) for n, f in FEATURES.items()]).collect()
    if not rows:
        return []
    x = {n: np.array([r[n] for r in rows]) for n in FEATURES}
    pruning = np.array([zlib.crc32(b"prune %d" % r["doc_id"]) % 3 == 0 for r in rows])
    return learn(x, np.array([r["_quality"] == 0 for r in rows]), pruning, **options)


def first_rule(rules: list[list[Test]]) -> Column:
    """Number (from 1) of the first rule that matches, null if none does."""
    number = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        condition = F.lit(True)
        for test in rule:
            condition = condition & test.column()
        number = F.when(condition, F.lit(i)).otherwise(number)
    return number


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The counts of every document with ``base_failed``, the ``rule`` that rejects it and ``kept``.

    Every row of ``docs`` is judged, rows with null text as empty ones. Without labels
    there are no rules and only the base test rejects. An empty table gives no rows.
    """
    stats = settle(document_statistics(docs))
    rules = fit(stats, labels, **options)
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *COUNTS[:5], "base_failed", "rule", "kept")
