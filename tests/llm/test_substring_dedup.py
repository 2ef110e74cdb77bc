"""Removal of repeated passages against all windows, with odd rows, hot passages and groups cut to the last."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest

from trilayer.llm import common, substring_dedup as sd

SCHEMA = "doc_id bigint, text string, doc string, own int, row string, spans string, x int, at int"
EXTRA = ("d", 1, "r", "s", 2, 3)


def by_brute_force(rows):
    first = -(1 << 63)
    words = [(first if d is None else d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            least[key] = min(least.get(key, d), d)
    out = []
    for (own, _), (d, w) in zip(rows, words):
        gone = {i + j for i in range(len(w) - 12) if least[tuple(w[i : i + 13])] < d for j in range(13)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((own, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r)[:4] for r in sd.substring_report(docs, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    say = lambda n, k=400: " ".join(f"w{r.randrange(k)}" for _ in range(n))
    hot, base = say(30), [say(r.randint(10, 150)) for _ in range(25)]
    texts = [None, "", " \n\t ", "one", say(12), say(13), "é\x0bü " * 20, "a\x1cb c " * 20, "same " * 60, "same " * 13, say(3000, 2)]
    for b in base:
        w = b.split()
        w[r.randrange(len(w))] = "changed"
        texts += [b, b, " ".join(w), "\t".join(w), say(5) + " " + hot + "\n" + say(4), hot, r.choice(base)[:120] + " " + hot + hot]
    texts.append(say(2000) + " " + hot + " " + say(2000))
    ids = list(range(len(texts)))
    r.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [(None, base[0]), (None, base[0]), (None, hot + " " + base[1]), (3, base[2]), (3, base[2]), (3, hot), (-5, base[3] + " end")]


@pytest.mark.parametrize("limit", [sd.LIMIT, 5, 1])
def test_against_all_windows(spark, rows, limit):
    assert found(spark, rows, limit=limit) == by_brute_force(rows)


def test_large_tables_are_shuffled(spark, rows, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert found(spark, rows) == by_brute_force(rows)


def test_what_is_kept(spark, rows):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    for r in sd.substring_report(docs, with_text=True).collect():
        assert (r.kept is None) == (r.n_removed == 0)
        assert r.kept is None or hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_no_rows(spark):
    assert found(spark, [(1, None)])[0][1:3] == (0, 0)
    assert sd.substring_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_are_cut_into_parts_that_hold_every_window():
    r = random.Random(2)
    text = b" ".join(b"x%d" % r.randrange(50) for _ in range(500)) + b"  \t"
    words = text.split()
    assert [w for p in sd.parts(text, 100) for w in p] == words
    seen = set()
    for first, own in sd.overlapping(text, 100):
        assert own == words[first : first + len(own)]
        seen |= set(range(first, first + len(own) - 12))
    assert seen == set(range(len(words) - 12))


def test_parts_change_no_result(spark, rows, monkeypatch):
    """The functions that tasks run, on a text in parts and as a whole."""
    texts = [t.encode() for _, t in rows if t]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["doc", "row", "text"]
    )
    anchors = lambda: {tuple(x.values()) for b in sd._anchors(iter([batch])) for x in b.to_pylist()}
    whole = {(a[0], a[2], a[3]) for a in anchors()}
    monkeypatch.setattr(sd, "PART", 200)
    assert whole <= {(a[0], a[2], a[3]) for a in anchors()} | {a for a in whole if a[2] < 0}
    spans = [[0, 14, 20, 40] if len(t.split()) > 50 else None for t in texts]
    reported = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts, pa.binary()), pa.array(spans, pa.list_(pa.int32()))], ["doc_id", "text", "spans"]
    )
    cut = [r for b in sd._reported(True)(iter([reported])) for r in b.to_pylist()]
    for t, s, r in zip(texts, spans, cut):
        w = t.split()
        kept = w if s is None else w[14:20] + w[40:]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_anchors_of_batches_and_marks():
    """A hash in two batches of sorted rows is one group; one document alone is not enough unless a row is marked."""
    rows = [(1, 5, 50, 0, False), (1, 5, 51, 4, False), (2, 5, 50, 1, False), (2, 6, 60, 1, False), (3, 7, 70, 2, False), (3, 7, 70, -1, True), (4, 8, 80, 9, True)]
    want = [(50, 1), (60, 1), (70, 2), (80, 9)]
    schema = pa.schema([("x", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("seen", pa.bool_())])
    for size in (1, 2, 3, 7):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + size]], schema) for i in range(0, len(rows), size)]
        assert [tuple(r.values()) for b in sd._in_two_documents(iter(batches)) for r in b.to_pylist()] == want
