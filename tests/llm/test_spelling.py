"""Spelling variants against brute force over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from trilayer.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int, m int, block string, near string, root string"
EXTRA = ("w", 1, 2, "b", "n", "r")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_brute_force(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in spelling.spelling_variants(docs).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    letters = "abÀéÿ×"
    words = ["".join(r.choice(letters) for _ in range(r.randint(4, 7))) for _ in range(120)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "Hello", "HELLO", "hallo", "É" * 5, "é" * 5, "x" * 300, "x" * 301, "abcdefgh"]
    texts = [" ".join(r.choices(words, [1 / (i % 40 + 1) for i in range(len(words))], k=r.randint(0, 60))) for _ in range(120)]
    texts += ["grandess " * 3, "grandes " * 8, "grande " * 20]
    texts += [None, "", "12345 ___ ĀĀĀĀĀ 日本語日本語", "x" * 300 + "-" + "x" * 301, ("x" * 300 + " " + "x" * 301 + " ") * 3, "tie" * 3]
    rows = list(enumerate(texts))
    return rows + [(None, texts[0]), (None, texts[0]), (5, texts[1]), (-7, texts[2]), (10**18, texts[3])]


def test_variants(spark, rows):
    want = by_brute_force(rows)
    assert len(want) > 60 and sum(1 for r in want if r[1] and r[2] != r[1]) >= 1
    assert found(spark, rows) == want


@pytest.mark.parametrize("limit", [1, 4, 10**6])
def test_blocks_of_any_size_give_the_same_pairs(spark, rows, limit):
    words = spelling.vocabulary(spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)).cache()
    known = {r.word: r.n for r in words.collect()}
    got = sorted(tuple(r) for r in spelling.near_words(words, limit=limit).collect())
    assert got == sorted((a, b, known[b]) for a in known for b in known if one_edit(a, b))


def test_hot_prefix(spark):
    """A third of the vocabulary begins alike: blocks are cut, and no word is lost."""
    r = random.Random(9)
    words = {"common" + "".join(r.choice("abc") for _ in range(4)) for _ in range(60)} | {"".join(r.choice("xyz") for _ in range(8)) for _ in range(100)}
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(words))], "word string, n bigint")
    placed = spelling.blocks(table, limit=6)
    sizes = placed.groupBy("block", "start", "end").count().collect()
    assert all(s["count"] <= 6 or s.end - s.start == 1 for s in sizes)
    got = {(x.word, x.near) for x in spelling.near_words(table, limit=6).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_no_words(spark):
    assert found(spark, [(1, None), (2, "too few words here")]) == []
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_chains_of_forms(spark):
    n = 40
    links = [(f"w{i}", 1 << i, 1, f"w{i + 1}" if i < n else None, 1 << (i + 1)) for i in range(n + 1)]
    formed = spark.createDataFrame(links, "word string, n bigint, n_near bigint, form string, form_n bigint")
    assert {(r.word, r.root) for r in spelling.roots(formed).collect()} == {(f"w{i}", f"w{n}") for i in range(n)}


def test_scan_of_a_sorted_list():
    r = random.Random(1)
    for _ in range(2000):
        words = sorted({"".join(r.choice("abc") for _ in range(r.randint(0, 5))) for _ in range(r.randint(1, 40))})
        shared = [0, *[spelling.shared_letters(a, b) for a, b in zip(words, words[1:])]]
        query = "".join(r.choice("abc") for _ in range(r.randint(0, 5)))
        got = list(spelling.within_one_edit(query, words, shared, spelling.behind(shared)))
        assert got == [i for i, w in enumerate(words) if w == query or one_edit(w, query)]
