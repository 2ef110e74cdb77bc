"""Recall of the vector passes on a large label over many partitions, and the statistics of the quality rules by brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from trilayer.llm import quality_rules, vectors


def test_recall_in_a_large_label_over_many_partitions(spark, settings):
    """3,000 vectors of one label in 64 partitions, half of them at cosine 0.9805 to another; components against all pairs."""
    settings(**{"spark__sql__shuffle__partitions": "64", "spark__sql__adaptive__coalescePartitions__enabled": "false"})
    r = np.random.default_rng(5)
    base = r.standard_normal((1500, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = r.standard_normal(base.shape)
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.9805 * base + np.sqrt(1 - 0.9805**2) * aside
    both = np.concatenate([base, near])
    order = r.permutation(len(both))
    table = spark.createDataFrame([(i, both[o].tolist(), "hot") for i, o in enumerate(order)], "vec_id bigint, embedding array<double>, label string")
    got = {x.vec_id: x for x in vectors.link_vectors(table.repartition(64)).collect()}
    cosines = both[order] @ both[order].T
    pairs = np.argwhere(np.triu(cosines >= 0.98, 1))
    joined = sum(got[int(a)].component_id == got[int(b)].component_id for a, b in pairs)
    print(f"recall {joined / len(pairs):.4f} of {len(pairs)} pairs")
    assert len(pairs) >= 1500 and joined / len(pairs) >= 0.99
    wrong = sum(got[i].n_links > int((cosines[i] >= 0.98).sum()) - 1 for i in got)
    assert wrong == 0


def by_brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_statistics_of_random_texts(spark, tmp_path):
    r = random.Random(21)
    parts = ["a", "b", "ab", "é", "日本", "\x1c", " ", " ", " ", "  ", "\n", "\n", "\t", "\x0b", "\r\n", "#", "<", "|x", "\n\n"]
    texts = [None, "", " \n ", "a b c " * 40, "\n".join(["same line"] * 60)]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 200))) for _ in range(300)]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = quality_rules.op4_quality_rules(spark, str(tmp_path)).collect()
    assert all(not (x.kept and x.base_failed) for x in got)
    found = sorted((tuple(x[c] for c in columns) for x in got), key=repr)
    want = []
    for i, t in rows:
        n = by_brute_force(t)
        want.append((i, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    assert found == sorted(want, key=repr)
