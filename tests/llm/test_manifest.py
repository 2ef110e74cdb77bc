"""The manifest against a plain tree, with odd rows and trees of one, few and several blocks."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trilayer.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, at int, witness string, leaf string, root string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*map(field, (r[0], r[3], r[2], r[4], text)))


def climbed(nodes):
    """The root of a list of digests and, for each, (place, run) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, i in zip(paths, at):
            path.append((i % 16, runs[i // 16]))
        nodes, at = [digest(*r) for r in runs], [i // 16 for i in at]
    return nodes[0], paths


def plain(rows):
    trees = {}
    for r in rows:
        text, own = r[1], leaf(r, r[1])
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        trees.setdefault("" if r[3] is None else "=" + r[3], []).append((r[0] is not None, r[0] or 0, own, leaf(r, text)))
    names = sorted(trees, key=str.encode)
    sub = {t: climbed([x[2] for x in sorted(trees[t])]) for t in names}
    root, upper = climbed([sub[t][0] for t in names])
    out = []
    for t, above in zip(names, upper):
        for (known, doc, own, altered), path in zip(sorted(trees[t]), sub[t][1]):
            node, proof = altered, []
            for at, run in path + above:
                proof += run[:at] + run[at + 1 :]
                node = digest(*run[:at], node, *run[at + 1 :])
            out.append((doc if known else None, own, sub[t][0], root, digest(*proof), node, node == root))
    return out


def query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in manifest.op11_merkle_manifest(spark, str(tmp_path)).collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def table(sizes, seed=3):
    r, rows = random.Random(seed), []
    for source, n in sizes.items():
        for i in range(n):
            text = r.choice([None, "", "Ünï code 日本", "abc", "x" * 500, f"Text {i} A"])
            rows.append((r.randrange(10**6) * 1000 + len(rows), text, r.choice([None, "en"]), source or None, r.choice([None, 3]), "t", 1, "w", "l", "r"))
    return rows


def test_odd_rows(spark, tmp_path):
    rows = table({"a": 1, "": 17, "b": 16, "é": 40, "z": 2})
    rows += [(None, "A", "en", "a", 1, *"t1wlr"), (None, None, None, None, None, *"t1wlr"), (7, "B", "en", "b", 1, *"t1wlr"), (7, "C", "en", "b", 1, *"t1wlr"), (7, "C", "en", "b", 1, *"t1wlr")]
    rows = [(*r[:6], 1, *r[7:]) for r in rows]
    r = random.Random(1)
    assert ordered(query(spark, spark.createDataFrame(r.sample(rows, len(rows)), SCHEMA).repartition(5), tmp_path)) == ordered(plain(rows))


@pytest.mark.parametrize("n", [4096, 4097, 9000])
def test_several_blocks(spark, many_slices, tmp_path, n):
    rows = table({"hot": n, "b": 300, "": 5})
    assert ordered(query(spark, spark.createDataFrame(rows, SCHEMA).repartition(7), tmp_path)) == ordered(plain(rows))


def test_many_sources(spark, many_slices, tmp_path):
    rows = table({f"s{i}": 1 + i % 2 for i in range(4200)})
    assert ordered(query(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), tmp_path)) == ordered(plain(rows))


def test_no_rows_and_one(spark, tmp_path):
    assert query(spark, spark.createDataFrame([], SCHEMA), tmp_path / "none") == []
    rows = table({"a": 1})
    assert query(spark, spark.createDataFrame(rows, SCHEMA), tmp_path / "one") == plain(rows)


def test_a_forged_witness_is_noticed(spark):
    docs = spark.createDataFrame(table({"a": 30, "b": 3}), SCHEMA)
    rows = manifest.manifest(docs)
    root = manifest.folded(manifest.hexed("leaf")) == manifest.hexed("root")
    assert rows.where(root).count() == 33
    forged = rows.withColumn("witness", F.reverse("witness"))
    assert forged.where(root).count() < 33
