"""Merkle manifest of a table of documents with incremental witnesses.

Every document is a leaf. Within its source, leaves in order of ``doc_id`` are appended to a tree of runs of 16, one source
after the other, and the roots of the sources are appended to a tree of the same kind in order of source.

The appends are cut into aligned blocks of ``BLOCK`` nodes, so that any number of tasks append at once. A task holds the
subtrees of one block that are still open. Each node of an open run carries the leaves below it; when the run completes,
the witness of each of these leaves is extended by the siblings in the run, and the run's digest is appended one level up. The
root of a block is an append to the next tier of blocks, until one node is left. Witnesses travel
back down: a block begins with the witness of its own root, which ends the witness of each of its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from trilayer.llm.common import read
from trilayer.operators import keyed_left_join, settle

#: Members of a run.
RUN = 16
#: Levels in a block and nodes in a full block.
LEVELS = 3
BLOCK = RUN**LEVELS

WITNESS = "array<struct<at:int,siblings:binary>>"
_STEPS = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.binary())]))


# --- leaves ---------------------------------------------------------------------


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | str = "text") -> Column:
    """SHA-256 of the row: each field as byte count, colon and value, or ``-`` for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, source, leaf`` and, where ``tampered`` (a text) is given, the digest ``altered`` of the row with that text.

    The text is read once and stays behind; digests are binary from here on.
    """
    own = F.unhex(leaf_digest())
    altered = F.lit(None).cast("binary") if tampered is None else F.unhex(leaf_digest(tampered))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), own.alias("leaf"), altered.alias("altered"))


# --- appending ------------------------------------------------------------------


class Appender:
    """One block. ``append`` takes digests in order, ``close`` completes what is still open.

    ``open[k]`` holds the nodes of the open run of level k as (digest, first leaf, last leaf + 1).
    """

    def __init__(self, witnesses: bool):
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witnesses: list[list[tuple[int, bytes]]] | None = [] if witnesses else None
        self.n = 0

    def append(self, digest: bytes) -> None:
        self.open[0].append((digest, self.n, self.n + 1))
        self.n += 1
        if self.witnesses is not None:
            self.witnesses.append([])
        level = 0
        while len(self.open[level]) == RUN and level < LEVELS:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in run]
        if self.witnesses is not None:
            for at, (_, first, end) in enumerate(run):
                siblings = b"".join(digests[:at] + digests[at + 1 :])
                for leaf in range(first, end):
                    self.witnesses[leaf].append((at, siblings))
        if level + 1 == len(self.open):
            self.open.append([])
        digest = hashlib.sha256(b"".join(digests).hex().encode()).digest()
        self.open[level + 1].append((digest, run[0][1], run[-1][2]))

    def close(self, whole: bool) -> bytes:
        """The root. ``whole``: the block is all of its tree and ends with one node; others end ``LEVELS`` levels up."""
        level = 0
        while level < LEVELS:
            if whole and sum(map(len, self.open)) == 1:
                return next(run[0][0] for run in self.open if run)
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[LEVELS][0][0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of each block, which come one after the other; at most ``BLOCK`` and one."""
    key, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            for row in batch.slice(at, BLOCK).to_pylist():
                if (row["tree"], row["block"]) != key:
                    if rows:
                        yield key, rows
                    key, rows = (row["tree"], row["block"]), []
                rows.append(row)
    if rows:
        yield key, rows


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (tree, block), rows in _blocks(batches):
        appender = Appender(witnesses=False)
        for row in rows:
            appender.append(row["digest"])
        one = rows[0]["n"] <= BLOCK
        yield pa.RecordBatch.from_arrays(
            [pa.array([tree], pa.string()), pa.array([block], pa.int64()), pa.array([-(-rows[0]["n"] // BLOCK)], pa.int64()), pa.array([appender.close(one)], pa.binary())],
            ["tree", "at", "n", "digest"],
        )


def _witnessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (tree, _), rows in _blocks(batches):
        # Position -1 is the block's own root with the witness that leads on from it.
        upper = [(s["at"], s["siblings"]) for s in rows[0]["witness"]]
        appender = Appender(witnesses=True)
        for row in rows[1:]:
            appender.append(row["digest"])
        appender.close(rows[0]["n"] <= BLOCK)
        full = [[{"at": at, "siblings": s} for at, s in own + upper] for own in appender.witnesses]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tree] * len(full), pa.string()), pa.array([r["at"] for r in rows[1:]], pa.int64()), pa.array(full, _STEPS)], ["tree", "at", "witness"]
        )


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their ``tree`` (from 0), and ``n``, the size of the tree.

    Rows are range-partitioned by tree and ``order``, so the largest tree is spread over tasks; from each task one number a tree is added up.
    """
    by = ["tree", *order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sliced = settle(ordered.withColumns({"slice": F.spark_partition_id(), "spot": position}))
    parts = sliced.groupBy("tree", "slice").agg(F.count("*").alias("rows"), F.min("spot").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col("tree").alias("p_tree"), F.col("slice").alias("p_slice"),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n"),
    )
    placed = keyed_left_join(sliced, parts, [("tree", "p_tree"), ("slice", "p_slice")])
    return placed.withColumn("at", F.col("spot") + F.col("shift")).drop("p_tree", "p_slice", "slice", "spot", "shift")


def _by_block(nodes: DataFrame) -> DataFrame:
    blocked = nodes.withColumn("block", F.floor(F.col("at") / BLOCK))
    return blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Nodes ``tree, at, n, digest``, the roots of their blocks, the roots of the blocks of these and so on up to one node a tree."""
    tiers = [nodes]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        below = _by_block(tiers[-1].select("tree", "at", "n", "digest"))
        tiers.append(settle(below.mapInArrow(_roots, "tree string, at bigint, n bigint, digest binary")))
    return tiers


def _witnesses(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """``tree, at, witness`` of the lowest tier; ``top`` has ``tree, witness`` of the node that each tree ends with."""
    found = top.select("tree", F.lit(0).cast("bigint").alias("at"), "witness")
    for nodes in reversed(tiers[:-1]):
        rows = nodes.select("tree", F.floor(F.col("at") / BLOCK).alias("block"), "at", "n", "digest", F.lit(None).cast(WITNESS).alias("witness"))
        sizes = rows.where(F.col("at") % BLOCK == 0).select(F.col("tree").alias("s_tree"), F.col("block").alias("s_block"), "n")
        heads = keyed_left_join(found, sizes, [("tree", "s_tree"), ("at", "s_block")]).select(
            "tree", F.col("at").alias("block"), F.lit(-1).cast("bigint").alias("at"), "n", F.lit(None).cast("binary").alias("digest"), "witness"
        )
        both = rows.unionAll(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
        found = settle(both.mapInArrow(_witnessed, f"tree string, at bigint, witness {WITNESS}"))
    return found


def _tree_of(source: str = "source") -> Column:
    """A name that sorts null first; no source has the empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, source, leaf, altered, subroot, root, witness`` for every row of ``docs``; digests are binary.

    ``witness`` lists, from the leaf up to the root, the place in each run and the digests of its other members. Rows of a
    source ascend by ``doc_id``, null first, and rows with one ``doc_id`` by their digest; rows that agree in all fields have places of
    their own in any arrangement, with equal trees. A null source is a source, the first. Null and empty texts are leaves like others.
    An empty table gives no rows. Further columns are ignored.
    """
    rows = settle(leaves(docs, tampered).withColumn("tree", _tree_of()).withColumnRenamed("leaf", "digest"))
    nodes = settle(_placed(rows, ["doc_id", "digest"]))
    tiers = _tiers(nodes)
    subroots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    forest = settle(_placed(subroots, ["of"]))
    upper = _tiers(forest)
    root = upper[-1].first()
    none = F.array().cast(WITNESS)
    paths = _witnesses(upper, upper[-1].select("tree", none.alias("witness")))
    paths = keyed_left_join(forest.select("of", F.col("at").alias("spot")), paths.select(F.col("at").alias("p"), "witness"), [("spot", "p")])
    if len(upper) == 1:
        paths = forest.select("of", none.alias("witness"))
    found = _witnesses(tiers, paths.select(F.col("of").alias("tree"), "witness"))
    found = found.select(F.col("tree").alias("w_tree"), F.col("at").alias("w_at"), "witness")
    proven = keyed_left_join(nodes, found, [("tree", "w_tree"), ("at", "w_at")])
    proven = keyed_left_join(proven, subroots.select("of", F.col("digest").alias("subroot")), [("tree", "of")])
    return proven.select(
        "doc_id", "source", F.col("digest").alias("leaf"), "altered", "subroot",
        F.lit(bytes(root["digest"]) if root else None).cast("binary").alias("root"), "witness",
    )


# --- checking -------------------------------------------------------------------


def hexed(c: Column | str) -> Column:
    return F.lower(F.hex(c))


def folded(leaf: Column, witness: Column | str = "witness") -> Column:
    """The root, as hex text, that a leaf (hex text) and its witness lead to."""

    def up(node: Column, step: Column) -> Column:
        siblings, before = hexed(step["siblings"]), step["at"] * 64
        return F.sha2(F.concat(siblings.substr(F.lit(1), before), node, siblings.substr(before + 1, F.length(siblings))), 256)

    return F.aggregate(witness, leaf, up)


def proof_digest(witness: Column | str = "witness") -> Column:
    """SHA-256 of all siblings as hex text, from the leaf up."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: hexed(step["siblings"])), ""), 256)


#: The rows whose text the check alters, and how: A-Z becomes a-z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def altered_text() -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of the id, else as it is; rows without an id stay as they are."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(read(spark, sf_dir, "documents"), altered_text())
    folded_root = folded(hexed("altered"))
    return rows.select(
        "doc_id", hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"), hexed("root").alias("root"),
        proof_digest().alias("proof_sha256"), folded_root.alias("folded_root"), (folded_root == hexed("root")).alias("verified"),
    )


# --- the same in SQL -------------------------------------------------------------


def _sql() -> str:
    """Levels one by one: each row of ``l<k>`` is a node of level k, and ``d<k>`` gives every leaf its siblings of that level."""
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    digest = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    parts = [
        f"crc(x, i, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL SELECT ({bit})::BIGINT, i, k + 1 FROM crc WHERE k < 8)",
        "tab AS (SELECT list(x ORDER BY i) AS t FROM crc WHERE k = 8)",
        """ids AS (SELECT DISTINCT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS crc FROM documents, tab WHERE doc_id IS NOT NULL)""",
        f"""base AS (SELECT d.doc_id, coalesce('=' || source, '') AS tree, {digest('text')} AS leaf,
            CASE WHEN crc % 5 = 0 THEN {digest(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {digest('text')} END AS altered
            FROM documents d LEFT JOIN ids USING (doc_id))""",
        """leafs AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            row_number() OVER () AS id FROM base)""",
    ]

    def climb(prefix: str, start: str, depth: int) -> None:
        """Levels ``0..depth`` of the trees in ``start`` (tree, pos, digest)."""
        parts.append(f"{prefix}0 AS (SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM ({start}))")
        for k in range(depth):
            parts.append(f"""{prefix}{k + 1} AS (SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM (
                SELECT tree, CASE WHEN n > 1 THEN pos // 16 ELSE pos END AS pos,
                    CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY {prefix}{k}.pos)) ELSE any_value(digest) END AS digest
                FROM {prefix}{k} GROUP BY tree, n, CASE WHEN n > 1 THEN pos // 16 ELSE pos END))""")
            parts.append(f"""{prefix}r{k} AS (SELECT tree, pos // 16 AS run, list(digest ORDER BY pos) AS ds FROM {prefix}{k} WHERE n > 1 GROUP BY ALL)""")

    depth, steps = 6, []
    climb("l", "SELECT tree, pos, leaf AS digest FROM leafs", depth)
    climb("s", f"SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest FROM l{depth}", depth)
    parts.append(f"placed AS (SELECT f.*, l.digest AS subroot, dense_rank() OVER (ORDER BY f.tree) - 1 AS spot, (SELECT digest FROM s{depth}) AS root FROM leafs f JOIN l{depth} l USING (tree))")
    parts.append("f0 AS (SELECT *, altered AS node, '' AS proof FROM placed)")
    k = 0
    for prefix, tree, at in (("l", "f.tree", "f.pos"), ("s", "''", "f.spot")):
        for level in range(depth):
            place = f"({at} // {16**level})"
            parts.append(f"""f{k + 1} AS (SELECT f.* REPLACE (
                CASE WHEN ds IS NULL THEN node ELSE sha256(array_to_string(ds[:({place} % 16)::INT], '') || node || array_to_string(ds[({place} % 16 + 2)::INT:], '')) END AS node,
                CASE WHEN ds IS NULL THEN proof ELSE proof || array_to_string(ds[:({place} % 16)::INT], '') || array_to_string(ds[({place} % 16 + 2)::INT:], '') END AS proof)
                FROM f{k} f LEFT JOIN {prefix}r{level} r ON r.tree = {tree} AND r.run = {place} // 16)""")
            k += 1
    return "WITH RECURSIVE " + ",\n".join(parts) + f"""
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM f{k}"""


SQL = _sql()
