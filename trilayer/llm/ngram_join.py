"""N-gram Jaccard join by grouped prefixes.

A document is the set of its word shingles. Shingles that many documents share come last in a global order, so
similar documents must share one of the first few shingles of each. Documents with the same first
shingles and the same size form one group; only groups meet. Group pairs pass a length and a positional filter, are
expanded to the different sets in them, pass a parity filter (512 bits whose difference bounds the number of shingles in one
set only) and are verified on whole sets.

Groups that share a shingle first meet the head of its list. What that links needs no further pair, so a large
group of near copies costs about one pair a member; pairs that may still join two components follow. Such a pair is left out
of a list where both groups hold one of the same few shingles before, since it was made there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from trilayer.llm.common import WORD, components, joined_by_size, mixed, read, rolling, slices, span_hashes, unused
from trilayer.operators import discard, keyed_left_join, settle

BITS = [f"b{i}" for i in range(8)]
#: Documents compared with one set in one task.
MEMBERS = 512
#: Earlier shared shingles that a row of a list carries.
BEFORE = 4


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of each text, A-Z lower-cased.

    A text with fewer words is one shingle of all of them; without words it has none.
    """
    words = [(t or b"").lower().split() for t in texts]
    counts = np.array([len(w) for w in words])
    data = np.frombuffer(b"\n".join(b" ".join(w) for w in words if w), np.uint8)
    out = [np.empty(0, np.uint64)] * len(texts)
    if not len(data):
        return out
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    sums, down = rolling(data)
    at = 0
    for i, n in enumerate(counts.tolist()):
        if n:
            m = max(1, n - k + 1)
            out[i] = np.unique(span_hashes(sums, down, starts[at : at + m], ends[at + min(n, k) - 1 : at + min(n, k) - 1 + m]))
            at += n
    return out


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches whose second column is text as bytes, with the sets of their rows."""
    for batch in slices(batches, most_bytes=2 << 20):
        yield batch, shingle_sets(batch.column(1).to_pylist(), k)


def common_shingles(docs: DataFrame, k: int, most: int) -> np.ndarray:
    """The shingles met most often, rarest first: at most ``most`` of them, so that they can be broadcast.

    All documents are counted. A task drops what it met once, so the counts are those of repeated
    shingles; they only order shingles, and any order gives the same links.
    """

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def part() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], ["x", "n"])

        for _, sets in _sets(batches, k):
            held += sets
            if sum(map(len, held)) > 3_000_000:
                yield part()
        if held:
            yield part()

    counts = settle(docs.select("doc_id", "text").mapInArrow(repeated, "x bigint, n bigint").groupBy("x").agg(F.sum("n").alias("n")))
    # The smallest count that leaves no more than allowed, from one row for each eighth of a doubling.
    step = F.floor(8 * F.log2("n")).cast("int")
    histogram = {r["step"]: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    least, total = None, 0
    for s in sorted(histogram, reverse=True):
        total += histogram[s]
        if total > most:
            break
        least = s
    if least is None:
        return np.empty(0, np.uint64)
    # As Arrow, 16 bytes a row reach the driver; as rows of Python objects it would be hundreds.
    rows = counts.where(step >= least).select("n", "x").toArrow()
    discard(counts)
    n, x = (rows.column(c).to_numpy() for c in ("n", "x"))
    return x[np.lexsort((x, n))].view(np.uint64)


def _ordered(found: np.ndarray, common: np.ndarray, rank: np.ndarray, keep: int) -> np.ndarray:
    """The first ``keep`` shingles of a set: those not common by hash, then the common ones from the rarest."""
    if not len(common):
        return found[:keep]
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    shared = common[at] == found
    rare = found[~shared]
    if len(rare) >= keep:
        return rare[:keep]
    late = found[shared]
    return np.concatenate([rare, late[np.argsort(rank[at[shared]], kind="stable")]])[:keep]


def prefix_length(n: int, part: int) -> int:
    """Sets of size n that share ``part`` percent with another share one of so many first members."""
    return n - -(-part * n // 100) + 1 if n else 0


def document_sets(docs: DataFrame, common: np.ndarray, k: int, part: int) -> DataFrame:
    """``doc_id``, size ``n``, hashes of the whole set and of its prefix, parity bits and the prefix itself."""
    by_value = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[by_value], by_value))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = shared.value
        salt = np.uint64(0x5851F42D4C957F2D)
        for batch, sets in _sets(batches, k):
            rows = []
            for found in sets:
                prefix = _ordered(found, common, rank, prefix_length(len(found), part))
                odd = np.bitwise_xor.reduce(_one_bit(found), axis=0) if len(found) else np.zeros(8, np.uint64)
                whole = (int(mixed(found).sum(dtype=np.uint64)), int(mixed(found ^ salt).sum(dtype=np.uint64)))
                place = mixed(np.arange(1, len(prefix) + 1, dtype=np.uint64))
                first = int(mixed(prefix + place).sum(dtype=np.uint64))
                rows.append((len(found), *whole, first, *odd.tolist(), prefix.view(np.int64)))
            columns = list(zip(*rows))
            signed = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in columns[:12]]
            prefixes = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(p) for p in columns[12]])]).astype(np.int32), pa.array(np.concatenate(columns[12]))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), *signed, prefixes], ["doc_id", "n", "k1", "k2", "pk", *BITS, "prefix"])

    schema = "doc_id bigint, n bigint, k1 bigint, k2 bigint, pk bigint, " + ", ".join(f"{b} bigint" for b in BITS) + ", prefix array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def _one_bit(found: np.ndarray) -> np.ndarray:
    """For each hash, eight words with one bit set among 512."""
    out = np.zeros((len(found), 8), np.uint64)
    bit = found >> np.uint64(55)
    out[np.arange(len(found)), (bit >> np.uint64(6)).astype(np.int64)] = np.uint64(1) << (bit & np.uint64(63))
    return out


def _repeated_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted batches whose first column equals that of the row before or after."""
    held, held_kept = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([held, batch]) if held is not None else batch
        token = rows.column(0).to_numpy()
        same = token[1:] == token[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        # The last row meets the next batch too; what is already out does not come again.
        held, last = rows.slice(len(token) - 1), bool(keep[-1])
        keep[0] &= not held_kept
        held_kept = last
        yield rows.filter(pa.array(keep))


def _in_lists(groups: DataFrame) -> DataFrame:
    """``token, g, n, place`` of prefix members that two or more groups share."""
    rows = groups.select("g", "n", F.posexplode("prefix").alias("place", "token")).select("token", "g", F.col("n").cast("int").alias("n"), "place")
    rows = rows.repartition("token").sortWithinPartitions("token")
    return rows.mapInArrow(_repeated_tokens, "token bigint, g bigint, n int, place int")


def _with_earlier(lists: DataFrame) -> DataFrame:
    """``lists`` with ``before``, the last few listed members ahead of each one in its group's prefix."""
    ahead = Window.partitionBy("g").orderBy("place").rowsBetween(-BEFORE, -1)
    return lists.withColumn("before", F.collect_list("token").over(ahead))


def _meetings(placed: DataFrame, part: int) -> DataFrame:
    """Pairs ``g, e_g`` of groups in one list that may join components, some of them more than once.

    A pair that links passes the filters wherever it shares a member, so at the first one that it shares it is always made. Where both
    groups hold a common member ``before``, that first one lies further ahead.
    """
    own = ("g", "n", "place", "comp", "p0", "p1", "p2", "p3", "before")
    others = placed.select(F.col("token").alias("t"), *[F.col(c).alias(f"e_{c}") for c in own])
    apart = F.col("comp").isNull() | F.col("e_comp").isNull() | (F.col("comp") != F.col("e_comp"))
    differ = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"e_p{i}"))) for i in range(4)), F.lit(0))
    size = F.col("n") + F.col("e_n")
    alike = F.coalesce((100 + part) * (size - differ) >= 2 * part * size, F.lit(True))
    here = (F.col("token") == F.col("t")) & (F.col("e_g") < F.col("g"))
    return placed.join(others, here & apart & _may_link(part) & alike & ~F.arrays_overlap("before", "e_before")).select("g", "e_g")


def _may_link(part: int) -> Column:
    """Length and positional filters on two groups in one list."""
    shared = F.least("place", "e_place") + F.least(F.col("n") - F.col("place"), F.col("e_n") - F.col("e_place"))
    return (100 * F.least("n", "e_n") >= part * F.greatest("n", "e_n")) & ((100 + part) * shared >= part * (F.col("n") + F.col("e_n")))


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, part: int) -> DataFrame:
    """Those ``a, b`` (representative documents) of ``pairs`` whose whole sets are similar enough."""
    side = lambda c: classes.select(F.col("c").alias(f"{c}_"), F.col("n").alias(f"{c}_n"), *[F.col(b).alias(f"{c}_{b}") for b in BITS])
    both = keyed_left_join(keyed_left_join(pairs, side("a"), [("a", "a_")]), side("b"), [("b", "b_")])
    apart = sum((F.bit_count(F.col(f"a_{b}").bitwiseXOR(F.col(f"b_{b}"))) for b in BITS), F.lit(0))
    size = F.col("a_n") + F.col("b_n")
    near = settle(both.where(100 * F.least("a_n", "b_n") >= part * F.greatest("a_n", "b_n")).where(
        (100 + part) * (size - apart) >= 2 * part * size
    ).select("a", "b"))
    # The members of a hot ``b`` are dealt out in parts, and its set goes to each of them.
    parts = near.groupBy(F.col("b").alias("p")).agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    dealt = keyed_left_join(near, parts, [("b", "p")]).select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("s"))
    dealt = settle(dealt)
    discard(near)
    member = dealt.select(F.col("a").alias("doc"), F.struct("b", "s", F.lit(1).alias("member")).alias("role"))
    head = dealt.select("b", "s").distinct().select(F.col("b").alias("doc"), F.struct("b", "s", F.lit(0).alias("member")).alias("role"))
    roles = settle(member.unionAll(head).groupBy("doc").agg(F.collect_list("role").alias("roles")))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The text of ``b`` comes first in each part; one set is held at a time.
        key, of = None, None
        for batch, found in _sets(batches, k):
            pairs = []
            for a, b, s, is_member, x in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "s", "member")], found):
                if not is_member:
                    key, of = (b, s), x
                elif key == (b, s):
                    shared = len(np.intersect1d(x, of, assume_unique=True))
                    if 100 * shared >= part * (len(x) + len(of) - shared):
                        pairs.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    # Texts are sent, not their sets: a shingle takes eight bytes that cannot be packed, the word it adds takes fewer that can.
    chosen = joined_by_size(docs.select("doc_id", "text"), roles, [("doc_id", "doc")], "roles").where("roles is not null")
    rows = chosen.select(F.col("doc_id").alias("a"), "text", F.inline("roles"))
    rows = rows.repartition("b", "s").sortWithinPartitions("b", "s", "member")
    found = settle(rows.mapInArrow(verified, "a bigint, b bigint"))
    discard(dealt, roles)
    return found


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def _ids_are_unique(rows: DataFrame) -> bool:
    return rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def _number() -> Column:
    """A number for rows that agree in id and text; null for null ids."""
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("binary"), F.lit(b""))))


def link_documents(docs: DataFrame, k: int = 4, part: int = 85, most_common: int = 1 << 20) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two rows link when their shingle sets share ``part`` percent of their union. Equal sets are one class. Null, empty and blank texts have
    an empty set and link with nothing. Rows with words and one ``doc_id`` are linked to each other by having that id; rows with a null
    id are returned with a null component and link with nothing. Other columns are ignored.
    """
    rows = _rows(docs)
    if _ids_are_unique(rows):
        return _components_of(rows, k, part, most_common)
    # Rows that share an id get numbers by id and text, and links for the shared id.
    numbered = settle(rows.withColumn("own", _number()))
    ids = settle(numbered.where("own is not null").select("own", "doc_id").distinct())
    worded = numbered.where(F.col("own").isNotNull() & F.col("text").cast("string").rlike(WORD)).select("own", "doc_id").distinct()
    least = worded.groupBy(F.col("doc_id").alias("d")).agg(F.min("own").alias("least"))
    same_id = keyed_left_join(worded, least, [("doc_id", "d")]).where("own <> least").select(F.col("own").alias("a"), F.col("least").alias("b"))
    found = settle(_components_of(numbered.select(F.col("own").alias("doc_id"), "text"), k, part, most_common, settle(same_id)))
    each = found.where("doc_id is not null").select(F.col("doc_id").alias("o"), "n_shingles", F.col("component_id").alias("c")).distinct()
    each = settle(keyed_left_join(ids, each, [("own", "o")]).drop("o"))
    smallest = each.groupBy(F.col("c").alias("s")).agg(F.min("doc_id").alias("component_id"))
    each = keyed_left_join(each, smallest, [("c", "s")]).select(F.col("own").alias("e"), "n_shingles", "component_id")
    known = keyed_left_join(numbered.where("own is not null").select("doc_id", "own"), each, [("own", "e")])
    return known.select("doc_id", "n_shingles", "component_id").unionAll(found.where("doc_id is null"))


def _components_of(rows: DataFrame, k: int, part: int, most_common: int, given: DataFrame | None = None) -> DataFrame:
    """``link_documents`` for rows whose ids are null or different texts' own; ``given`` are further links ``a, b``."""
    common = common_shingles(rows, k, most_common)
    sets = settle(document_sets(rows, common, k, part))
    usable = sets.where("n > 0 and doc_id is not null")
    classes = usable.groupBy("n", "pk", "k1", "k2").agg(F.min("doc_id").alias("c"), *[F.first(b).alias(b) for b in BITS])
    groups = usable.groupBy("n", "pk").agg(F.min("doc_id").alias("g"))
    groups = groups.withColumnsRenamed({"n": "g_n", "pk": "g_pk"})
    classes = settle(keyed_left_join(classes, groups, [("n", "g_n"), ("pk", "g_pk")]).drop("g_n", "g_pk"))
    # A group has one prefix, which leaves the texts' rows in the one shuffle that makes the groups.
    firsts = usable.groupBy("n", "pk").agg(F.min("doc_id").alias("g"), F.first("prefix").alias("prefix"))
    lists = settle(_in_lists(firsts))
    # What follows needs the keys alone.
    whole_sets, sets = sets, settle(sets.select("doc_id", "n", "pk", "k1", "k2"))
    usable = sets.where("n > 0 and doc_id is not null")
    discard(whole_sets)

    # First, every group with the head of each of its lists, and every set with the first of its group.
    heads = lists.groupBy("token").agg(F.min(F.struct("g", "n", "place")).alias("e"))
    heads = heads.select(F.col("token").alias("t"), F.col("e.g").alias("e_g"), F.col("e.n").alias("e_n"), F.col("e.place").alias("e_place"))
    met = keyed_left_join(lists, heads, [("token", "t")]).where("e_g < g").where(_may_link(part)).select("g", "e_g").distinct()
    members = classes.select(F.col("g").alias("of"), "c")
    first = _both(members, met, "g").select(F.col("c").alias("a"), F.col("e_g").alias("b"))
    first = settle(first.unionAll(classes.where("c <> g").select(F.col("c").alias("a"), F.col("g").alias("b"))).distinct())
    links = _linked(rows, classes, first, k, part)

    # Then the pairs that may still join components; a group within one component carries its number.
    labels = components(links)
    owned = keyed_left_join(classes.select("c", "g"), labels, [("c", "node")]).select("c", "g", F.coalesce("component", "c").alias("comp"))
    owned = settle(owned)
    # A group of one set carries its parity bits too, folded to half, so that few pairs leave the join.
    folded = classes.groupBy("g").agg(F.count("*").alias("sets"), *[
        F.first(F.col(b).bitwiseXOR(F.col(BITS[i + 4]))).alias(f"p{i}") for i, b in enumerate(BITS[:4])
    ])
    alone = [F.when(F.col("sets") == 1, F.col(f"p{i}")).alias(f"p{i}") for i in range(4)]
    whole = owned.groupBy("g").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    whole = whole.select(F.col("g").alias("w"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("comp"))
    bits = keyed_left_join(whole, folded.select(F.col("g").alias("f"), *alone), [("w", "f")]).drop("f")
    # Few rows share a group: no more than its prefix has members.
    placed = settle(keyed_left_join(_with_earlier(lists), bits, [("g", "w")], split=False).drop("w"))
    discard(lists)
    met = _meetings(placed, part).distinct()
    mixed_groups = whole.where("comp is null").select(F.col("w").alias("g"), F.col("w").alias("e_g"))
    met = settle(met.unionAll(mixed_groups))
    discard(placed)
    members = owned.select(F.col("g").alias("of"), "c", "comp")
    second = _both(members, met, "g").select("e_g", F.col("c").alias("a"), F.col("comp").alias("a_comp"))
    second = _both(members, second, "e_g").where("comp <> a_comp").select(F.greatest("a", "c").alias("a"), F.least("a", "c").alias("b")).distinct()
    # What the first step verified without success need not be verified again.
    tried = first.select(F.greatest("a", "b").alias("f_a"), F.least("a", "b").alias("f_b"))
    second = settle(keyed_left_join(second, tried, [("a", "f_a"), ("b", "f_b")]).where("f_a is null").select("a", "b"))
    discard(first, met)
    links = links.unionAll(_linked(rows, classes, second, k, part))
    labels = components(links if given is None else links.unionAll(_of_classes(usable, classes, given)))

    owned = keyed_left_join(classes.select("n", "pk", "k1", "k2", "c"), labels, [("c", "node")])
    owned = owned.select(*[F.col(x).alias(f"o_{x}") for x in ("n", "pk", "k1", "k2")], F.coalesce("component", "c").alias("comp"))
    keys = [(x, f"o_{x}") for x in ("n", "pk", "k1", "k2")]
    return keyed_left_join(sets.select("doc_id", "n", "pk", "k1", "k2"), owned, keys).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")
    )


def _of_classes(usable: DataFrame, classes: DataFrame, given: DataFrame) -> DataFrame:
    """Links ``a, b`` of documents as links of the classes that hold them."""
    keys = ["n", "pk", "k1", "k2"]
    of = classes.select(*[F.col(x).alias(f"o_{x}") for x in keys], "c")
    of = keyed_left_join(usable.select("doc_id", *keys).distinct(), of, [(x, f"o_{x}") for x in keys]).select(F.col("doc_id").alias("of"), "c")
    for side in ("a", "b"):
        given = keyed_left_join(given, of, [(side, "of")]).withColumn(side, F.col("c")).drop("of", "c")
    return given


def _both(members: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """Each pair with every set of the group named in ``column``; the keys are hashed so that a large group is split."""
    left = pairs.withColumn("_h", F.xxhash64(column))
    right = members.withColumn("_k", F.xxhash64("of"))
    return left.join(right, (F.col("_h") == F.col("_k")) & (F.col(column) == F.col("of"))).drop("_h", "_k", "of")


def first_of_each_component(docs: DataFrame, k: int = 4, part: int = 85, most_common: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` that come first in their component: those of the smallest ``doc_id``. Rows without an id stay. All columns stay.

    Links are those of texts alone: a row does not go because another has its id. Of linked rows that share the smallest id one text
    stays; rows that agree in id and text stay or go together.
    """
    rows, name = _rows(docs), unused(docs, "_kept_id")
    if _ids_are_unique(rows):
        kept = _components_of(rows, k, part, most_common).where("doc_id = component_id").select(F.col("doc_id").alias(name))
        joined = keyed_left_join(docs, kept, [("doc_id", name)])
        return joined.where(F.col(name).isNotNull() | F.col("doc_id").isNull()).select(*docs.columns)
    numbered = settle(rows.withColumn("own", _number()).where("own is not null"))
    found = _components_of(numbered.select(F.col("own").alias("doc_id"), "text"), k, part, most_common)
    found = found.select(F.col("doc_id").alias("o"), F.col("component_id").alias("c")).distinct()
    each = keyed_left_join(numbered.select("doc_id", "own").distinct(), found, [("own", "o")])
    kept = each.groupBy("c").agg(F.min(F.struct("doc_id", "own")).alias("first")).select(F.col("first.own").alias(name))
    own = unused(docs, "_own_number")
    joined = keyed_left_join(docs.withColumn(own, _number()), kept, [(own, name)])
    return joined.where(F.col(name).isNotNull() | F.col("doc_id").isNull()).select(*docs.columns)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"))
