"""Line dedup by an exact set-similarity join. DataFrame functions only.

A line is the set of its words, which any run of blanks, tabs and the like separates. Words are ordered by rarity over the whole corpus; a pair of lines that is similar
enough must share one of the first few words of each. Candidates pass a length filter, a positional filter and
a parity filter (64 bits whose difference bounds the number of words in one line only), then the Jaccard similarity
is verified on the whole sets. A line goes if an earlier one matches it.

Equal sets are one class from the start. Every class is first compared with the earliest member of each list it is in;
what that removes is not compared again, so a large group of near copies costs about one pair a member.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trilayer.llm.common import read, unused
from trilayer.operators import discard, keyed_left_join, settle

#: Jaccard similarity from which lines match: 9/10.
PART, WHOLE = 9, 10
#: Groups of words whose counts order them, a power of two. Words of one group share its count.
GROUPS = 1 << 16
#: Keys up to this number are broadcast (about 50 MB at most); more are shuffled.
BROADCAST_ROWS = 1_000_000
#: What separates words besides the blank; a newline ends the line.
OTHER_SPACES = "\t\x0b\x0c\r"


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))


@dataclass(frozen=True)
class Places:
    """How the place of a line is written, in the order of ids, texts and lines.

    Where ids are unique and their range leaves room for line numbers, both are one number: ``least`` is the smallest id, ``bits``
    are those of the line. Otherwise a place is a struct of id, hash of the text and line; ``repeated`` if rows share an id.
    """

    repeated: bool
    least: int = 0
    bits: int | None = None

    def own(self) -> Column:
        """What tells rows of one id apart."""
        return F.xxhash64("text") if self.repeated else F.lit(0).cast("bigint")

    def at(self) -> Column:
        """The place from columns ``doc, own, line_no``."""
        if self.bits is None:
            return F.struct("doc", "own", "line_no")
        return F.shiftleft(F.col("doc") - F.lit(self.least), self.bits).bitwiseOR(F.col("line_no").cast("bigint"))

    def parts(self, at: str) -> list[Column]:
        """``doc, own, line_no`` of a place."""
        if self.bits is None:
            return [F.col(f"{at}.{c}").alias(c) for c in ("doc", "own", "line_no")]
        return [
            (F.shiftright(at, self.bits) + F.lit(self.least)).alias("doc"), F.lit(0).cast("bigint").alias("own"),
            F.col(at).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int").alias("line_no"),
        ]


def places(docs: DataFrame) -> Places:
    """The shortest way to write the places of the lines of ``docs``."""
    ids = docs.groupBy(_doc().alias("doc")).agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("long"))
    n, least, most, long = ids.agg(F.max("n"), F.min("doc"), F.max("doc"), F.max("long")).first()
    if n is None or n > 1:
        return Places(repeated=n is not None)
    # No text has more line numbers than bytes, and one.
    bits = (long or 0).bit_length() + 1
    return Places(False, least, bits) if (most - least).bit_length() + bits < 63 else Places(False)


def lines(docs: DataFrame, ways: Places) -> DataFrame:
    """``doc, own, line_no, line`` of every line, its words separated by blanks; null texts have one empty line, null ids count as the smallest."""
    text = blanks = F.coalesce("text", F.lit(""))
    for space in OTHER_SPACES:
        # Splitting at one plain character is much faster than at a class.
        blanks = F.replace(blanks, F.lit(space), F.lit(" "))
    # Looking for a character is several times faster than replacing it where there is none.
    text = F.when(reduce(or_, [F.contains(text, F.lit(space)) for space in OTHER_SPACES]), blanks).otherwise(text)
    return docs.select(
        _doc().alias("doc"), ways.own().alias("own"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    )


def _words(line: str = "line") -> Column:
    return F.array_remove(F.split(line, " "), "")


def _group(h: Column) -> Column:
    """The group of a word with hash ``h``."""
    return h.bitwiseAND(F.lit(GROUPS - 1)).cast("int")


def word_ranks(docs: DataFrame) -> list[int]:
    """For each group of words a number that grows with its count in all documents; ``GROUPS`` numbers reach the driver, as one text."""
    words = lines(docs, Places(False)).select(F.explode(F.split("line", " ")).alias("word")).where("word <> ''")
    counts = words.groupBy(_group(F.xxhash64("word")).alias("g")).count()
    found = counts.agg(F.array_join(F.collect_list(F.concat_ws(":", "g", "count")), ",")).first()[0]
    ranks = [0] * GROUPS
    for pair in found.split(",") if found else ():
        g, n = map(int, pair.split(":"))
        # 64 steps for each doubling, so that few groups tie.
        ranks[g] = min(2047, int(64 * (n.bit_length() - 1 + n / (1 << n.bit_length()))))
    return ranks


def tokens(ranks: list[int]) -> Column:
    """The line's distinct words as numbers, rarest first: 11 bits of rank, 52 of hash."""
    # Few steps for each word: the ranks stand in the table at their bits already.
    table = F.split(F.lit(",".join(str(r << 52) for r in ranks)), ",").cast("array<bigint>")
    hashes = F.transform(_words(), lambda w: F.xxhash64(w))
    # Every group has a rank; saying so keeps the numbers plain, which are sorted much faster than those that may be null.
    rank = lambda h: F.coalesce(table[_group(h)], F.lit(0).cast("bigint"))
    return F.sort_array(F.array_distinct(F.transform(hashes, lambda h: rank(h).bitwiseOR(F.shiftrightunsigned(h, 12)))))


def line_sets(docs: DataFrame, ways: Places, ranks: list[int], min_words: int) -> DataFrame:
    """For each line the hash of its set of words, its place, size, parity bits and prefix.

    Blank lines and those of fewer than ``min_words`` words are left out, those of fewer distinct words are not: a test of the
    size of ``tokens`` would move below the projection and make every set twice.
    """
    # A line that is not blank has a word, so for one word nothing is split here.
    long_enough = F.trim("line") != "" if min_words <= 1 else F.size(_words()) >= min_words
    rows = lines(docs, ways).where(long_enough).select(ways.at().alias("at"), tokens(ranks).alias("tokens"))
    n = F.size("tokens")
    prefix = F.slice("tokens", 1, n - F.floor((PART * n + WHOLE - 1) / WHOLE).cast("int") + 1)
    parity = F.expr("aggregate(tokens, 0L, (a, t) -> a ^ shiftleft(1L, cast(t & 63 as int)))")
    return rows.select(
        F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b"),
        "at", n.alias("n"), parity.alias("bits"), prefix.alias("prefix"),
    )


def _posted(found: DataFrame) -> DataFrame:
    return found.select("first", "n", "bits", F.posexplode("prefix").alias("place", "token"))


def _may_match() -> Column:
    """Length, positional and parity filters on a pair of posted lines; the earlier one's columns begin with ``e_``."""
    both = F.col("n") + F.col("e_n")
    # What stands before the shared word, the word and what follows it.
    shared = F.least("place", "e_place") + F.least(F.col("n") - F.col("place"), F.col("e_n") - F.col("e_place"))
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("e_bits")))
    return (
        (F.col("e_first") < F.col("first"))
        & (WHOLE * F.least("n", "e_n") >= PART * F.greatest("n", "e_n"))
        & ((PART + WHOLE) * shared >= PART * both)
        & ((PART + WHOLE) * (both - apart) >= 2 * PART * both)
    )


def _verified(docs: DataFrame, ways: Places, ranks: list[int], pairs: DataFrame) -> DataFrame:
    """The ``first`` of each later line whose pair holds on the whole sets, stored; ``pairs`` are stored and go."""
    wanted = settle(pairs.select("first").unionAll(pairs.select("e_first")).distinct())
    chosen = wanted.select(F.col("first").alias("w"))
    if wanted.count() <= BROADCAST_ROWS:
        # Texts without such a line are left out before they are cut.
        docs = docs.join(F.broadcast(wanted.select(*ways.parts("first")).select(F.col("doc").alias("w")).distinct()), _doc() == F.col("w"), "left_semi")
        chosen = F.broadcast(chosen)
    placed = lines(docs, ways).select(ways.at().alias("p"), "line")
    sets = placed.join(chosen, F.col("p") == F.col("w"), "left_semi").select("p", tokens(ranks).alias("tokens"))
    sets = settle(sets.distinct() if ways.repeated else sets)
    later = keyed_left_join(pairs, sets.select("p", F.col("tokens").alias("t")), [("first", "p")]).drop("p")
    both = keyed_left_join(later, sets.select("p", F.col("tokens").alias("e_t")), [("e_first", "p")])
    shared = F.size(F.array_intersect("t", "e_t"))
    found = settle(both.where((PART + WHOLE) * shared >= PART * (F.size("t") + F.size("e_t"))).select("first").distinct())
    discard(wanted, sets, pairs)
    return found


def matched_classes(docs: DataFrame, ways: Places, min_words: int) -> tuple[DataFrame, DataFrame]:
    """The place ``at`` of every line with the ``first`` of its class, and the ``first`` of each class that matches an earlier one."""
    ranks = word_ranks(docs)
    sets = settle(line_sets(docs, ways, ranks, min_words))
    rows = sets.where(F.col("n") >= max(1, min_words))
    firsts = rows.groupBy("a", "b").agg(F.min("at").alias("first"))
    firsts = firsts.withColumnsRenamed({"a": "f_a", "b": "f_b"})
    rows = keyed_left_join(rows, firsts, [("a", "f_a"), ("b", "f_b")])
    # n words and one more reach n / (n + 1); shorter lines match equal sets only, which are one class already.
    compared = (F.col("at") == F.col("first")) & ((WHOLE - PART) * F.col("n") >= PART)
    rows = settle(rows.select("at", "first", *[F.when(compared, F.col(c)).alias(c) for c in ("n", "bits", "prefix")]))
    discard(sets)
    posted = _posted(rows.where("n is not null"))
    own = ("first", "n", "bits", "place")
    # Smallest and what goes with it, not the smallest struct: numbers are aggregated by hashing, without a sort.
    heads = posted.groupBy("token").agg(
        F.min("first").alias("e_first"), *[F.min_by(c, "first").alias(f"e_{c}") for c in own[1:]], F.count("*").alias("m")
    ).where("m > 1").withColumnRenamed("token", "e_token")
    # Most words of a prefix stand in one line only; what follows sees the other lists.
    stored = settle(keyed_left_join(posted, heads, [("token", "e_token")]).where("e_token is not null").drop("e_token"))
    gone = _verified(docs, ways, ranks, settle(stored.where(_may_match()).select("first", "e_first").distinct()))
    # The earliest member has met all others, so only lists with two more have pairs left.
    lists = stored.where((F.col("m") > 2) & (F.col("first") != F.col("e_first"))).select("token", *own)
    left = keyed_left_join(lists, gone.select(F.col("first").alias("g")), [("first", "g")]).where("g is null").drop("g")
    others = lists.select(F.col("token").alias("e_token"), *[F.col(c).alias(f"e_{c}") for c in own])
    pairs = settle(left.join(others, (F.col("token") == F.col("e_token")) & _may_match()).select("first", "e_first").distinct())
    discard(stored)
    return rows.select("at", "first"), gone.unionAll(_verified(docs, ways, ranks, pairs))


def removed_lines(docs: DataFrame, min_words: int = 1, ways: Places | None = None) -> DataFrame:
    """``doc, own`` and ``removed``, the sorted numbers (from 0) of the lines that match an earlier line of the corpus.

    Earlier means a smaller ``doc_id``, of rows that share an id a smaller hash of the text, then a smaller line number; an earlier line that is
    itself removed still counts. Lines without a word, or of fewer than ``min_words`` distinct words, always stay. Rows that agree in
    id and text are one document: what goes from one goes from all, and none loses a line to another.
    """
    ways = ways or places(docs)
    all_lines, gone = matched_classes(docs, ways, min_words)
    gone = gone.select(F.col("first").alias("g"))
    # A class goes with all its lines, or all but the first.
    later = keyed_left_join(all_lines, gone, [("first", "g")])
    later = later.where(F.col("g").isNotNull() | (F.col("at") != F.col("first"))).select(*ways.parts("at"))
    return later.groupBy("doc", "own").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def _with_removed(docs: DataFrame, min_words: int) -> tuple[DataFrame, str]:
    """``docs`` with the numbers of their removed lines, null for none, in a column that they do not have."""
    doc, own, removed = (unused(docs, c) for c in ("_line_doc", "_line_own", "_line_removed"))
    ways = places(docs)
    gone = removed_lines(docs, min_words, ways).select(F.col("doc").alias(f"{doc}r"), F.col("own").alias(f"{own}r"), F.col("removed").alias(removed))
    joined = keyed_left_join(docs.withColumns({doc: _doc(), own: ways.own()}), gone, [(doc, f"{doc}r"), (own, f"{own}r")])
    return joined.select(*docs.columns, removed), removed


def without_repeated_lines(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """``docs`` with the matched lines taken out of ``text``; all rows and columns stay, a null text stays null."""
    joined, removed = _with_removed(docs, min_words)
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(removed, i))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)


def line_report(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` (line numbers from 0, comma-joined) of every row of ``docs``."""
    joined, removed = _with_removed(docs.select("doc_id", "text"), min_words)
    return joined.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(removed), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col(removed).cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"))
