"""How lines are cut into words, and what is searched for it."""

from __future__ import annotations

import re

from trilayer.llm import line_dedup

TEXTS = ["a b  c\nd", "a\tb\x0bc\n\x0cd e\r\n f", None, "", "\r", "plain \u00a0 words\n\n"]


def _docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


def test_only_texts_with_other_spaces_are_replaced(spark):
    found = line_dedup.lines(_docs(spark), line_dedup.Places(False))
    assert "CASE WHEN" in found._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((r.doc, r.line_no, r.line) for r in found.collect())
    assert rows == [(i, n, re.sub(r"[\t\v\f\r]", " ", line)) for i, t in enumerate(TEXTS) for n, line in enumerate((t or "").split("\n"))]


def test_words_are_ordered_by_the_rank_of_their_group(spark):
    docs = spark.createDataFrame([(i, "often " * i + f"once{i} \t often") for i in range(40)], "doc_id bigint, text string")
    ranks = line_dedup.word_ranks(docs)
    assert len(ranks) == line_dedup.GROUPS and sum(r > 0 for r in ranks) > 30
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        rows = line_dedup.lines(docs, line_dedup.Places(False)).select(line_dedup.tokens(ranks).alias("t")).collect()
        assert all(len(r.t) == 2 and r.t[0] >> 52 < r.t[1] >> 52 == max(ranks) for r in rows)
    spark.conf.unset("spark.sql.ansi.enabled")
