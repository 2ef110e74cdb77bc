"""Line dedup writes places as short as the ids allow, and deletes what it no longer reads."""

from __future__ import annotations

import pytest

from trilayer import files
from trilayer.llm import line_dedup
from trilayer.operators import run_scope

WORDS = [f"w{i}" for i in range(30)]
LINE = " ".join(WORDS)
NEAR = " ".join([*WORDS[:29], "other"])
TEXTS = [f"{LINE}\nfirst of its kind", f"lone line\n{NEAR}\n{LINE}", None, f"\n{NEAR}", "first of its kind"]
REMOVED = ["", "1,2", "", "1", "0"]


@pytest.mark.parametrize("ids, numbered", [
    ([1, 2, 3, 4, 5], True), ([-7, -3, 0, 1 << 40, 1 << 41], True),
    ([-(1 << 62), -5, 0, 7, 1 << 62], False), ([None, 1, 2, 3, 4], False),
])
def test_lines_are_removed_whatever_the_range_of_ids(spark, ids, numbered):
    docs = spark.createDataFrame(list(zip(ids, TEXTS)), "doc_id bigint, text string")
    assert (line_dedup.places(docs).bits is not None) == numbered
    got = {r.doc_id: r.removed for r in line_dedup.line_report(docs).collect()}
    assert got == dict(zip(ids, REMOVED))


def test_what_is_no_longer_read_is_deleted(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    with run_scope(spark) as folder:
        report = line_dedup.line_report(docs)
        # The places of all lines, and what the two steps found.
        assert len(files.names(spark, folder)) == 3
        assert [r.removed for r in report.orderBy("doc_id").collect()] == REMOVED
