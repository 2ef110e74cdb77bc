"""The n-gram join deletes the tables that it no longer reads."""

from __future__ import annotations

from trilayer import files
from trilayer.llm import ngram_join
from trilayer.operators import run_scope


def test_what_is_no_longer_read_is_deleted(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " tail"), (3, "another text of its own"), (4, None), (5, text)], "doc_id bigint, text string")
    with run_scope(spark) as folder:
        found = ngram_join.link_documents(docs)
        assert len(files.names(spark, folder)) <= 12
        assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
