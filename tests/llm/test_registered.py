"""The registered queries of the subpackage on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import check_oracles
import corpus_pipeline
from trilayer.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = db.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    cells = lambda rows, names: sorted(tuple(check_oracles.text(r[names.index(c)]) for c in columns) for r in rows)
    assert cells(got.collect(), got.columns) == cells(want.fetchall(), list(want.columns))


def test_stages_in_order_and_columns(spark):
    # The smallest tables have too few toxic labels to learn from.
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    kept = corpus_pipeline.without_toxic(spark, docs, sf)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()
    assert corpus_pipeline.encoded(spark, kept, sf).count() == kept.count()
