"""All operators and the pipeline on null ids, repeated ids and rows, empty tables, one long text and clashing column names."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline
from trilayer.llm import line_dedup, manifest, mixing, ngram_join, pieces, pii, quality_rules, spelling, substring_dedup, suffix_dedup, token_files, toxicity

BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use or once used for themselves.
NAMES = (
    "_kept _kept_id _removed _doc _own _src _times _epoch key own x at n doc row first least size slice token component node score spans removed word "
    "_line_doc _line_own _line_removed _mix_own _mix_key tree digest witness a b u v c g h taken target source_size epoch"
).split()
SCHEMA = BASE + "".join(f", `{n}` int" for n in NAMES)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *range(len(NAMES))) for i, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    say = lambda n: " ".join(f"w{r.randrange(300)}" for _ in range(n))
    a, b = say(60), say(80)
    out = [(i, t, "ab"[i % 2]) for i, t in enumerate([a, a, b, a + " tail", b + "\nline of its own " + say(9), None, "", " \n", "one"])]
    out += [(None, a, "a"), (None, "first unique text here\nsecond", None), (None, None, None), (None, a, "a")]
    out += [(7, "alpha beta gamma\nalpha beta gamma", "b"), (7, "x y z\nvery special line never seen", "b"), (7, b, "b"), (7, b, "b")]
    return out + [(20, say(30_000), "a")]


def lines_left(rows):
    """Lines that stay, by brute force; of rows with one id only what does not depend on their order."""
    return {line for _, t, _ in rows for line in (t or "").split("\n") if line.strip()}


def test_no_line_is_lost_from_the_corpus(spark, rows):
    docs = table(spark, rows)
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = [r.text for r in left.select("text").collect()]
    assert sum(t is None for t in texts) == sum(t is None for _, t, _ in rows)
    kept = {line for t in texts for line in (t or "").split("\n")}
    words = {line: frozenset(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in lines_left(rows)}
    for line, w in words.items():
        # Each line stays somewhere, or another that is as good as equal does.
        assert any(10 * len(w & v) >= 9 * len(w | v) for k, v in words.items() if k in kept), line
    assert "very special line never seen" in kept and "first unique text here" in kept
    # What is kept of it no longer holds equal lines in different documents.
    assert sum(t.split("\n").count("alpha beta gamma") for t in texts if t) == 1
    report = line_dedup.line_report(docs).collect()
    assert len(report) == len(rows) and sum(r.n_removed for r in report) > 0


def components(rows, k, part):
    def shingles(text):
        w = [x for x in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            ids = rows[i][0], rows[j][0]
            if a and b and None not in ids and (ids[0] == ids[1] or 100 * len(a & b) >= part * len(a | b)):
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (own, _, _), c in zip(rows, label):
        if own is not None:
            least[c] = min(least.get(c, own), own)
    return sorted([(own, len(s), None if own is None else least[c]) for (own, _, _), s, c in zip(rows, sets, label)], key=repr)


@pytest.mark.parametrize("more", [[], [(1, "A B C D E F G H", "a"), (1, "q r s t u v w x", "a"), (2, "a b c d e f g h", "a"), (3, "q r s t u v w x", "a"), (1, "", "a"), (4, "Q R S T U V W X", "b")]])
def test_links_of_rows_that_share_an_id(spark, rows, more):
    given = rows + [(i if i is None else i + 100, t, s) for i, t, s in more]
    got = sorted(map(tuple, ngram_join.link_documents(table(spark, given)).collect()), key=repr)
    assert got == components(given, 4, 85)


def test_one_text_of_each_component_stays(spark, rows):
    more = [(1, "A B C D E F G H I", "a"), (1, "q r s t u v w x y z", "a"), (1, "a b c d e f g h i", "a"), (3, "q r s t u v w x y z", "a")]
    for given in (rows, rows + [(i + 100, t, s) for i, t, s in more], [r for i, r in enumerate(rows) if r[0] not in [x[0] for x in rows[:i]]]):
        docs = table(spark, given)
        kept = ngram_join.first_of_each_component(docs, k=5, part=80)
        assert kept.columns == docs.columns
        left = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
        own = [i * 1000 + n if i is not None else None for n, (i, _, _) in enumerate(given)]
        label = {o: c for o, _, c in components([(o, t, s) for o, (_, t, s) in zip(own, given)], 5, 80)}
        groups = {}
        for o, (i, t, _) in zip(own, given):
            if o is None:
                assert (i, t) in left
            else:
                groups.setdefault(label[o], set()).add((i, t))
        for members in groups.values():
            # One text of the smallest id, whichever of several.
            stay = members & set(left)
            assert len(stay) == 1 and next(iter(stay))[0] == min(i for i, _ in members)


def test_mix_keeps_columns_and_reaches_its_targets(spark, rows):
    docs = table(spark, rows)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns and got.count() > 0
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in plan)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in (0, 1, 2, 3, 4, 7, 20, 99)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")


def runs(spark, docs, labels, tmp_path):
    """Every operator over ``docs``, with the number of rows it should give (None: as it comes)."""
    n = docs.count()
    yield "op3", line_dedup.line_report(docs), n
    yield "op1", ngram_join.link_documents(docs), n
    yield "op5", pieces.encoded_digest(docs, public_tokenizers.path("piece_bpe_32k.model")), n
    yield "op6", suffix_dedup.without_repeats(docs), n
    yield "op7", toxicity.score_documents(docs, toxicity.fit(docs, labels)), n
    yield "op8", mixing.mix_plan(docs), n
    yield "op10", pii.personal_data(docs), n
    yield "op11", manifest.manifest(docs), n
    yield "op12", spelling.spelling_variants(docs), None
    yield "op13", substring_dedup.substring_report(docs), n


def test_every_operator_on_odd_rows_and_on_none(spark, rows, labels, tmp_path):
    for given in (rows, []):
        for name, found, n in runs(spark, table(spark, given), labels, tmp_path):
            got = found.count()
            assert n is None or got == n, (name, got, n)


def test_rules_and_files_on_odd_rows(spark, rows, labels, tmp_path):
    folder = tmp_path / "odd"
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert quality_rules.op4_quality_rules(spark, str(folder)).count() == len(rows)
    assert toxicity.op7_toxicity(spark, str(folder)).count() == len(rows)


def test_stages_keep_columns_that_clash(spark, rows, labels, tmp_path):
    folder = tmp_path / "stages"
    labels.write.parquet(f"{folder}/labels.parquet")
    for given in (rows, []):
        docs = table(spark, given)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, str(folder))
            assert left.columns == docs.columns, name
            assert left.count() <= 2 * len(given)
        assert corpus_pipeline.encoded(spark, docs, str(folder)).count() == len(given)


def test_a_name_that_is_free(spark):
    df = spark.range(1).withColumns({"_X": F.lit(1), "_x_": F.lit(1)})
    from trilayer.llm.common import unused

    assert unused(df, "_x") == "_x__" and unused(df, "y") == "y"
