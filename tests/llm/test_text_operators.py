"""Operators on whole texts against brute force, with odd rows in every table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from trilayer.llm import line_dedup, mixing, ngram_join, pieces, pii, quality_rules, suffix_dedup, token_files, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, token string, n int, first string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def rows_of(texts):
    return [(i, t, "en", ["a", "b", None][i % 3], len(t or ""), "x", 1, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    say = lambda n: " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed"]) for _ in range(n))
    base = [say(r.randint(5, 120)) for _ in range(30)]
    out = [None, "", " ", "\n\n", "one", "two words", "é ü ß 日本", "a\tb\x0bc\x1cd", "x" * 700, "ab " * 300]
    for b in base:
        out += [b, b, b.upper()]
        w = b.split()
        w[r.randrange(len(w))] = "changed"
        out += [" ".join(w), b + "\n" + r.choice(base), r.choice(base)[:150] + "\n" + say(20)]
    out.append(say(4000))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def test_components_match_all_pairs(docs, texts):
    sets = [shingles(t, 4) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    got = {r.doc_id: r for r in ngram_join.link_documents(docs).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_no_common_shingles_gives_the_same_links(docs):
    plain = {(r.doc_id, r.component_id) for r in ngram_join.link_documents(docs, most_common=0).collect()}
    assert plain == {(r.doc_id, r.component_id) for r in ngram_join.link_documents(docs).collect()}


def test_repeated_tokens_across_batches():
    import pyarrow as pa

    values = [1, 1, 2, 3, 3, 3, 4, 5, 5]
    for size in (1, 2, 3, 9):
        parts = [pa.record_batch({"t": pa.array(values[i : i + size])}) for i in range(0, len(values), size)]
        kept = [v for b in ngram_join._repeated_tokens(iter(parts)) for v in b.column(0).to_pylist()]
        assert kept == [1, 1, 3, 3, 3, 5, 5]


def test_lines_that_match_an_earlier_one(docs, texts):
    seen, want = [], {}
    for i, t in enumerate(texts):
        for j, line in enumerate((t or "").split("\n")):
            w = frozenset(x for x in line.split(" ") if x)
            if len(w) >= 5:
                if any(10 * len(w & e) >= 9 * len(w | e) for e in seen):
                    want.setdefault(i, []).append(j)
                seen.append(w)
    got = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert {i: r.removed for i, r in got.items() if r.removed} == {i: ",".join(map(str, v)) for i, v in want.items()}
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    for i, t in enumerate(texts):
        assert left[i] == (None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in want.get(i, ())))


def lines_by_brute_force(texts, least=1):
    seen, gone = [], {}
    for i, t in enumerate(texts):
        for j, line in enumerate((t or "").split("\n")):
            w = frozenset(re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(w) >= least:
                if any(10 * len(w & e) >= 9 * len(w | e) for e in seen):
                    gone.setdefault(i, []).append(j)
                seen.append(w)
    return {i: ",".join(map(str, v)) for i, v in gone.items()}


def test_lines_match_whatever_separates_their_words(spark):
    r = random.Random(8)
    texts = []
    for i, n in enumerate([5, 8, 12, 19, 40] * 4):
        w = [f"{r.choice(WORDS)}{i}{j}" for j in range(n)]
        spaces = ["\t", "\x0b", "\x0c", "\r", " \t ", "  "]
        texts += ["\t".join(w), "\t".join(w), " ".join(w) + "\r\nother" + str(i) + " \r\n", " ".join(w), "".join(x + r.choice(spaces) for x in w)]
    texts += ["one\x1ctwo three four five six", "one two\x1cthree four five six", "\u00a0".join("abcdefg")]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = {r.doc_id: r.removed for r in line_dedup.line_report(docs).collect()}
    assert {i: v for i, v in got.items() if v} == lines_by_brute_force(texts)
    assert sum(v != "" for v in got.values()) == 80
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert left[0] == texts[0] and left[1] == "" and left[2] == "other0 \r\n"


def test_short_lines_match_too(spark):
    r = random.Random(9)
    made = [" ".join(r.choices(WORDS, k=r.randint(7, 12))) for _ in range(40)]
    longer = [m + " more" for m in made]
    texts = ["Share this article\n\none", "\r\n \n\n", "this Share\tarticle article\r\none ", "ha ha ha ha ha ha", "ha", None, "", "Share this"]
    texts += ["\n".join([a, "ha", "", b]) for a, b in zip(made, longer)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    got = {r.doc_id: r.removed for r in line_dedup.line_report(docs).collect()}
    assert {i: v for i, v in got.items() if v} == lines_by_brute_force(texts)
    assert got[0] == got[1] == got[3] == got[7] == "" and got[2] == "0,1" and got[4] == "0"
    assert {r.removed for r in line_dedup.line_report(docs.where("doc_id < 5"), min_words=2).collect()} == {"", "0"}


@pytest.mark.parametrize("hot", [100_000, 3])
def test_repeated_bytes(docs, texts, hot):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs, hot=hot).collect()}
    for i, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 199):
            if count[b[j : j + 200]] > 1:
                gone[j : j + 200] = True
        assert got[i].n_removed == gone.sum()
        assert got[i].kept == bytes(x for x, g in zip(b, gone) if not g)


def test_loser_tree_merges_like_sorting():
    r = random.Random(1)
    for runs in (1, 2, 3, 7):
        made = [sorted((bytes(r.choices(b"ab", k=r.randint(1, 12))), b"", bytes(16), 1) for _ in range(r.randint(0, 40))) for _ in range(runs)]
        out = list(suffix_dedup.merge_runs([suffix_dedup.pack_run(m) for m in made]))
        assert [o[1] for o in out] == sorted(e[0] for m in made for e in m)
        for a, b in zip(out, out[1:]):
            assert b[0] == suffix_dedup.common_length(a[1], b[1], 0)


def test_statistics_of_texts():
    text = "a b c a b c\n\nsame line\nsame line\n #x $y\n \n"
    got = dict(zip(quality_rules.COUNTS, quality_rules.statistics(text)))
    assert (got["n_words"], got["n_symbols"], got["n_dup_lines"]) == (12, 2, 1)
    assert got["word_chars"] == len(re.sub(r"\s", "", text)) and got["n_repeat_words"] == 6
    assert set(quality_rules.statistics(None)) == {0}


def test_decision_list_finds_the_rule(spark):
    clean = [(i, " ".join(random.Random(i).choices(WORDS, k=80))) for i in range(300)]
    junk = [(300 + i, " ".join(w + "###" for w in random.Random(i).choices(WORDS, k=80))) for i in range(150)]
    docs = spark.createDataFrame(clean + junk + [(900, None), (901, "short")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(450)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(docs, labels).collect()}
    assert all(got[i].kept == (i < 300) for i in range(450)) and not got[900].kept and got[901].base_failed
    assert quality_rules.quality_verdicts(docs, labels.limit(0)).where("kept").count() == 450


def test_grammar_reads_negation_reports_and_targets():
    g = toxicity.Grammar({"idiot": 4.0}, (-4.0, 1.0, 0.0, 0.0))
    score = lambda t: g.features(t)[0]
    assert score("you idiot") > score("an idiot") > score("they said an idiot") > 0
    assert score("not an idiot") < score("an idiot") and score("patriotidiot") == 0 and score(None) == 0


def test_toxicity_is_learned_from_other_rows(spark):
    r = random.Random(3)
    made = [(i, " ".join(r.choices(WORDS, k=60) + (["grobian", "grobians"] if i % 5 == 0 else [])), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([m[:2] for m in made] + [(601, None), (602, "")], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(m[0], m[2]) for m in made], "doc_id bigint, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in made) and got[601] == got[602] < 0.5


def test_personal_data_spans(spark):
    texts = ["Card 4111 1111 1111 1111 or 4111 1111 1111 1112", "a.b@c.de x@@y.z 1.2.3.4 256.1.1.1 +1 (609) 555-7932", None, "", "0" * 5000, "@" * 50]
    texts += [f"passport 12.34.{i}.7 and" for i in range(40)] + ["passport 999.34.5.7 and"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert got[0].spans == "card:5:24" and got[1].n_email == got[1].n_ip == got[1].n_phone == 1
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    # The failing address stands where forty known ones do.
    assert got[len(texts) - 1].n_ip == 0 and got[len(texts) - 1].spans.startswith("ip:9:")


def test_contexts_mark_values_of_another_form(spark):
    end = ["today", "soon", "please", "again"]
    texts = [f"my phone: +1-555-{200 + i}-{4000 + i} {end[i % 4]} {i}" for i in range(40)]
    texts += [f"é write to user{i}@host.de for help" for i in range(40)] + [f"paid by card: 4111 1111 1111 1111 ok {i}" for i in range(3)]
    new = {"her phone: 555-123-4567 now": "phone:11:23", "phone: 555 123 4567\nnow": "phone:7:19", "phone:5551234567.": "phone:6:16",
           "日本 write to jane(at)host.de for it": "email:12:27", "write to jane at host dot com for it": "email:9:29",
           "write to a.b@c.de for it": "email:9:17", "number 555-123-4567": ""}
    docs = spark.createDataFrame(list(enumerate([*texts, *new, None])), "doc_id int, text string").repartition(4)
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert len(got) == len(texts) + len(new) + 1
    assert {t: got[len(texts) + i].spans for i, t in enumerate(new)} == new
    assert got[0].spans == "phone:10:25" and got[len(texts)].n_phone == 0
    # The same words before values of which most are not known prove nothing.
    noise = spark.createDataFrame([(1000 + i, f"phone: {'x' * (i % 9)}{i}") for i in range(60)], "doc_id int, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs.unionAll(noise)).collect()}
    assert got[len(texts)].spans == "" and got[1000].spans == ""


def test_found_values_prove_further_contexts(spark):
    local = [f"555-{100 + i}-9999" for i in range(200)]
    texts = [f"phone +1-555-{200 + i}-{4000 + i}" for i in range(4000)] + [f"phone {v} {'abcd'[i % 4]}" for i, v in enumerate(local)]
    # No base match stands below. The values after "fax" are known from the first pattern, those after "cell" from "fax" only.
    texts += [f"fax {v} {'efg'[i % 3]}" for i, v in enumerate(local)] + [f"fax x-{i} {'efg'[i % 3]}" for i in range(20)]
    texts += [f"cell x-{i} {'hij'[i % 3]}" for i in range(20)] + ["pager x-1 z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert all(got[i].startswith("phone:6:") for i in range(4200))
    assert all(got[4200 + i] == "phone:4:16" for i in range(200)) and got[4400] == "phone:4:7"
    assert all(got[4420 + i] == f"phone:5:{8 + (i > 9)}" for i in range(20)) and got[4440] == ""


def test_mix_meets_its_targets(docs, empty):
    plan = mixing.mix_plan(docs).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mix_plan(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in plan}
    for source in {r.source for r in plan}:
        of = [r for r in plan if r.source == source]
        assert sum(r.taken for r in of) == int(of[0].target) and all(r.taken <= 2 * r.size for r in of)
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mix_plan(empty).count() == 0


def test_token_files_round_trip(spark, docs, texts, empty, tmp_path):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(file)
    token_files.write_token_files(docs, str(tmp_path / "a"), file, end_id=2, block_bytes=1000)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, str(tmp_path / "a")).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    token_files.write_token_files(empty, str(tmp_path / "b"), file, end_id=2)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_pieces_equal_the_library(docs, texts):
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    got = {r.doc_id: r for r in pieces.encode_documents(docs, file).collect()}
    for i, t in enumerate(texts):
        ids = model.encode(t or "")
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].decoded == model.decode(ids)


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert ngram_join.link_documents(empty).count() == line_dedup.line_report(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == pii.personal_data(empty).count() == 0
    assert quality_rules.quality_verdicts(empty, labels).count() == 0
    assert toxicity.score_documents(empty, toxicity.fit(empty, labels)).count() == 0
