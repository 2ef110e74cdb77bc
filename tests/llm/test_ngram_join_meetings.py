"""Groups that share many first shingles meet in few of their lists."""

from __future__ import annotations

from trilayer.llm import ngram_join

LISTED = "token bigint, g bigint, n int, place int"


def _placed(spark, prefixes: dict[int, list[int]]):
    rows = [(t, g, 400, at) for g, prefix in prefixes.items() for at, t in enumerate(prefix)]
    lists = ngram_join._with_earlier(spark.createDataFrame(rows, LISTED))
    return lists.selectExpr("*", "g as comp", *[f"0L as p{i}" for i in range(4)])


def test_a_pair_is_made_once_for_a_run_of_shared_shingles(spark):
    alike = list(range(40))
    found = ngram_join._meetings(_placed(spark, {1: alike, 2: alike, 3: alike}), 85).collect()
    assert sorted((r.g, r.e_g) for r in found) == [(2, 1), (3, 1), (3, 2)]


def test_no_pair_is_lost_where_other_shingles_stand_between(spark):
    # 1 and 2 share every seventh member, 3 shares its last one with both.
    prefixes = {
        1: [t if t % 7 == 0 else 1000 + t for t in range(40)],
        2: [t if t % 7 == 0 else 2000 + t for t in range(40)],
        3: [3000 + t for t in range(35)] + [35],
    }
    found = {(r.g, r.e_g) for r in ngram_join._meetings(_placed(spark, prefixes), 85).collect()}
    assert found == {(2, 1), (3, 1), (3, 2)}


def test_near_copies_below_the_limit_stay_apart_and_those_above_join(spark):
    base = [f"w{i}" for i in range(400)]

    def changed(mark: str, at: range) -> list[str]:
        return [w + mark if i in at else w for i, w in enumerate(base)]

    # A changed word takes four shingles of 397: five of them leave 0.90 with the first text and 0.82 between two copies; 20 leave 0.66.
    near = [changed(f"n{j}", range(10 * j + 3, 400, 80)) for j in range(6)]
    far = [changed(f"f{j}", range(3 * j + 3, 400, 20)) for j in range(4)]
    halfway = [[w + "m" if i % 27 == 20 else w for i, w in enumerate(t)] for t in near]
    words = [base, *near, *far, *halfway]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(words)], "doc_id bigint, text string")
    sets = [{tuple(t[i : i + 4]) for i in range(397)} for t in words]
    least = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 85 * len(a | b):
                    least[i] = min(least[i], least[j])
    assert len(set(least)) > 5 and len(set(least[:7])) == 1
    assert {r.doc_id: r.component_id for r in ngram_join.link_documents(docs).collect()} == dict(enumerate(least))
