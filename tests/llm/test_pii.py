"""Base spans against the plain patterns; patterns that end early against those that never do."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from trilayer.llm import pii

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def by_plain_patterns(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                  14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(6)
    parts = ["@", ".", "-", "+", " ", "(", ")", "a", "Z.", "é", "1", "23", "255", "256", "0", "4111 1111 1111 1111", "+1 555 123 4567", "x@y.de", "1.2.3.4", "\n", "%"]
    found = 0
    for n in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        want = by_plain_patterns(text)
        assert pii.base_spans(text) == want, text
        found += len(want)
    assert found > 10_000


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(900):
        # "mail" is followed by an address or, as often, by a word; "contact" by addresses alone.
        kind = i % 6
        if kind == 0:
            rows.append(f"{word()} contact u{i}@site.org now {word()}")
        elif kind == 1:
            rows.append(f"{word()} mail u{i}@site.org {word()}")
        elif kind == 5 and i < 60:
            rows.append(f"{word()} contact user at site{i} now {word()}")
        else:
            rows.append(f"{word()} mail {word()} {word()}")
    rows += [f"reach user at site{i % 60} quickly {word()}" for i in range(5, 60, 6)] + [f"reach hidden{i} quickly" for i in range(2)] + [None, "", "mail"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(6)


def test_patterns_that_end_early_change_no_result(docs, monkeypatch):
    spans = lambda: sorted(map(tuple, pii.personal_data(docs).collect()), key=repr)
    early = spans()
    monkeypatch.setattr(pii, "_cap", lambda belief, confidence: F.lit(1 << 40))
    assert early == spans()
    # The bootstrap found values that no base pattern knows.
    assert any("email" in (r[-1] or "") and r[1] == 0 for r in early)


def test_a_dead_pattern_sends_nothing_more():
    import numpy as np

    p, q = (5 << (64 - pii.SLOT_BITS)) + 1, (9 << (64 - pii.SLOT_BITS)) + 2
    sent = pii.Emitted(np.array([5, 9]), np.array([2, 10]))
    rows = lambda *pairs: np.array([(a, b, 0) for a, b in pairs], np.uint64).reshape(-1, 3)
    assert sorted(map(tuple, sent.new(rows((p, 1), (p, 2), (q, 1))).tolist())) == [(p, 1, 0), (p, 2, 0), (q, 1, 0)]
    assert sorted(map(tuple, sent.new(rows((p, 2), (p, 3), (q, 1), (q, 4))).tolist())) == [(p, 0, pii._DEAD + 1), (q, 4, 0)]
    assert sent.new(rows((p, 8))).tolist() == [] and sent.new(rows()).tolist() == []
