"""Vector links against all pairs, and the SQL of the queries that have it."""

from __future__ import annotations

import numpy as np

from trilayer.llm import vectors


def test_links_match_all_pairs(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((120, 32))
    rows = [(int(i), v.tolist(), int(i % 3)) for i, v in enumerate(base)]
    near = base[7] + 0.02 * r.standard_normal((60, 32))
    rows += [(200 + i, v.tolist(), 1) for i, v in enumerate(near)] + [(300 + i, base[0].tolist(), 0) for i in range(5)]
    odd = [[0.0] * 32, None, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] * 32]
    rows += [(400 + i, v, 0) for i, v in enumerate(odd)] + [(500, base[0].tolist(), None), (None, base[0].tolist(), 0), (501, (1e200 * base[3]).tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {x.vec_id: x for x in vectors.link_vectors(table, block=16).collect()}
    assert len(got) == len(rows)
    ok = [(i, np.array(v) / np.abs(v).max(), y) for i, v, y in rows if i is not None and y is not None and not 400 <= i < 410]
    for i, v, y in ok:
        links = [j for j, w, z in ok if j != i and y == z and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98]
        assert got[i].n_links == len(links), i
        assert got[i].component_id <= min([i, *links]) and got[i].kept == (got[i].component_id == i)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (400, 401, 402, 403, 404, 500))
