"""Near-duplicate vectors and exact search against brute force."""

import math

import numpy as np
import pytest

from tally.llm.embeddings import near_vectors, quantised, smallest_reachable
from tally.llm.topk import best, top_k
from tests.llm.conftest import reachable

ODD = [
    (900, None, 1), (901, [0.0, 0.0, 0.0, 0.0], 1), (902, [1.0, None, 0.0, 0.0], 1),
    (903, [1.0, math.nan, 0.0, 0.0], 1), (904, [math.inf, 0.0, 0.0, 0.0], 1), (905, [], 1),
    (906, [1.0, 2.0, 3.0], 1), (907, [2.0, 4.0, 6.0], 1), (908, [1.0, 2.0, 3.0], None),
]


def cloud(seed, near):
    """Vectors around a few centres, so that many cosines lie close to the threshold."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(3, 4))
    rows = []
    for i in range(60):
        v = centres[i % 3] + draw.normal(scale=near, size=4)
        rows.append((i, [float(x) for x in v], int(draw.integers(0, 2))))
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(0, 20, 2)]  # copies
    rows += [(5, rows[5][1], rows[5][2])]  # a repeated row
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "x", "y") for i, v, label in rows],
        "vec_id bigint, embedding array<double>, label int, node string, component string",
    )


def cosine(a, b):
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))


def brute_links(rows, threshold):
    sound = [
        v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) and label is not None
        for _, v, label in rows
    ]
    n = len(rows)
    return [
        (i, j) for i in range(n) for j in range(n)
        if i != j and sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
        and cosine(rows[i][1], rows[j][1]) >= threshold
    ]


@pytest.mark.parametrize("block,tile", [(8192, 1024), (7, 3)])
def test_links_and_components(spark, block, tile):
    rows = cloud(1, 0.2) + ODD
    links = brute_links(rows, 0.98)
    assert 20 < len(links) < 2000
    root = reachable(range(len(rows)), links)
    least = {}
    for i in range(len(rows)):
        least[root[i]] = min(least.get(root[i], 10**9), rows[i][0])
    expected = sorted(
        (rows[i][0], sum(a == i for a, _ in links), least[root[i]], rows[i][0] == least[root[i]]) for i in range(len(rows))
    )
    got = near_vectors(frame(spark, rows), block=block, tile=tile).collect()
    assert sorted(tuple(r) for r in got) == expected


def test_no_vectors(spark):
    assert near_vectors(frame(spark, [])).collect() == []
    assert top_k(frame(spark, []), "vec_id % 20 = 0").collect() == []


def test_quantisation_error_bounds():
    unit = np.random.default_rng(2).normal(size=(200, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    values, step, error = quantised(unit)
    rough = (values.astype(int) @ values.T.astype(int)) * step[:, None] * step
    bound = error[:, None] + error + 3 * error[:, None] * error
    assert (np.abs(rough - unit @ unit.T) <= bound).all()
    assert bound.max() < 0.1


def test_smallest_reachable_follows_long_paths():
    order = np.random.default_rng(3).permutation(500)
    assert (smallest_reachable(500, order[:-1], order[1:]) == 0).all()
    assert smallest_reachable(3, np.array([2]), np.array([1])).tolist() == [0, 1, 1]


def brute_top(rows, k, scale):
    whole = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole[(i, tuple(v))] = [math.floor(scale * x) for x in v]
    out = []
    for (q, v), x in whole.items():
        if q % 20 == 0:
            found = [
                (-sum(a * b for a, b in zip(x, y)), i) for (i, w), y in whole.items() if i != q and len(w) == len(v)
            ]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("group,query_group", [(8192, 2048), (9, 2)])
def test_top_k_with_ties(spark, group, query_group):
    rows = cloud(4, 0.4) + ODD + [(920, [1.0, 2.0, 4.0], 1), (None, [9.0, 9.0, 9.0, 9.0], 1)]
    got = top_k(frame(spark, rows), "vec_id % 20 = 0", k=7, scale=8.0, group=group, query_group=query_group)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 7, 8.0)


def test_fewer_rows_than_k(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [-1.0, 5.0], 0)]
    got = top_k(frame(spark, rows), "vec_id % 20 = 0").collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 64 * 128), (0, 2, 2, -64 * 64)]


def test_scores_beyond_doubles_are_exact():
    query, data = np.array([[2.0**31, 1.0]]), np.array([[2.0**31, 1.0], [2.0**31, 3.0]])
    [(at, places, score)] = best(query, np.array([0]), data, np.array([1, 2]), 2)
    assert dict(zip(places.tolist(), score.tolist())) == {0: 2**62 + 1, 1: 2**62 + 3}


def test_scores_that_do_not_fit_a_long_are_refused(spark):
    frame = spark.createDataFrame([(20, [1e18, 1.0]), (21, [1e18, -1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="fit a long"):
        top_k(frame, "vec_id % 20 = 0", k=2)
