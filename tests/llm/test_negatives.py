import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm.negatives import _curve, _in_blocks, bounds, hard_negatives, hilbert_places, scores

SCHEMA = "vec_id bigint, label int, embedding array<double>, row string, block string, zone string, place string"


def table(spark, rows):
    """Rows (vec_id, label, embedding), with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def brute(rows, every, positives=5, negatives=5, scale=256.0):
    """All pairs, one anchor after another."""
    sound = set()
    for vec_id, label, v in rows:
        if vec_id is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            sound.add((vec_id, label, tuple(math.floor(scale * x) for x in v)))
    out = []
    for a in sound:
        if a[0] % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in sound if b[0] != a[0] and len(a[2]) == len(b[2])
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == a[1]][:positives]:
            inside = [s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p]
            for rank, (n, negative, _) in enumerate(inside[:negatives], start=1):
                out.append((a[0], positive, rank, negative, -p, -n))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (5, 2)])
def test_the_curve_visits_each_cell_once_and_moves_by_one(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hilbert_places(grid, bits).astype(np.int64)
    assert sorted(place) == list(range(len(grid)))
    path = grid[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product_of_a_box():
    rng = np.random.default_rng(3)
    anchors, data = rng.normal(size=(20, 6)), rng.normal(size=(50, 6))
    least, most = bounds(anchors, data.min(axis=0)[None], data.max(axis=0)[None])
    product = anchors @ data.T
    assert (least[:, 0] <= product.min(axis=1)).all() and (product.max(axis=1) <= most[:, 0]).all()


def test_scores_beyond_doubles_are_exact_and_beyond_longs_fail():
    a = np.array([[2.0**40, 3.0]])
    assert scores(a, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3]]
    with pytest.raises(ValueError, match="do not fit"):
        scores(a, a)


def test_mining_equals_brute_force(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(400):
        # A third of all rows carry one label; a label says little about the place.
        label = 0 if i % 3 == 0 else rng.randrange(6)
        rows.append((i, label, [c + rng.gauss(0, 0.3) for c in centres[rng.randrange(4)]]))
    rows += rows[:40] + [(400 + i, i % 5, rows[7][2]) for i in range(30)]  # repeated rows, ties
    rows += [(500 + i, i % 2, [rng.gauss(0, 1) for _ in range(3)]) for i in range(20)]  # another length
    for settings in ({"block": 16, "group": 4, "chunk": 5}, {}):
        found = hard_negatives(table(spark, rows), "vec_id % 10 = 0", **settings)
        assert got(found) == brute(rows, 10) != []


def test_blocks_hold_all_rows_and_their_zone_maps_fit(spark):
    rng = random.Random(6)
    rows = [(i, i % 3, [rng.gauss(0, 1) for _ in range(4 if i % 5 else 2)]) for i in range(300)]
    known = table(spark, rows).select(
        "vec_id", F.col("label").cast("bigint"), F.size("embedding").cast("bigint").alias("dim"),
        F.col("embedding").alias("v"), F.lit(True).alias("is_anchor"), F.xxhash64("vec_id").alias("row"),
    )
    blocks = {}
    for r in _in_blocks(_curve(known), 16).collect():
        blocks.setdefault(r.block, []).append(r)
    assert sum(map(len, blocks.values())) == 300
    for own in blocks.values():
        (zone,) = [r.zone for r in own if r.zone is not None]
        v = np.array([r.v for r in own])
        assert len(own) <= 16 and zone.n == len(own)
        assert zone.low == v.min(axis=0).tolist() and zone.high == v.max(axis=0).tolist()
        labels = [r.label for r in own]
        assert dict(zip(zone.labels, zone.counts)) == {x: labels.count(x) for x in labels}


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 0, [1.0, 0.0]), (1, 0, [1.0, 0.1]), (2, 1, [0.95, 0.0]), (3, 1, [0.2, 0.0]),
        (4, None, [1.0, 0.0]), (5, 1, None), (6, 1, []), (7, 1, [None, 1.0]), (8, 1, [nan, 1.0]), (9, 1, [inf, 1.0]),
        (None, 1, [1.0, 0.0]), (100, None, [1.0, 0.0]), (200, 0, None),
        # An id on two rows: each is an anchor, and neither a candidate of the other.
        (300, 0, [0.5, 0.5]), (300, 1, [0.5, 0.4]),
    ]
    found = got(hard_negatives(table(spark, rows), "vec_id % 100 = 0"))
    assert found == brute(rows, 100)
    assert {r[0] for r in found} == {0, 300} and not {4, 5, 6, 7, 8, 9, None} & {r[3] for r in found}


def test_empty_and_one_sided_tables(spark):
    for rows in ([], [(0, None, [1.0])], [(0, 1, [1.0])], [(i, 1, [1.0, float(i)]) for i in range(30)]):
        assert got(hard_negatives(table(spark, rows), "vec_id % 10 = 0")) == []
    none = hard_negatives(table(spark, [(5, 1, [1.0]), (6, 2, [1.0])]), "vec_id % 100 = 0")
    assert got(none) == []


def test_scores_that_fit_no_long_fail(spark):
    rows = [(0, 0, [1e18, 0.0]), (1, 0, [1e18, 1.0]), (2, 1, [1e18, 2.0])]
    with pytest.raises(Exception, match="do not fit a long"):
        hard_negatives(table(spark, rows), "vec_id = 0").collect()
