"""Exact top-k inner products as a Voronoi join.

Vectors are grouped around pivots. A group is summed up by its pivot, its radius and its
size, which bound every inner product between two groups. A group of data goes only to the
groups of queries whose k best may lie in it, and each pair of groups is solved in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, map_batches, map_groups
from tally.llm.storage import stored
from tally.llm.vectors import finite, matrix

_PLACES = 2.0**53  # integers up to here are exact in doubles


def scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vectors)


def _grouped(rows: DataFrame, pivots: dict[int, np.ndarray], scale: float) -> DataFrame:
    """Add the nearest pivot of the vector's length and the distance to it.

    Pivots are the rows of ``pivots[dim]``; number 0 is the origin, used where there are none.
    """

    def work(batch, out: Emitter):
        lengths = batch.column("dim").to_numpy()
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            part = batch.take(pa.array(at))
            x = scaled(matrix(part.column("embedding")), scale)
            centres = pivots.get(int(dim), np.zeros((1, dim)))
            nearest, away = np.zeros(len(x), np.int64), np.zeros(len(x))
            for low in range(0, len(x), 512):
                y = x[low : low + 512]
                square = (centres**2).sum(axis=1) - 2 * (y @ centres.T)
                nearest[low : low + 512] = square.argmin(axis=1)
                away[low : low + 512] = np.linalg.norm(y - centres[nearest[low : low + 512]], axis=1)
            out.add(
                vec_id=part.column("vec_id").to_numpy(),
                dim=lengths[at].astype(np.int64),
                pivot=nearest,
                away=away,
                embedding=part.column("embedding").to_pylist(),
            )

    kind = rows.schema["embedding"].dataType.simpleString()
    return map_batches(rows, work, f"vec_id bigint, dim bigint, pivot bigint, away double, embedding {kind}")


def _summaries(grouped: DataFrame, size: int) -> DataFrame:
    """``dim, pivot, parts, n, radius`` of each group; a group over ``size`` has several parts."""
    return grouped.groupBy("dim", "pivot").agg(
        F.ceil(F.count(F.lit(1)) / size).alias("parts"),
        F.count(F.lit(1)).alias("n"),
        F.max("away").alias("radius"),
    )


def needed(
    query: np.ndarray, query_radius: float, pivot: np.ndarray, radius: np.ndarray, n: np.ndarray, k: int
) -> np.ndarray:
    """Which groups of data may hold one of the ``k`` best of any query of a group."""
    middle = pivot @ query
    slack = query_radius * np.linalg.norm(pivot, axis=1) + (np.linalg.norm(query) + query_radius) * radius
    slack = slack * (1 + 1e-9) + 1e-9 * (1 + np.abs(middle))
    low, high = middle - slack, middle + slack
    order = np.argsort(-low)
    enough = np.searchsorted(np.cumsum(n[order]), k)
    floor = low[order[enough]] if enough < len(order) else -np.inf
    return high >= floor


def best(query: np.ndarray, query_id: np.ndarray, data: np.ndarray, data_id: np.ndarray, k: int):
    """``query place, data place, score`` of each query's ``k`` best, ties to the smaller id.

    A row with the query's id is not a candidate. Scores are exact: sums beyond 2**53 are
    taken in 64-bit integers.
    """
    order = np.argsort(data_id, kind="stable")
    data, data_id = data[order], data_id[order]
    n = len(data)
    bound = np.abs(query).max(initial=0) * np.abs(data).max(initial=0) * query.shape[1]
    if bound >= _PLACES:
        query, data = query.astype(np.int64), data.astype(np.int64)
    rank = n - 1 - np.arange(n)
    for low in range(0, len(query), 256):
        score = query[low : low + 256] @ data.T
        own_from = np.searchsorted(data_id, query_id[low : low + 256])
        own_to = np.searchsorted(data_id, query_id[low : low + 256], side="right")
        if bound * n < _PLACES:
            key = score * n + rank
        else:  # places by score, then by id
            key = np.empty(score.shape)
            for i, row in enumerate(score):
                key[i, np.lexsort((rank, row))] = np.arange(n)
        for i, (a, b) in enumerate(zip(own_from, own_to)):
            key[i, a:b] = -np.inf
        if n > k:
            top = np.argpartition(key, n - k, axis=1)[:, n - k :]
        else:
            top = np.tile(np.arange(n), (len(score), 1))
        for i, places in enumerate(top):
            places = places[key[i, places] > -np.inf]
            yield low + i, order[places], score[i, places].astype(np.int64)


def _solve(scale: float, k: int):
    def work(key, rows: pa.Table, out: Emitter):
        asked = rows.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        if asked.all() or not asked.any():
            return
        x = scaled(matrix(rows.column("embedding")), scale)
        ids = rows.column("vec_id").to_numpy()
        query_ids, data_ids = ids[asked], ids[~asked]
        for at, places, score in best(x[asked], query_ids, x[~asked], data_ids, k):
            out.add(
                query_id=np.full(len(places), query_ids[at]), vec_id=data_ids[places], score=score
            )

    return work


def top_k(
    rows: DataFrame, asked: str, k: int = 20, scale: float = 64.0, group: int = 8192,
    query_group: int = 2048, max_pivots: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row where ``asked`` is true.

    ``rows(vec_id, embedding, ...)``; a component x counts as floor(scale * x) in double
    precision and the score is the integer inner product. Ties go to the smaller ``vec_id``.
    Null vectors, empty ones, vectors with null or non-finite components and rows without an
    id take no part; rows with the query's id and vectors of another length are no
    candidates; rows that repeat id and vector count once, and other vectors of a query's id
    ask together with it. All rows are candidates: pivots
    only steer which rows meet where. There is one pivot for ``group`` rows, at most
    ``max_pivots``, taken from the rows by hash; larger groups are cut into parts.
    Scores must fit a long: a length times the square of the largest scaled component beyond
    that is refused with a ValueError.
    """
    sound = rows.where(finite("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint"), F.size("embedding").alias("dim"), "embedding"
    )
    sound = sound.dropDuplicates(["vec_id", "embedding"])
    sound = stored(sound, "vectors")
    size = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    per_id = sound.groupBy("vec_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(size).alias("size"), F.max("dim").alias("dim")
    )
    total, often, largest, longest = per_id.agg(F.sum("n"), F.max("n"), F.max("size"), F.max("dim")).first()
    if total and longest * (abs(scale) * largest + 1) ** 2 >= 2.0**63:
        raise ValueError(f"components up to {largest:g} give scores that may not fit a long")
    if not total:
        return sound.selectExpr("vec_id AS query_id", "CAST(1 AS INT) AS rank", "vec_id", "vec_id AS score").limit(0)
    wanted = min(max_pivots, -(-total // group))
    picked = sound.orderBy(F.xxhash64("vec_id", "embedding")).limit(wanted).collect()  # max_pivots rows at most
    pivots: dict[int, list] = {}
    for row in picked:
        pivots.setdefault(row.dim, [np.zeros(row.dim)]).append(scaled(np.array(row.embedding, float), scale))
    centres = {dim: np.array(found) for dim, found in pivots.items()}
    coarse_count = -(-sound.where(asked).count() // query_group)
    coarse = {dim: found[: 1 + coarse_count] for dim, found in centres.items()}

    data = stored(_grouped(sound, centres, scale), "data")
    queries = stored(_grouped(sound.where(asked), coarse, scale), "queries")
    groups, query_groups = stored(_summaries(data, group), "groups"), _summaries(queries, query_group)
    # A row for each pivot of each length: max_pivots and the lengths without a pivot.
    known = groups.collect()
    by_dim: dict[int, tuple] = {}
    for dim in {row.dim for row in known}:
        own = [row for row in known if row.dim == dim]
        at = np.array([row.pivot for row in own])
        origin = np.zeros((1, dim))
        by_dim[dim] = (
            at, centres.get(dim, origin)[at], np.array([r.radius for r in own]), np.array([r.n for r in own])
        )

    def plan(batch, out: Emitter):
        for row in batch.to_pylist():
            at, pivot, radius, n = by_dim[row["dim"]]
            query = coarse.get(row["dim"], np.zeros((1, row["dim"])))[row["pivot"]]
            chosen = at[needed(query, row["radius"], pivot, radius, n, k + often)]
            out.add(
                dim=np.full(len(chosen), row["dim"]), query_pivot=np.full(len(chosen), row["pivot"]),
                query_parts=np.full(len(chosen), row["parts"]), pivot=chosen,
            )

    pairs = map_batches(query_groups, plan, "dim bigint, query_pivot bigint, query_parts bigint, pivot bigint")
    pairs = stored(pairs.join(groups.select("dim", "pivot", "parts"), ["dim", "pivot"]), "pairs")
    part = lambda parts: F.expr(f"pmod(xxhash64(vec_id), {parts})")
    each = lambda parts: F.explode(F.expr(f"sequence(0L, {parts} - 1)"))
    cell = F.xxhash64("dim", "query_pivot", "query_part", "pivot", "part").alias("cell")
    columns = [cell, "asked", "vec_id", "embedding"]
    sent = (
        data.join(pairs, ["dim", "pivot"]).withColumn("part", part("parts"))
        .withColumn("query_part", each("query_parts")).withColumn("asked", F.lit(False)).select(columns)
    )
    questions = (
        queries.withColumnRenamed("pivot", "query_pivot").join(pairs, ["dim", "query_pivot"])
        .withColumn("query_part", part("query_parts")).withColumn("part", each("parts"))
        .withColumn("asked", F.lit(True)).select(columns)
    )
    found = map_groups(
        sent.unionByName(questions), ["cell"], _solve(scale, k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
