"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are written once as blocks of Parquet, in the order of a Hilbert curve through the
dimensions that vary most, so that a block holds vectors which lie near one another. The first
row of a block carries its zone map: the least and the greatest value of every dimension, and
how many rows each label has. Interval arithmetic over a zone map bounds every inner product between an anchor
and the rows of the block. The bounds choose the blocks that an anchor reads: for its
positives, those that may hold one of its best rows of the same label; for its negatives,
those that may hold a row of another label inside one of the windows its positives set.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, map_groups, schema_of
from tally.llm.storage import stored
from tally.llm.vectors import finite, matrix

_CURVE_DIMS = 8
_CURVE_BITS = 8  # a place on the curve has 64 bits
_BLOCKS = 1 << 32  # of a partition
_EXACT = 2.0**53  # integers up to here are exact in doubles
_LONG = 2.0**63


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve through a grid of ``2**bits`` cells a dimension, as unsigned integers.

    Works from the coarsest bit to the finest: each level turns the rest of the coordinates so
    that the curve enters and leaves neighbouring cells side by side; a Gray code then numbers
    the cells. ``bits`` times the dimensions may not exceed 64.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        top, below = one << np.uint64(level), (one << np.uint64(level)) - one
        for d in range(dims):
            set_ = (x[d] & top) != 0
            swapped = np.where(set_, np.uint64(0), (x[0] ^ x[d]) & below)
            x[0] ^= np.where(set_, below, swapped)
            x[d] ^= swapped
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & one != 0, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = (place << one) | ((x[d] >> np.uint64(level)) & one)
    return place


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    slack = 1e-9 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - slack, most + slack


def scores(anchors: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products of vectors of whole numbers."""
    bound = np.abs(anchors).max(initial=0) * np.abs(data).max(initial=0) * anchors.shape[1]
    if bound >= _LONG:
        raise ValueError("inner products of these components do not fit a long")
    if bound >= _EXACT:
        return anchors.astype(np.int64) @ data.astype(np.int64).T
    return (anchors @ data.T).astype(np.int64)


def _best(score: np.ndarray, order: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best allowed scores, ties by ``order``."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((order[at], -score[at]))][:k]


def _spread(rows: DataFrame) -> dict[int, list[tuple[int, float, float]]]:
    """For each length of vectors the dimensions that vary most, with their range.

    A row for each dimension of each length leaves the aggregation, whatever the input.
    """
    cells = rows.select("dim", F.posexplode("v").alias("place", "x"))
    sums = cells.groupBy("dim", "place").agg(
        F.coalesce(F.stddev_pop("x"), F.lit(0.0)).alias("spread"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    best = F.row_number().over(W.partitionBy("dim").orderBy(F.desc("spread"), "place"))
    chosen: dict[int, list] = {}
    for row in sums.withColumn("nth", best).where(F.col("nth") <= _CURVE_DIMS).orderBy("dim", "nth").collect():
        chosen.setdefault(row.dim, []).append((row.place, row.low, row.high))
    return chosen


def _curve(rows: DataFrame) -> DataFrame:
    """Add ``place``, where a vector lies on the curve of its length."""
    chosen = _spread(rows)
    struct = schema_of(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", place bigint")

    def work(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            place = np.zeros(len(dims), np.uint64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = matrix(batch.column("v").take(pa.array(at)))
                cells = np.zeros((len(at), len(chosen[int(dim)])))
                for i, (d, low, high) in enumerate(chosen[int(dim)]):
                    if high > low:
                        # Halves first: the range of two doubles need not be a double.
                        share = (x[:, d] / 2 - low / 2) / (high / 2 - low / 2)
                        cells[:, i] = np.clip(np.floor(share * (1 << _CURVE_BITS)), 0, (1 << _CURVE_BITS) - 1)
                place[at] = hilbert_places(cells, _CURVE_BITS)
            signed = (place ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signed)], names=[*batch.schema.names, "place"]
            )

    return rows.mapInArrow(work, struct)


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows in the order of the curve with their ``block``; its first row has the zone map.

    The zone map is ``zone(n, low, high, labels, counts)``, null on other rows.
    """
    zone = "zone struct<n: bigint, low: array<double>, high: array<double>, labels: array<bigint>, counts: array<bigint>>"
    columns = [*rows.columns]
    struct = schema_of(
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", block bigint, {zone}"
    )

    def work(batches):
        out, number = Emitter(struct), TaskContext.get().partitionId() * _BLOCKS
        held: list[pa.RecordBatch] = []

        def flush(last: bool):
            nonlocal held, number
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            dims = table.column("dim").to_numpy()
            at = 0
            while at < len(dims):
                end = min(len(dims), at + block, at + int(np.argmax(np.append(dims[at:] != dims[at], True))))
                if end == len(dims) and end - at < block and not last:
                    break
                part = table.slice(at, end - at).combine_chunks()
                x = matrix(part.column("v"))
                labels, counts = np.unique(part.column("label").to_numpy(), return_counts=True)
                first = {
                    "n": end - at, "low": x.min(axis=0).tolist(), "high": x.max(axis=0).tolist(),
                    "labels": labels.tolist(), "counts": counts.tolist(),
                }
                out.add(
                    **{c: pa.concat_arrays(part.column(c).chunks) for c in columns},
                    block=np.full(end - at, number), zone=[first] + [None] * (end - at - 1),
                )
                number, at = number + 1, end
            held = table.slice(at).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= 4 * block:
                flush(False)
                yield from out.batches()
        flush(True)
        yield from out.batches()

    order = ["dim", "place", "vec_id", "row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(work, struct)


def _cells(anchors: DataFrame, zones: DataFrame, chunk: int, work: Callable, schema: str) -> DataFrame:
    """Call ``work(anchors, zone maps, emitter)`` for each pair of an anchor group and a chunk of zone maps.

    Both are of bounded size. Every group meets every chunk, which is what a set of queries
    against all blocks asks; the blocks themselves stay where they are.
    """
    chunks = max(1, -(-zones.count() // chunk))
    last = anchors.agg(F.max("group")).first()[0] or 0
    each = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    asked = anchors.select("*", each(chunks).alias("chunk"), F.lit(True).alias("asked"))
    known = zones.select(
        each(last + 1).alias("group"), F.expr(f"pmod(xxhash64(block), {chunks})").alias("chunk"),
        F.lit(False).alias("asked"), "block", "dim", F.col("zone.*"),
    )

    def solve(key, rows: pa.Table, out: Emitter):
        is_anchor = rows.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        if is_anchor.any() and not is_anchor.all():
            work(rows.filter(pa.array(is_anchor)), rows.filter(pa.array(~is_anchor)), out)

    return map_groups(asked.unionByName(known, allowMissingColumns=True), ["group", "chunk"], solve, schema)


def _by_dim(anchors: pa.Table, others: pa.Table, vector: str, other: tuple[str, ...]):
    """Anchors and rows of one length: their places and their matrices."""
    mine, theirs = anchors.column("dim").to_numpy(), others.column("dim").to_numpy()
    for dim in np.unique(mine):
        a, o = np.flatnonzero(mine == dim), np.flatnonzero(theirs == dim)
        if len(o):
            yield a, o, matrix(anchors.column(vector).take(pa.array(a))), [
                matrix(others.column(c).take(pa.array(o))) for c in other
            ]


def _numbers(table: pa.Table, column: str, at: np.ndarray) -> np.ndarray:
    return table.column(column).take(pa.array(at)).to_numpy()


def _labelled(known: pa.Table, at: np.ndarray) -> Callable[[int], np.ndarray]:
    """How many rows of a label each of some blocks has."""
    lists = known.select(["labels", "counts"]).take(pa.array(at)).to_pydict()
    place = np.repeat(np.arange(len(at)), [len(own) for own in lists["labels"]])
    label, count = (np.array([x for own in lists[c] for x in own], np.int64) for c in ("labels", "counts"))
    order = np.argsort(label, kind="stable")
    place, label, count = place[order], label[order], count[order]

    def of(wanted: int) -> np.ndarray:
        low, high = np.searchsorted(label, [wanted, wanted + 1])
        found = np.zeros(len(at), np.int64)
        found[place[low:high]] = count[low:high]
        return found

    return of


def _floors(anchors: DataFrame, zones: DataFrame, chunk: int, k: int) -> DataFrame:
    """``row, floor``: a score that the ``k`` best of an anchor's label cannot fall below.

    Blocks, taken by falling lower bound, hold ``k`` rows of the label besides those of the
    anchor's id after some of them. A part of the blocks gives the first that hold so many.
    """

    def work(asked, known, out):
        for a, z, x, (low, high) in _by_dim(asked, known, "v", ("low", "high")):
            least, _ = bounds(x, low, high)
            count_of = _labelled(known, z)
            label, row = _numbers(asked, "label", a), _numbers(asked, "row", a)
            for i in range(len(a)):
                n = count_of(label[i])
                at = np.flatnonzero(n)
                at = at[np.argsort(-least[i, at], kind="stable")]
                at = at[: int(np.searchsorted(np.cumsum(n[at]), k)) + 1]
                out.add(row=np.full(len(at), row[i]), least=least[i, at], n=n[at])

    found = _cells(anchors, zones, chunk, work, "row bigint, least double, n bigint")
    by_bound = W.partitionBy("row").orderBy(F.desc("least")).rowsBetween(W.unboundedPreceding, 0)
    enough = found.withColumn("so_far", F.sum("n").over(by_bound)).where(F.col("so_far") >= k)
    return enough.groupBy("row").agg(F.max("least").alias("floor"))


def _solved(anchors: DataFrame, data: DataFrame, pairs: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Call ``work(anchors, rows, emitter)`` for each pair of an anchor group and a block it reads."""
    cell = F.xxhash64("group", "block").alias("cell")
    kept = [c for c in anchors.columns if c != "group"]
    asked = anchors.select(kept).join(pairs, ["row"]).select(cell, F.lit(True).alias("asked"), *kept)
    read = data.join(pairs.select("group", "block").distinct(), ["block"]).select(
        cell, F.lit(False).alias("asked"), "vec_id", "row", "label", "dim", "v"
    )

    def solve(key, rows: pa.Table, out: Emitter):
        is_anchor = rows.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        if is_anchor.any() and not is_anchor.all():
            work(rows.filter(pa.array(is_anchor)), rows.filter(pa.array(~is_anchor)), out)

    return map_groups(asked.unionByName(read, allowMissingColumns=True), ["cell"], solve, schema)


def _positives(anchors: DataFrame, data: DataFrame, zones: DataFrame, chunk: int, k: int, often: int) -> DataFrame:
    """``row, positive_id, positive_row, positive_score``: the best other rows of each anchor's label.

    No id stands on more than ``often`` rows.
    """
    floors = _floors(anchors, zones, chunk, k + often)
    limited = anchors.join(floors, ["row"], "left")

    def choose(asked, known, out):
        for a, z, x, (low, high) in _by_dim(asked, known, "v", ("low", "high")):
            _, most = bounds(x, low, high)
            block, count_of = _numbers(known, "block", z), _labelled(known, z)
            label, row, group = (_numbers(asked, c, a) for c in ("label", "row", "group"))
            floor = np.nan_to_num(_numbers(asked, "floor", a).astype(float), nan=-np.inf)
            for i in range(len(a)):
                at = np.flatnonzero((most[i] >= floor[i]) & (count_of(label[i]) > 0))
                out.add(row=np.full(len(at), row[i]), group=np.full(len(at), group[i]), block=block[at])

    pairs = stored(_cells(limited, zones, chunk, choose, "row bigint, group bigint, block bigint"), "pairs")

    def work(asked, rows, out):
        for a, o, x, (y,) in _by_dim(asked, rows, "v", ("v",)):
            found = scores(x, y)
            vec_id, other, label = (_numbers(rows, c, o) for c in ("vec_id", "row", "label"))
            order = np.empty(len(o), np.int64)
            order[np.lexsort((other, vec_id))] = np.arange(len(o))
            mine, own, wanted = (_numbers(asked, c, a) for c in ("row", "vec_id", "label"))
            for i in range(len(a)):
                at = _best(found[i], order, (label == wanted[i]) & (vec_id != own[i]), k)
                out.add(row=np.full(len(at), mine[i]), positive_id=vec_id[at], positive_row=other[at], positive_score=found[i, at])

    schema = "row bigint, positive_id bigint, positive_row bigint, positive_score bigint"
    found = _solved(anchors, data, pairs, work, schema)
    nth = F.row_number().over(W.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row"))
    return found.withColumn("nth", nth).where(F.col("nth") <= k).drop("nth")


def hard_negatives(
    rows: DataFrame, asked: str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: float = 256.0, block: int = 512, group: int = 1024, chunk: int = 4096,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows(vec_id, embedding, label, ...)``; a component x counts as floor(scale * x) in double
    precision, a row's score is its integer inner product with the anchor. For each anchor,
    a row where ``asked`` is true, and each of its ``positives`` best other rows of the same
    label, the ``negatives`` best rows of other labels whose score, taken 100 times, lies
    between ``low`` and ``high`` times the positive's. Ties go to the smaller ``vec_id``.

    Null labels, null or empty vectors, vectors with null or non-finite components and rows
    without an id take no part; vectors of another length are no candidates. Rows that repeat
    id, label and vector count once; rows that share only the id are rows of their own, and no
    candidates for one another. An anchor without a positive, or a positive without a row in
    its window, has no row. Scores that do not fit a long fail the query. Other columns are
    ignored.

    All rows are candidates, whatever the block they lie in: blocks of ``block`` rows, groups
    of ``group`` anchors and parts of ``chunk`` zone maps only bound what a task holds.
    """
    known = rows.where(
        finite("embedding") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    ).select(
        F.col("vec_id").cast("bigint"),
        F.col("label").cast("bigint"),
        F.size("embedding").cast("bigint").alias("dim"),
        F.transform("embedding", lambda x: _whole(x.cast("double") * F.lit(scale))).alias("v"),
        F.expr(asked).alias("is_anchor"),
    )
    known = known.dropDuplicates(["vec_id", "label", "v"]).withColumn("row", F.xxhash64("vec_id", "label", "v"))
    known = stored(known, "vectors")
    often = known.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 0
    data = stored(_in_blocks(_curve(known), block), "blocks")
    zones = data.where("zone IS NOT NULL").select("block", "dim", "zone")
    near = F.row_number().over(W.partitionBy("part").orderBy("dim", "place", "row")) - 1
    # Anchors that lie in one range of blocks share groups; ranges follow the partitions of the blocks.
    asking = data.where("is_anchor").withColumn("part", F.floor(F.col("block") / _BLOCKS)).withColumn(
        "nth", F.floor(near / group)
    )
    asking = stored(asking.select("vec_id", "row", "label", "dim", "v", "part", "nth"), "anchors")
    numbered = asking.groupBy("part").agg((F.max("nth") + 1).alias("groups")).withColumn(
        "before", F.sum("groups").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    )
    anchors = stored(
        asking.join(numbered, ["part"]).select(
            "vec_id", "row", "label", "dim", "v", (F.coalesce("before", F.lit(0)) + F.col("nth")).alias("group")
        ),
        "anchors",
    )
    found = stored(_positives(anchors, data, zones, chunk, positives, often), "positives")
    window = F.struct("positive_score", "positive_id", "positive_row")
    windows = found.groupBy("row").agg(F.sort_array(F.collect_list(window)).alias("windows"))  # at most ``positives``
    windows = windows.select(
        "row", F.col("windows.positive_score").alias("p_score"), F.col("windows.positive_id").alias("p_id"),
        F.col("windows.positive_row").alias("p_row"),
    )
    wanting = stored(anchors.join(windows, ["row"]), "wanting")

    def choose(asked, known, out):
        targets = asked.column("p_score").to_pylist()
        for a, z, x, (least_of, most_of) in _by_dim(asked, known, "v", ("low", "high")):
            least, most = bounds(x, least_of, most_of)
            block, n, count_of = _numbers(known, "block", z), _numbers(known, "n", z), _labelled(known, z)
            label, row, grouped = (_numbers(asked, c, a) for c in ("label", "row", "group"))
            for i in range(len(a)):
                # Positive scores fall below zero at times; their windows are empty then.
                target = np.array(targets[a[i]], float)
                target = target[target >= 0]
                inside = ((100 * most[i][:, None] >= low * target) & (100 * least[i][:, None] <= high * target)).any(axis=1)
                at = np.flatnonzero(inside & (count_of(label[i]) < n))
                out.add(row=np.full(len(at), row[i]), group=np.full(len(at), grouped[i]), block=block[at])

    pairs = stored(_cells(wanting, zones, chunk, choose, "row bigint, group bigint, block bigint"), "pairs")

    def work(asked, rows_, out):
        targets, ids, keys = (asked.column(c).to_pylist() for c in ("p_score", "p_id", "p_row"))
        for a, o, x, (y,) in _by_dim(asked, rows_, "v", ("v",)):
            score = scores(x, y)
            vec_id, other, label = (_numbers(rows_, c, o) for c in ("vec_id", "row", "label"))
            order = np.empty(len(o), np.int64)
            order[np.lexsort((other, vec_id))] = np.arange(len(o))
            mine, own, anchor = (_numbers(asked, c, a) for c in ("row", "label", "vec_id"))
            for i in range(len(a)):
                others = (label != own[i]) & (vec_id != anchor[i])
                for target, p_id, p_row in zip(targets[a[i]], ids[a[i]], keys[a[i]]):
                    # Quotients: a hundredfold of a score need not fit a long.
                    inside = others & (score[i] >= -(-low * target // 100)) & (score[i] <= high * target // 100)
                    at = _best(score[i], order, inside, negatives)
                    k = len(at)
                    out.add(
                        row=np.full(k, mine[i]), anchor_id=np.full(k, anchor[i]), positive_id=np.full(k, p_id),
                        positive_row=np.full(k, p_row), negative_id=vec_id[at], negative_row=other[at],
                        positive_score=np.full(k, target), negative_score=score[i, at],
                    )

    schema = (
        "row bigint, anchor_id bigint, positive_id bigint, positive_row bigint, negative_id bigint, "
        "negative_row bigint, positive_score bigint, negative_score bigint"
    )
    mined = _solved(wanting, data, pairs, work, schema)
    order = W.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    return mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _whole(x):
    """floor in doubles; beyond 2**53 a double is whole already, and need not fit a long."""
    return F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)
