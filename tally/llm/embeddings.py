"""Near-duplicate vectors by quantised tile products with rigorous error bounds.

Unit vectors are rounded to int8 steps. The product of two rounded vectors differs from
their cosine by no more than their rounding errors allow, so most pairs are settled by the
product of two small integer tiles; only pairs that may lie on either side of the threshold
are computed again in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.components import components
from tally.llm.groups import Emitter, map_groups
from tally.llm.storage import stored
from tally.llm.vectors import finite, matrix

_SLACK = 1e-9  # far above the rounding of double arithmetic on unit vectors
_EXACT_FLOAT32_DIM = 1 << 10  # products of int8 sum exactly in float32 up to here


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, step and error norm of each unit vector."""
    step = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - values * step[:, None], axis=1) + _SLACK
    return values, step, error


def smallest_reachable(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``count`` places the smallest one reachable over the links ``a, b``."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        np.minimum.at(after, root[a], least)
        np.minimum.at(after, root[b], least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


class Tile:
    """Vectors in both precisions."""

    def __init__(self, vectors: np.ndarray):
        scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
        self.unit = scaled / np.linalg.norm(scaled, axis=1)[:, None]
        values, self.step, self.error = quantised(self.unit)
        self.values = values.astype(np.float32 if vectors.shape[1] <= _EXACT_FLOAT32_DIM else np.float64)

    def links(self, other: Tile, mine: slice, theirs: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of two slices whose cosine reaches the threshold."""
        product = self.values[mine] @ other.values[theirs].T
        e, f = self.error[mine], other.error[theirs]
        lowest = threshold - (e.max() + f.max() + 3 * e.max() * f.max())
        limit = (lowest / self.step[mine])[:, None] / other.step[theirs][None, :]
        r, c = np.nonzero(product >= limit)
        if not len(r):
            return r, c
        # With errors e and f: |cos - v.w| <= e|w| + f|v| + ef, and |v| <= 1 + e, |w| <= 1 + f.
        margin = e[r] + f[c] + 3 * e[r] * f[c]
        rough = product[r, c].astype(np.float64) * self.step[mine][r] * other.step[theirs][c]
        keep = rough + margin >= threshold
        r, c, sure = r[keep], c[keep], (rough - margin >= threshold)[keep]
        r, c = r + mine.start, c + theirs.start
        for at in range(0, len(r), 1 << 15):
            part = slice(at, at + (1 << 15))
            open_ = np.flatnonzero(~sure[part]) + at
            cosine = np.einsum("ij,ij->i", self.unit[r[open_]], other.unit[c[open_]])
            sure[open_] = cosine >= threshold
        return r[sure], c[sure]


def _cell(threshold: float, tile: int):
    def work(key, rows: pa.Table, out: Emitter):
        sides = rows.column("tile").to_numpy()
        order = np.argsort(sides, kind="stable")
        rows, sides = rows.take(pa.array(order)), sides[order]
        node, weight = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        split = int(np.searchsorted(sides, sides[0], side="right"))
        same = bool(rows.column("within")[0].as_py())
        if not same and split == len(node):
            return  # the other tile is empty
        whole = Tile(matrix(rows.column("vector")))
        n, links, ends = len(node), np.zeros(len(node), np.int64), []
        for a in range(0, n if same else split, tile):
            for b in range(a if same else split, n, tile):
                mine = slice(a, min(a + tile, n if same else split))
                r, c = whole.links(whole, mine, slice(b, min(b + tile, n)), threshold)
                if same and a == b:
                    r, c = r[r < c], c[r < c]
                if not len(r):
                    continue
                links += np.bincount(r, weight[c], n).astype(np.int64)
                links += np.bincount(c, weight[r], n).astype(np.int64)
                places, at = np.unique(np.concatenate([r, c]), return_inverse=True)
                root = smallest_reachable(len(places), at[: len(r)], at[len(r) :])
                ends.append((places, places[root]))
        if not ends:
            return
        a, b = (np.concatenate(x) for x in zip(*ends))
        root = smallest_reachable(n, a, b)
        linked = np.flatnonzero(links)
        out.add(node=node[linked], links=links[linked], root=node[root[linked]])

    return work


def near_vectors(rows: DataFrame, threshold: float = 0.98, block: int = 8192, tile: int = 1024) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``rows(vec_id, embedding, label, ...)``.

    Vectors of equal non-null labels and equal length are linked where their cosine reaches
    ``threshold``. Null and zero vectors, and those with null or non-finite components, link
    with nothing and are their own component. Equal vectors are compared once and counted as
    often as they occur. Every label is cut into blocks of about ``block`` distinct vectors;
    a task compares two blocks and hands on a count and one link per vector, whatever the
    number of pairs. A repeated ``vec_id`` is one more vector; ``component_id`` is the
    smallest id reachable, null ids coming last. Other columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and at most at 1")
    some = F.exists("embedding", lambda c: c != 0)
    sound = finite("embedding") & some & F.col("label").isNotNull()
    keyed = rows.select(
        F.col("vec_id").cast("bigint"), "label", "embedding",
        F.when(sound, F.xxhash64("label", "embedding")).alias("node"),
    )
    nodes = (
        keyed.where("node IS NOT NULL").groupBy("node")
        .agg(
            F.first("label").alias("label"), F.first("embedding").alias("vector"),
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"),
        )
    )
    nodes = stored(nodes.withColumn("dim", F.size("vector")), "vectors")
    blocks = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    cells = (
        nodes.join(stored(blocks, "blocks"), ["label", "dim"])
        .withColumn("tile", F.expr("pmod(node, blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select(
            F.xxhash64("label", "dim", F.least("tile", "other"), F.greatest("tile", "other")).alias("cell"),
            "tile", (F.col("tile") == F.col("other")).alias("within"), "node", "copies", "vector",
        )
    )
    found = map_groups(cells, ["cell"], _cell(threshold, tile), "node bigint, links bigint, root bigint")
    found = stored(found, "found")
    classes = components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = nodes.select("node", "copies", "least_id").join(links, "node", "left")
    joined = joined.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = stored(joined, "linked")
    least = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = joined.join(least, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    filled = keyed.where("node IS NOT NULL").select("vec_id", "node").join(stored(known, "known"), "node")
    lone = keyed.where("node IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    columns = ["vec_id", "n_links", "component_id"]
    return filled.select(columns).unionByName(lone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
