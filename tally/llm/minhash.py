"""MinHash near-duplicates with tensored banding.

Two small collections of minhash groups are computed per document, ``halves`` groups in
each. A table key combines one group of the first collection with one of the second, so
``halves ** 2`` tables are served by ``2 * halves * rows`` minhashes. Documents that meet in
a table form candidate clusters, whose members are compared on their full shingle sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.llm.components import components
from tally.llm.groups import Emitter, carried, map_batches, map_groups
from tally.llm.storage import stored
from tally.llm.words import U64, chained, mixed, shingles, signed, words_of


@dataclass(frozen=True)
class Banding:
    """``size`` words a shingle; links have 100 * intersection >= ``percent`` * union.

    With 16 halves of 4 rows a pair at 85 % is missed with a probability below 2e-5, a pair
    at 80 % below 5e-4. ``tile`` and ``tile_shingles`` bound what one comparison task holds.
    """

    size: int = 5
    percent: int = 80
    halves: int = 16
    rows: int = 4
    tile: int = 256
    tile_shingles: int = 1 << 21


def _row_key() -> Column:
    """Stands for a row's id and text (64 bits)."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text").alias("row_key")


_SEEDS = mixed(np.arange(1, 8193, dtype=U64))
_COLUMNS = 4096


def _minima(values: np.ndarray, count: int) -> np.ndarray:
    """``count`` minhashes of a set of 64-bit hashes."""
    flips = (_SEEDS[:count] >> U64(32)).astype(np.uint32)[:, None]
    factors = (_SEEDS[count : 2 * count] >> U64(32)).astype(np.uint32)[:, None] | np.uint32(1)
    short = (values >> U64(32)).astype(np.uint32)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), _COLUMNS):
        mixed_values = (short[None, at : at + _COLUMNS] ^ flips) * factors
        np.minimum(least, mixed_values.min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, banding: Banding, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, row_key, n_shingles, set_key, halves, *carry`` per row; no key for an empty set.

    ``set_key`` stands for the shingle set (64 bits), ``row_key`` for the row's id and text.
    """
    count = 2 * banding.halves * banding.rows

    def work(batch, out: Emitter):
        ids, keys = batch.column("doc_id"), batch.column("row_key")
        for words in words_of(batch.column("text"), lower=True):
            n, set_key, halves = [], [], []
            for i in range(len(words.first) - 1):
                word = words.hash[words.first[i] : words.first[i + 1]]
                found = shingles(word, banding.size)
                n.append(len(found))
                if not len(found):
                    set_key.append(None)
                    halves.append([])
                    continue
                place = np.arange(1, len(found) + 1, dtype=U64)
                folded = mixed(found * (place * U64(2) + U64(1))).sum(dtype=U64) + U64(len(found))
                set_key.append(int(signed(mixed(np.array([folded])))[0]))
                groups = _minima(found, count).astype(U64).reshape(2 * banding.halves, banding.rows)
                halves.append(signed(chained([*groups.T, np.arange(len(groups), dtype=U64)])))
            out.add(
                doc_id=ids[words.rows].to_pylist(),
                row_key=keys[words.rows].to_pylist(),
                n_shingles=np.array(n, np.int64),
                set_key=set_key,
                halves=halves,
                **carried(batch, list(carry), words.rows),
            )

    columns = docs.select(F.col("doc_id").cast("bigint"), "text", _row_key(), *carry)
    schema = "doc_id bigint, row_key bigint, n_shingles bigint, set_key bigint, halves array<bigint>"
    return map_batches(columns, work, ", ".join([schema, *(f"{c} bigint" for c in carry)]))


def candidate_links(nodes: DataFrame, banding: Banding) -> DataFrame:
    """``a, b``: each set that meets others in a table, with the smallest key in that table.

    A table holds more than one set only where both its groups do, so sets alone in a group
    go before groups are combined.
    """
    halves = nodes.select("set_key", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    left = F.filter("found", lambda x: x.place < banding.halves)
    right = F.filter("found", lambda x: x.place >= banding.halves)
    tables = (
        halves.join(shared, "half")
        .groupBy("set_key")
        .agg(F.collect_list(F.struct("place", "half")).alias("found"))
        .select("set_key", left.alias("left"), right.alias("right"))
        .select("set_key", F.explode("left").alias("l"), "right")
        .select("set_key", "l", F.explode("right").alias("r"))
        .select("set_key", F.xxhash64("l.half", "r.half").alias("table_key"))
    )
    tables = stored(tables, "tables")
    first = tables.groupBy("table_key").agg(F.min("set_key").alias("b"), F.max("set_key").alias("last"))
    first = stored(first.where("b < last").drop("last"), "first")
    return tables.join(first, "table_key").where("set_key <> b").select(F.col("set_key").alias("a"), "b").distinct()


def _cells(nodes: DataFrame, clusters: DataFrame, banding: Banding) -> DataFrame:
    """``set_key, row_key, cell``: the comparison tasks that a set takes part in.

    Linked sets differ in size by less than the threshold, so they fall into the same or
    neighbouring classes of size. A class of a cluster is cut into tiles; a cell is a pair of
    tiles of the same or neighbouring classes.
    """
    step = float(np.log(100 / banding.percent)) * 1.000001
    member = nodes.join(clusters, F.col("set_key") == F.col("node")).select(
        "set_key", "row_key", "n_shingles", F.col("component").alias("cluster"),
        F.floor(F.log(F.col("n_shingles").cast("double")) / step).alias("grade"),
    )
    member = stored(member, "members")
    count, weight = F.count(F.lit(1)), F.sum("n_shingles")
    whole = W.partitionBy("cluster")  # a row for each class of size
    classes = member.groupBy("cluster", "grade").agg(
        F.ceil(F.greatest(count / banding.tile, weight / banding.tile_shingles)).alias("tiles"),
        count.alias("n"), weight.alias("w"),
    ).withColumn(
        "one_cell",
        (F.sum("n").over(whole) <= banding.tile) & (F.sum("w").over(whole) <= banding.tile_shingles),
    )
    near = classes.select(
        "cluster", F.explode(F.array(*(F.col("grade") + d for d in (-1, 0, 1)))).alias("grade"),
        "one_cell", F.struct(F.col("grade").alias("g"), "tiles").alias("c"),
    )
    near = near.groupBy("cluster", "grade").agg(
        F.first("one_cell").alias("one_cell"), F.collect_list("c").alias("near")
    )
    placed = member.join(stored(near, "classes"), ["cluster", "grade"])
    # Each tile of the set's class and of the two classes beside it, the smaller tile first.
    pairs = F.expr(
        "flatten(transform(near, c -> transform(sequence(0L, c.tiles - 1), t -> "
        "CASE WHEN c.g < grade OR (c.g = grade AND t < tile) "
        "THEN struct(c.g AS g1, t AS t1, grade AS g2, tile AS t2) "
        "ELSE struct(grade AS g1, tile AS t1, c.g AS g2, t AS t2) END)))"
    )
    alone = F.expr("array(struct(-1L AS g1, 0L AS t1, -1L AS g2, 0L AS t2))")
    return (
        placed.withColumn("tile", F.expr("pmod(set_key, filter(near, c -> c.g = grade)[0].tiles)"))
        .withColumn("pair", F.explode(F.when(F.col("one_cell"), alone).otherwise(pairs)))
        .select("set_key", "row_key", F.xxhash64("cluster", "pair").alias("cell"))
    )


def _link_cell(percent: int, size: int, lower: bool = True):
    """Spanning links of the sets of one cell, from the sizes of all their intersections."""

    def work(key, rows: pa.Table, out: Emitter):
        keys = rows.column("set_key").to_numpy()
        _, once = np.unique(keys, return_index=True)
        if len(once) < 2:
            return
        rows, keys = rows.take(pa.array(once)), keys[once]
        sets = []
        for words in words_of(rows.column("text").combine_chunks(), lower):
            sets += [shingles(words.hash[a:b], size) for a, b in zip(words.first, words.first[1:])]
        sizes = np.array([len(s) for s in sets])
        linked = _linked(sets, sizes, percent)
        root = np.full(len(keys), -1)
        for seed in range(len(keys)):
            if root[seed] >= 0:
                continue
            root[seed] = seed
            front = np.array([seed])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
                root[front] = seed
        other = np.flatnonzero(root != np.arange(len(keys)))
        out.add(a=keys[other], b=keys[root[other]])

    return work


def _linked(sets: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sets are similar enough, from exact intersections in slices of the shingles."""
    n = len(sets)
    if n == 2:
        common = np.zeros((2, 2))
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(n), sizes)
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(at, minlength=len(values)) > 1  # the others are in no intersection
        code = np.cumsum(often) - 1
        keep = often[at]
        owner, at, width = owner[keep], code[at[keep]], int(often.sum())
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        common = np.zeros((n, n), np.float64)
        step = 8192
        for low in range(0, width, step):
            a, b = np.searchsorted(at, [low, low + step])
            block = np.zeros((n, min(step, width - low)), np.float32)
            block[owner[a:b], at[a:b] - low] = 1
            common += block @ block.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(linked, False)
    return linked


def _grouped(docs: DataFrame, banding: Banding, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, row_key, component, *carry`` per row.

    ``component`` is the smallest ``set_key`` reachable, null for an empty set.
    """
    rows = stored(signatures(docs, banding, carry), "signatures")
    nodes = stored(
        rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("least_id"),
            F.min_by(F.struct("row_key", "n_shingles", "halves"), "row_key").alias("one"),
        ).select("set_key", "least_id", "one.*"),
        "sets",
    )
    clusters = components(candidate_links(nodes, banding))
    cells = _cells(nodes, clusters, banding)
    # One copy for each key, combined before the shuffle: a row may stand there any number of times.
    texts = docs.select("text", _row_key()).groupBy("row_key").agg(F.first("text").alias("text"))
    work = _link_cell(banding.percent, banding.size)
    links = map_groups(
        cells.join(texts, "row_key").select("cell", "set_key", "text"), ["cell"], work, "a bigint, b bigint"
    )
    found = components(links)
    least = (
        found.join(nodes.select("set_key", "least_id"), F.col("node") == F.col("set_key"))
        .groupBy("component").agg(F.min("least_id").alias("component_id"))
    )
    classes = found.join(least, "component").select(F.col("node").alias("set_key"), "component_id", "component")
    classes = nodes.join(classes, "set_key", "left").select(
        "set_key", F.coalesce("component_id", "least_id").alias("component_id"),
        F.coalesce("component", "set_key").alias("component"),
    )
    filled = rows.where("set_key IS NOT NULL").join(stored(classes, "classes"), "set_key")
    empty = rows.where("set_key IS NULL").withColumns(
        {"component_id": F.col("doc_id"), "component": F.col("set_key")}
    )
    columns = ["doc_id", "n_shingles", "component_id", "row_key", "component", *carry]
    return filled.select(columns).unionByName(empty.select(columns))


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, row_key``, one row per row of ``docs(doc_id, text, ...)``.

    Texts are lower-cased in A-Z and cut into words at ASCII white space. A document's set
    holds its distinct shingles; a text with fewer words has one, its whole sequence. Null
    texts and texts without words have an empty set and link with nothing: they are their own
    component. ``component_id`` is the smallest ``doc_id`` reachable; ``kept`` marks the
    documents whose id that is, so rows that repeat a kept ``doc_id`` with a linked text are
    all kept, and a null ``doc_id`` counts only where nothing else is reachable. Equal sets
    are compared once. ``row_key`` is the 64-bit hash of id and text. Other columns are ignored, whatever their names.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return _grouped(docs, banding).select("doc_id", "n_shingles", "component_id", kept, "row_key")


def one_of_each(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    keys = near_duplicates(docs, banding).where("kept").select(F.col("row_key").alias("_row_key")).distinct()
    return docs.join(stored(keys, "kept"), _row_key() == F.col("_row_key"), "left_semi")


def first_of_each(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """Exactly one row of ``docs`` for each component, with all its columns.

    It is the first by ``doc_id`` (a null one comes last), hash of id and text, and place in
    the table that is written here, so of rows that repeat one another, and of rows without
    ids, one stays. Texts without words link with nothing: their rows all stay.
    """
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = _grouped(numbered, banding, carry=("_row",))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key", "_row")
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first"))
    keys = first.select("first._row").unionByName(rows.where("component IS NULL").select("_row"))
    return numbered.join(stored(keys, "kept"), "_row", "left_semi").drop("_row")
