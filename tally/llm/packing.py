"""Variable-capacity best-fit packing of documents into training sequences.

Documents, cut to the largest permitted length, are dealt into groups of bounded size and
packed there in order of falling length. A piece goes into the open bin that it fills best.
Where none has room, the size is opened that costs least per token it can still receive.
At the end each bin shrinks to the cheapest permitted size that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, map_batches, map_groups
from tally.llm.storage import stored
from tally.llm.words import words_of

_BINS = 1 << 24  # of a group; a group has fewer pieces


@dataclass(frozen=True)
class Sizes:
    """Permitted sequence lengths and what one costs: a fixed part, its length, attention."""

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    fixed: float = 64.0
    quadratic: float = 1 / 16384

    def __post_init__(self):
        if not self.lengths or min(self.lengths) < 1 or list(self.lengths) != sorted(set(self.lengths)):
            raise ValueError("lengths must be positive, rising and distinct")

    def cost(self, length: int) -> float:
        return self.fixed + length + self.quadratic * length * length

    def cheapest(self, content: int) -> int:
        return min((c for c in self.lengths if c >= content), key=lambda c: (self.cost(c), c))

    def opened(self, length: int, left: int) -> int:
        """The size to open for a piece when ``left`` tokens, its own included, have no place."""
        return min(
            (c for c in self.lengths if c >= length), key=lambda c: (self.cost(c) / min(c, left), c)
        )


def packed(lengths: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and capacity of each piece."""
    order = np.argsort(-lengths, kind="stable")
    left = int(lengths.sum())
    room: list[int] = []  # distinct free spaces of open bins, rising
    bins: dict[int, list[int]] = {}  # by free space
    used: list[int] = []
    bin_, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order.tolist():
        length = int(lengths[i])
        at = bisect_left(room, length)
        if at < len(room):
            space = room[at]
            b = bins[space].pop()
            if not bins[space]:
                del bins[space], room[at]
        else:
            space, b = sizes.opened(length, left), len(used)
            used.append(0)
        bin_[i], offset[i] = b, used[b]
        used[b] += length
        left -= length
        space -= length
        if space:
            if space not in bins:
                bins[space] = []
                insort(room, space)
            bins[space].append(b)
    capacity = np.array([sizes.cheapest(content) for content in used], np.int64)
    return bin_, offset, capacity[bin_] if len(bin_) else bin_


def _lengths(docs: DataFrame, columns: list[str], schema: str) -> DataFrame:
    def work(batch, out: Emitter):
        valid = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
        for words in words_of(batch.column("text")):
            n = np.diff(words.first) + 1
            out.add(
                **{c: batch.column(c)[words.rows].to_pylist() for c in columns},
                tokens=np.where(valid[words.rows], n, 0).astype(np.int64),
            )

    return map_batches(docs, work, schema)


def best_fit(docs: DataFrame, sizes: Sizes = Sizes(), group: int = 50_000) -> DataFrame:
    """``doc_id, piece, start, length, bin, offset, capacity``: where each piece of a document goes.

    A document counts its words (runs of bytes other than ASCII white space) and one end
    mark. Documents over the largest length are cut into pieces of that length and a rest;
    ``start`` is the piece's first token. A bin holds ``capacity`` tokens, its pieces lie from
    ``offset`` on without gaps. A text without words has its end mark to pack; a null text
    has nothing, and gets one row of length 0 without a bin. Repeated rows are packed as
    often as they occur, ties go to the earlier row. Groups hold about ``group`` pieces, so
    each leaves a handful of bins part empty, whatever the input. Other columns are ignored.
    """
    largest = sizes.lengths[-1]
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    tokens = stored(_lengths(docs, ["doc_id"], "doc_id bigint, tokens bigint"), "lengths")
    pieces = (
        tokens.where("tokens > 0")
        .withColumn("start", F.explode(F.expr(f"sequence(0L, tokens - 1, {largest}L)")))
        .select(
            "doc_id", (F.col("start") / largest).cast("int").alias("piece"), "start",
            F.least(F.col("tokens") - F.col("start"), F.lit(largest)).alias("length"),
        )
    )
    pieces = stored(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group))
    # The place of a row in the written table is the same whenever it is read again.
    row = F.monotonically_increasing_id()
    dealt = pieces.withColumn("row", row).withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def work(key, rows, out: Emitter):
        order = np.argsort(rows.column("row").to_numpy(), kind="stable")
        rows = rows.take(order)
        length = rows.column("length").to_numpy()
        bin_, offset, capacity = packed(length, sizes)
        out.add(
            doc_id=rows.column("doc_id").to_pylist(), piece=rows.column("piece").to_numpy(),
            start=rows.column("start").to_numpy(), length=length, bin=bin_ + key[0] * _BINS,
            offset=offset, capacity=capacity,
        )

    schema = "doc_id bigint, piece int, start bigint, length bigint, bin bigint, offset bigint, capacity bigint"
    placed = map_groups(dealt, ["group"], work, schema)
    none = F.lit(None).cast("bigint")
    zero = F.lit(0)
    unplaced = tokens.where("tokens = 0").select(
        "doc_id", zero.alias("piece"), zero.cast("bigint").alias("start"), zero.cast("bigint").alias("length"),
        none.alias("bin"), none.alias("offset"), none.alias("capacity"),
    )
    return placed.unionByName(unplaced)
