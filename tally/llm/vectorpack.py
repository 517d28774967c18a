"""Vector bin packing of token pieces into training sequences.

A sequence holds so many tokens, so many segments and so many loss-bearing tokens at most. It
is filled piece by piece: of the pieces that fit, the one is taken whose demands point most
the way of what is left, by the dot product of both, each dimension weighted by how much of it
all pieces ask for. Where none fits, the best one is cut. A sequence that no cut fills gives
back what goes beyond a power of two, which needs no padding.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.bytebpe import ByteBpe
from tally.llm.groups import Emitter, schema_of

_SEQUENCES = 1 << 36  # of a partition
_LEAST_CUT = 32  # tokens: a sequence short of loss, not of tokens, is closed rather than filled crumb by crumb


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


def padded(used: int, limits: Limits) -> int:
    """Tokens of padding that a sequence of so many tokens needs."""
    return 0 if used & (used - 1) == 0 else limits.tokens - used


class _Pool:
    """Pieces that wait, by their demands and by whether their first token bears loss."""

    def __init__(self):
        # tokens, loss, loss of the first token, pieces
        self.kinds = np.zeros((4, 64), np.int64)
        self.waiting: list[list[int]] = []  # of each kind, the latest first
        self.number: dict[tuple[int, int, int], int] = {}

    def add(self, piece: int, tokens: int, loss: int, first: int) -> None:
        kind = self.number.get((tokens, loss, first))
        if kind is None:
            kind = self.number[tokens, loss, first] = len(self.waiting)
            self.waiting.append([])
            if kind >= self.kinds.shape[1]:
                self.kinds = np.concatenate([self.kinds, np.zeros((4, kind + 64), np.int64)], axis=1)
            self.kinds[:3, kind] = tokens, loss, first
        insort(self.waiting[kind], piece, key=lambda p: -p)
        self.kinds[3, kind] += 1

    def _tidy(self) -> None:
        """Forget kinds without pieces."""
        live = np.flatnonzero(self.kinds[3])
        self.kinds = np.concatenate([self.kinds[:, live], np.zeros((4, len(live) + 64), np.int64)], axis=1)
        self.waiting = [self.waiting[k] for k in live]
        self.number = {tuple(key): k for k, key in enumerate(self.kinds[:3, : len(live)].T.tolist())}

    def first(self, kind: int) -> int:
        return self.waiting[kind][-1]

    def take(self, kind: int) -> int:
        self.kinds[3, kind] -= 1
        return self.waiting[kind].pop()

    def best(self, weight: np.ndarray, left: np.ndarray, whole: bool) -> int | None:
        """The kind with the largest dot product with what is left: of those that fit, or can be cut."""
        if np.count_nonzero(self.kinds[3]) < len(self.waiting) // 2 - 64:
            self._tidy()
        tokens, loss, first, count = self.kinds[:, : len(self.waiting)]
        fits = (tokens <= left[0]) & (loss <= left[2]) if whole else first <= left[2]
        kinds = np.flatnonzero(fits & (count > 0))
        if not len(kinds):
            return None
        score = weight[0] * tokens[kinds] * left[0] + weight[1] * left[1] + weight[2] * loss[kinds] * left[2]
        top = kinds[score == score.max()]
        if len(top) > 1:
            earliest = np.array([self.first(k) for k in top])
            top = top[np.lexsort((earliest, -loss[top], -tokens[top]))]
        return int(top[0])


def fill(
    lengths: Sequence[int], losses: Sequence[np.ndarray | None], limits: Limits
) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of ``piece, from, to``; every token of every piece lies in one of them.

    ``losses`` tells for each token of a piece whether it bears loss, None for a piece whose
    tokens all do. Ties go to the longer piece, then to the one with more loss, then to the
    earlier one; a rest that comes back counts as later than all.
    """
    if max(lengths, default=0) > limits.tokens:
        raise ValueError(f"a piece is longer than the {limits.tokens} tokens of a sequence")
    sums = [None if own is None else np.concatenate([[0], np.cumsum(own)]) for own in losses]

    def loss(piece: int, low: int, high: int) -> int:
        return high - low if sums[piece] is None else int(sums[piece][high] - sums[piece][low])

    def reach(piece: int, low: int, high: int, allowed: int) -> int:
        """How far a cut from ``low`` can go before it holds more loss than allowed."""
        own = sums[piece]
        return min(high, low + allowed) if own is None else min(high, int(own.searchsorted(own[low] + allowed, "right")) - 1)

    part: list[tuple[int, int, int]] = []
    pool = _Pool()

    def wait(piece: int, low: int, high: int) -> None:
        part.append((piece, low, high))
        pool.add(len(part) - 1, high - low, loss(piece, low, high), loss(piece, low, low + 1))

    demand = np.zeros(3)
    for piece, length in enumerate(lengths):
        if length:
            wait(piece, 0, length)
            demand += (length, 1, loss(piece, 0, length))
    most = np.array([limits.tokens, limits.segments, limits.loss], float)
    # A demand and what is left are both shares of the limit.
    weight = demand / most / most**2

    done = []
    while pool.kinds[3].any():
        left, held = np.array([limits.tokens, limits.segments, limits.loss]), []
        while left[0] and left[1]:
            kind = pool.best(weight, left, whole=True)
            if kind is not None:
                piece, low, high = part[pool.take(kind)]
                to = high
            elif (kind := pool.best(weight, left, whole=False)) is not None:
                piece, low, high = part[pool.first(kind)]
                to = min(low + int(left[0]), reach(piece, low, high, int(left[2])))
                if held and to - low < min(int(left[0]), _LEAST_CUT):
                    break
                pool.take(kind)
                wait(piece, to, high)
            else:
                break
            held.append((piece, low, to))
            left -= (to - low, 1, loss(piece, low, to))
        used = limits.tokens - int(left[0])
        beyond = 0 if used == limits.tokens else used - (1 << (used.bit_length() - 1))
        while beyond:
            piece, low, high = held.pop()
            cut = max(low, high - beyond)
            beyond -= high - cut
            wait(piece, cut, high)
            if cut > low:
                held.append((piece, low, cut))
        done.append(held)
    return done


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts), kind))


def _arrays(lists: pa.Array) -> list[np.ndarray | None]:
    """Lists as arrays over one buffer."""
    bounds, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
    values = lists.values.to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), valid.tolist())]


def _encoder(tokenizer: str, end: int, size: int, struct):
    """Batches of documents to batches of their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, out = ByteBpe.of(tokenizer), Emitter(struct)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                owner, start, total, parts = [], [], [], []
                for row, text in enumerate(some.column("text")):
                    ids = np.append(bpe.ids(text.as_py() or ""), np.int32(end))
                    at = range(0, len(ids), size)
                    owner += [row] * len(at)
                    start += at
                    total += [len(ids)] * len(at)
                    parts += [ids[place : place + size] for place in at]
                out.add(
                    doc_id=some.column("doc_id").take(pa.array(owner)),
                    doc_tokens=pa.array(total, pa.int64()), start=pa.array(start, pa.int64()),
                    ids=_lists(parts, pa.int32()), loss=pa.nulls(len(parts), pa.list_(pa.bool_())),
                )
                yield from out.batches()

    return run


def _packer(limits: Limits, group: int, carry: list[str], struct):
    """Batches of pieces to batches of placed ones."""

    def solved(held: list[pa.RecordBatch], sequence: int, out: Emitter) -> int:
        table = {c: pa.concat_arrays([b.column(c) for b in held]) for c in [*carry, "start", "ids", "loss"]}
        start, ids, mask = table["start"].to_numpy(), _arrays(table["ids"]), _arrays(table["loss"])
        found = fill([0 if x is None else len(x) for x in ids], mask, limits)
        for low in range(0, len(found), 512):
            placed = found[low : low + 512]
            flat = np.array([p for held_ in placed for p in held_], np.int64).reshape(-1, 3)
            length = flat[:, 2] - flat[:, 1]
            sizes = np.array([len(held_) for held_ in placed])
            past = np.cumsum(length)
            before = (past - length)[np.cumsum(sizes) - sizes]
            number = np.repeat(np.arange(len(placed)), sizes)
            own = [ids[p][a:b] for p, a, b in flat.tolist()]
            columns = {c: table[c].take(pa.array(flat[:, 0])) for c in carry}
            if "ids" in struct.names:
                bears = [None if mask[p] is None else mask[p][a:b] for p, a, b in flat.tolist()]
                columns |= {"ids": _lists(own, pa.int32()), "loss": pa.array(bears, pa.list_(pa.bool_()))}
            out.add(
                **columns,
                start=start[flat[:, 0]] + flat[:, 1],
                length=length,
                ids_crc32=np.array([crc32(x.astype("<u4")) for x in own], np.int64),
                sequence_id=sequence + low + number,
                offset=past - length - before[number],
            )
        return sequence + len(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, count = Emitter(struct), [], 0
        sequence = TaskContext.get().partitionId() * _SEQUENCES
        for batch in batches:
            for low in range(0, batch.num_rows, group):
                part = batch.slice(low, group)
                if count and count + part.num_rows > group:
                    sequence = solved(held, sequence, out)
                    yield from out.batches()
                    held, count = [], 0
                held.append(part)
                count += part.num_rows
        if held:
            solved(held, sequence, out)
        yield from out.batches()

    return run


def _placed_schema(carried: str, with_ids: bool):
    lists = "ids array<int>, loss array<boolean>, " if with_ids else ""
    return schema_of(
        f"{carried}start bigint, length bigint, {lists}ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def packed(pieces: DataFrame, limits: Limits = Limits(), group: int = 4096) -> DataFrame:
    """Pieces cut and placed: ``start, length, ids, loss, ids_crc32, sequence_id, offset`` after their other columns.

    ``pieces(start, ids, [loss], ...)``: ``loss`` holds a boolean for each id; without the
    column, and where it is null, every id bears loss. ``start`` moves with a cut. A sequence
    holds no more than ``limits``; its pieces lie from ``offset`` on without gaps, and it is
    full or as long as some power of two, so nothing is padded. ``ids_crc32`` is taken over
    little-endian unsigned 32-bit ids. Rows without ids give no row. Repeated rows are packed
    as often as they occur.

    Pieces that follow one another in a partition are packed together, ``group`` at a time, so
    nothing is shuffled, a task holds one group, and a task that runs again replaces its own
    sequences. A piece of more than ``limits.tokens`` ids is an error: cut it first. Other
    columns go along; they may not be named as an output.
    """
    outputs = ("length", "ids_crc32", "sequence_id", "offset")
    if clash := set(outputs) & set(pieces.columns):
        raise ValueError(f"columns of pieces have names of outputs: {sorted(clash)}")
    masked = "loss" in pieces.columns
    if not masked:
        pieces = pieces.withColumn("loss", F.lit(None).cast("array<boolean>"))
    carry = [c for c in pieces.columns if c not in ("start", "ids", "loss")]
    rows = pieces.select(*carry, F.col("start").cast("bigint"), F.col("ids").cast("array<int>"), "loss")
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in carry)
    struct = _placed_schema(kinds, True)
    result = rows.mapInArrow(_packer(limits, group, carry, struct), struct)
    return result if masked else result.drop("loss")


def packed_documents(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end: int = 1, group: int = 4096, with_ids: bool = True
) -> DataFrame:
    """``doc_id, doc_tokens`` and the columns of :func:`packed` for the ids of each text and the end id.

    ``docs(doc_id, text, ...)``; every id bears loss. ``start`` counts the document's ids before
    the piece, ``doc_tokens`` all of them. A null text is an empty one, which has its end id
    alone; texts are read whole. Repeated rows and null ids are kept as they are; other columns
    are ignored. ``with_ids`` off leaves out ``ids`` and ``loss``.
    """
    between = schema_of("doc_id bigint, doc_tokens bigint, start bigint, ids array<int>, loss array<boolean>")
    encode = _encoder(tokenizer, end, limits.tokens, between)
    struct = _placed_schema("doc_id bigint, doc_tokens bigint, ", with_ids)
    pack = _packer(limits, group, ["doc_id", "doc_tokens"], struct)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(lambda batches: pack(encode(batches)), struct)
