"""Grouped Python work on Arrow batches, many small groups to a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

_FLUSH_ROWS = 8192


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def carried(batch: pa.RecordBatch, columns: list[str], rows: slice | None = None) -> dict[str, pa.Array]:
    """Columns of a batch, or of a part of its rows, for ``Emitter.add``."""
    part = batch if rows is None else batch.slice(rows.start, rows.stop - rows.start)
    return {c: part.column(c) for c in columns}


def refuse_clash(carry: tuple[str, ...], outputs: tuple[str, ...]) -> None:
    """Columns to carry may not bear the names of outputs."""
    if clash := set(outputs) & set(carry):
        raise ValueError(f"columns to carry have names of outputs: {sorted(clash)}")


class Emitter:
    """Collects columns of output and hands them on as record batches of a useful size."""

    def __init__(self, schema: StructType):
        self._schema = to_arrow_schema(schema)
        self._parts: list[dict] = []
        self._rows = 0

    def add(self, **columns) -> None:
        rows = len(next(iter(columns.values())))
        if rows:
            self._parts.append(columns)
            self._rows += rows

    def full(self) -> bool:
        return self._rows >= _FLUSH_ROWS

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            arrays = []
            for field in self._schema:
                values = [p[field.name] for p in self._parts]
                if all(isinstance(v, pa.Array) for v in values):
                    arrays.append(pa.concat_arrays(values).cast(field.type))
                    continue
                if all(isinstance(v, np.ndarray) for v in values):
                    values = np.concatenate(values)
                else:
                    values = [x for v in values for x in v]
                arrays.append(pa.array(values, type=field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=self._schema)
        self._parts, self._rows = [], 0


def map_groups(
    df: DataFrame,
    keys: list[str],
    work: Callable[[tuple, pa.Table, Emitter], None],
    schema: str,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``work(key, rows, emitter)`` for each group of equal non-null integer ``keys``.

    The caller bounds the size of a group. Rows are shuffled by key and sorted inside
    their partition, so a worker holds one group at a time.
    """
    struct = schema_of(schema)

    def run(batches):
        out = Emitter(struct)
        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
            cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
            for start, end in pairwise([0, *cuts.tolist(), batch.num_rows]):
                key = tuple(values[start].tolist())
                if held and key != held_key:
                    work(held_key, pa.Table.from_batches(held), out)
                    held = []
                    if out.full():
                        yield from out.batches()
                held_key = key
                held.append(batch.slice(start, end - start))
        if held:
            work(held_key, pa.Table.from_batches(held), out)
        yield from out.batches()

    dealt = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, struct)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch, Emitter], None], schema: str) -> DataFrame:
    """Call ``work(batch, emitter)`` for each Arrow batch."""
    struct = schema_of(schema)

    def run(batches):
        out = Emitter(struct)
        for batch in batches:
            if batch.num_rows:
                work(batch, out)
                if out.full():
                    yield from out.batches()
        yield from out.batches()

    return df.mapInArrow(run, struct)
