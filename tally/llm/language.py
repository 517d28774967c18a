"""Language of a text by prediction by partial matching over bytes.

Each language has counts of the bytes that follow contexts of 0 to ``order`` bytes. A byte's
code length comes from the longest known context that has seen it; every shorter context
costs an escape, and what longer contexts have seen is excluded below. The counts are frozen
after training, so code lengths are tabulated for each context and byte, and the code length
of a text is a sum of look-ups. The language with the shortest code is predicted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, carried, map_batches, refuse_clash
from tally.llm.storage import stored

_LETTER = re.compile(r"[^\W\d_]")
_ORDER = 3  # bytes of the longest context
_UNIT = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """About ``rows`` texts a language and at most ``contexts`` contexts are learned."""

    rows: int = 1500
    contexts: int = 4000


def texts_of(column: pa.Array):
    """Bytes of consecutive texts, the first byte of each, and their rows; a megabyte or a text at a time."""
    texts = [b"" if t is None else t.encode() for t in column.to_pylist()]
    row = 0
    while row < len(texts):
        until, size = row, 0
        while until < len(texts) and (until == row or size + len(texts[until]) <= _UNIT):
            size += len(texts[until])
            until += 1
        part = texts[row:until]
        first = np.cumsum([0, *map(len, part)])
        yield np.frombuffer(b"".join(part), np.uint8), first, slice(row, until)
        row = until


def _before(data: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The byte 1, 2, ... places before each byte, and -1 before the start of its text."""
    starts = first[:-1][np.diff(first) > 0]
    out = []
    for back in range(1, _ORDER + 1):
        shifted = np.full(len(data), -1, np.int32)
        shifted[back:] = data[: max(len(data) - back, 0)]
        for step in range(back):
            at = starts + step
            shifted[at[at < len(data)]] = -1
        out.append(shifted)
    # A text shorter than the context: its neighbours' starts were marked above.
    for longer, shorter in zip(out[1:], out):
        longer[shorter < 0] = -1
    return out


def _counted(sample: DataFrame) -> DataFrame:
    """``lang, size, context, byte, n``: how often a byte follows a context of ``size`` bytes."""

    def work(batch, out: Emitter):
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            own = pa.array([i for i, x in enumerate(langs) if x == lang])
            for data, first, _ in texts_of(batch.column("text").take(own)):
                context, keep = np.zeros(len(data), np.int64), np.ones(len(data), bool)
                for size, before in enumerate([None, *_before(data, first)]):
                    if size:
                        keep = before >= 0
                        context = context | (before.astype(np.int64) << (8 * (size - 1)))
                    pair, n = np.unique(context[keep] * 256 + data[keep], return_counts=True)
                    out.add(
                        lang=[lang] * len(pair), size=np.full(len(pair), size, np.int32), context=pair >> 8,
                        byte=(pair & 255).astype(np.int32), n=n.astype(np.int64),
                    )

    rows = map_batches(sample, work, "lang string, size int, context bigint, byte int, n bigint")
    return rows.groupBy("lang", "size", "context", "byte").agg(F.sum("n").alias("n"))


def code_lengths(chain: list[np.ndarray]) -> np.ndarray:
    """Bits of each byte after a context; ``chain`` has the counts of it and of its shorter contexts."""
    bits, escaped = np.zeros(256), 0.0
    open_ = np.ones(256, bool)
    for counts in chain:
        seen = np.where(open_, counts, 0)
        total, kinds = seen.sum(), np.count_nonzero(seen)
        if not total:
            continue
        here = seen > 0
        bits[here] = escaped - np.log2(seen[here] / (total + kinds))
        escaped -= np.log2(kinds / (total + kinds))
        open_ &= ~here
    if open_.any():
        bits[open_] = escaped + np.log2(open_.sum())
    return bits


class Model:
    """Code lengths by language, context and byte, and tables that find a byte's context."""

    def __init__(self, rows: list[tuple]):
        """``rows`` of (lang, size, context, byte, n); with a context come all its shorter ones."""
        self.langs = sorted({r[0] for r in rows})
        places = {(0, 0): 0}
        for size, context in sorted({(r[1], r[2]) for r in rows}):
            places.setdefault((size, context), len(places))
        counts = np.zeros((len(self.langs), len(places), 256))
        at = {lang: i for i, lang in enumerate(self.langs)}
        for lang, size, context, byte, n in rows:
            counts[at[lang], places[size, context], byte] = n
        known = np.flatnonzero(counts.sum(axis=(0, 1)) > 0)
        # Bytes that no language has seen cost the same after a context: one column for all.
        self.column = np.full(256, len(known), np.int32)
        self.column[known] = np.arange(len(known))
        spare = np.setdiff1d(np.arange(256), known)[:1]
        take = np.concatenate([known, spare])
        self.width = len(take)
        self.bits = np.zeros((len(self.langs), len(places), self.width), np.float32)
        self.one = np.zeros(256, np.int32)
        self.two = np.zeros(1 << 16, np.int32)
        self.rank = np.zeros(1 << 16, np.int32)
        three = [np.full(256, -1, np.int32)]
        for (size, context), place in places.items():
            chain = [places[s, context & ((1 << (8 * s)) - 1)] for s in range(size, -1, -1)]
            for i in range(len(self.langs)):
                self.bits[i, place] = code_lengths([counts[i, c] for c in chain])[take]
            if size == 1:
                self.one[context] = place
        # The low byte of a context is the nearest one.
        self.two[:] = self.one[np.arange(1 << 16) & 255]
        for (size, context), place in places.items():
            if size == 2:
                self.two[context] = place
                self.rank[context] = len(three)
                three.append(np.full(256, -1, np.int32))
        for (size, context), place in places.items():
            if size == 3:
                three[self.rank[context & 0xFFFF]][context >> 16] = place
        self.three = np.array(three)

    def contexts(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The longest known context before each byte."""
        one, two, three = _before(data, first)
        pair = np.where(two >= 0, one + (two << 8), 0)
        place = np.where(two >= 0, self.two[pair], np.where(one >= 0, self.one[np.maximum(one, 0)], 0))
        longest = np.where(three >= 0, self.three[self.rank[pair], np.maximum(three, 0)], -1)
        return np.where(longest >= 0, longest, place)

    def lengths(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Bits of each text under each language, a row for each text."""
        at = self.contexts(data, first).astype(np.int64) * self.width + self.column[data]
        out = np.zeros((len(first) - 1, len(self.langs)))
        for i, table in enumerate(self.bits):
            sums = np.concatenate([[0.0], np.cumsum(table.ravel()[at], dtype=np.float64)])
            out[:, i] = sums[first[1:]] - sums[first[:-1]]
        return out


def fit(docs: DataFrame, learn: Column, settings: Settings = Settings()) -> Model | None:
    """Learn from texts with a language where ``learn`` (of doc_id) is true; None where there are none.

    ``docs(doc_id, text, lang)``. Each language gives about ``settings.rows`` texts, drawn by
    the hash of id and text; all are used where there are fewer. The driver gets at most
    ``settings.contexts`` contexts, the commonest ones, with the counts of their bytes.
    """
    usable = docs.select("doc_id", "text", "lang")
    usable = usable.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & learn)
    share = usable.groupBy("lang").agg((settings.rows / F.count(F.lit(1))).alias("share"))
    uniform = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = usable.join(stored(share, "shares"), "lang").where(uniform < F.col("share")).select("lang", "text")
    counted = stored(_counted(sample), "counts")
    common = (
        counted.groupBy("size", "context").agg(F.sum("n").alias("all"))
        .orderBy(F.desc("all"), "size", "context").limit(settings.contexts)
    )
    rows = counted.join(F.broadcast(common.drop("all")), ["size", "context"])  # ``contexts`` rows at most
    rows = rows.select("lang", "size", "context", "byte", "n").collect()
    return Model([tuple(r) for r in rows]) if rows else None


def predicted(docs: DataFrame, model: Model | None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``*carry, lang_pred, score`` of each row, from its whole text alone.

    The score is the chance of the predicted language among the learned ones, given the code
    lengths. ``und`` with a score of 0 stands for a null text, one without a letter, and any
    text where no language was learned. Equal code lengths go to the smaller name. Other
    columns are ignored; ``carry`` may not name an output.
    """
    refuse_clash(carry, ("lang_pred", "score"))
    columns = [c for c in dict.fromkeys(carry)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def work(batch, out: Emitter):
        texts = batch.column("text")
        for data, first, rows in texts_of(texts):
            named = [bool(t) and _LETTER.search(t) is not None for t in texts[rows].to_pylist()]
            langs, score = [UNKNOWN] * len(named), np.zeros(len(named))
            if model is not None:
                lengths = model.lengths(data, first)
                best = lengths.argmin(axis=1)
                behind = np.minimum(lengths - lengths.min(axis=1, keepdims=True), 1000)
                chance = 1 / np.exp2(-behind).sum(axis=1)
                langs = [model.langs[b] if n else UNKNOWN for b, n in zip(best, named)]
                score = np.where(named, chance, 0.0)
            out.add(**carried(batch, columns, rows), lang_pred=langs, score=score)

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "lang_pred string, score double"])
    return map_batches(docs.select(*dict.fromkeys([*columns, "text"])), work, schema)
