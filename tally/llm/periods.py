"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words that repeats with a period ``q`` at least four times over. Words
q apart are equal inside it, so windows q apart hold the same sequences of words and have
their minima q apart. At scale K (a power of two) sequences of K words are hashed and the
smallest of each K/2 neighbouring ones is marked: any run of a period from K/2 to K holds two
equal marks exactly one period apart, with no equal mark between them. Each such pair is a
seed that is extended both ways over the words themselves. Periods too short for a scale are
found by comparing all words with those 1, 2, ... places on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, map_batches
from tally.llm.words import U64, Words, mixed, words_of

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
_SHORT = 8  # periods up to here are found by direct scans; a power of two
_STEP = U64(0x9E3779B97F4A7C15)


def window_minima(value: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest of each ``width`` neighbouring values, the first of equal ones, in order.

    The low bits of a value give way to its place, which settles ties alike wherever the
    same values follow one another.
    """
    count = len(value)
    if count < width:
        return np.zeros(0, np.int64)
    low = U64((1 << max(1, int(count - 1).bit_length())) - 1)
    key = (value & ~low) | np.arange(count, dtype=U64)
    pad = -count % width
    blocks = np.concatenate([key, np.full(pad, ~U64(0), U64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: count - width + 1], ahead[width - 1 : count])
    return np.unique((least & low).astype(np.int64))


def _agreeing(word: np.ndarray, place: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``place`` inside ``low..high`` where words ``lag`` apart are equal."""
    step, start = 64, place
    while start > low:
        to = max(low, start - step)
        differ = np.flatnonzero(word[to:start] != word[to + lag : start + lag])
        if len(differ):
            start = to + int(differ[-1]) + 1
            break
        start, step = to, step * 2
    step, end = 64, place
    while end < high - lag:
        to = min(high - lag, end + step)
        differ = np.flatnonzero(word[end:to] != word[end + lag : to + lag])
        if len(differ):
            end = end + int(differ[0])
            break
        end, step = to, step * 2
    return start, end + lag


def _short_runs(word: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """``start, end, period`` of stretches of the shortest periods, over all texts at once."""
    found = []
    for lag in range(1, min(_SHORT, len(word) - 1) + 1):
        same = np.zeros(len(word) - lag + 2, dtype=bool)
        same[1:-1] = (word[:-lag] == word[lag:]) & (text[:-lag] == text[lag:])
        edge = np.flatnonzero(same[1:] != same[:-1])
        start, end = edge[::2], edge[1::2] + lag
        long = end - start >= max(LEAST_LENGTH, LEAST_EXPONENT * lag)
        found.append(np.stack([start[long], end[long], np.full(int(long.sum()), lag)], axis=1))
    return found


def _seeds(chain: np.ndarray, scale: int) -> np.ndarray:
    """``lag, place`` of equal marks that follow one another at a distance of the scale."""
    marks = window_minima(chain, scale // 2)
    order = np.lexsort((marks, chain[marks]))
    marks = marks[order]
    lag = marks[1:] - marks[:-1]
    hit = (chain[marks[1:]] == chain[marks[:-1]]) & (lag >= scale // 2) & (lag <= scale)
    seeds = np.stack([lag[hit], marks[:-1][hit]], axis=1)
    return seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))]


def runs(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``start, end, period`` of all runs of texts whose words lie one after another.

    Text ``t`` has the words ``first[t]`` to ``first[t + 1]``; no run leaves its text. A
    stretch is named once, with its smallest period, and rows are sorted.
    """
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    found = _short_runs(word, text) if len(word) > 1 else []
    scale, left = 2 * _SHORT, np.arange(len(sizes))
    while True:
        left = left[sizes[left] >= LEAST_EXPONENT * (scale // 2)]  # texts that can hold a run of this scale
        if not len(left):
            break
        # Neighbours go together: most texts are short, and calls cost more than words.
        for together in np.split(left, np.flatnonzero(np.diff(left) > 1) + 1):
            low, high = int(first[together[0]]), int(first[together[-1] + 1])
            own, width = word[low:high], 1
            chain = own
            while width < scale:
                chain = mixed(chain[: len(chain) - width] * _STEP + chain[width:])
                width *= 2
            found.append(_extended(own, text[low:high], _seeds(chain, scale), first, low))
        scale *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    again = np.zeros(len(rows), dtype=bool)
    again[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    rows = rows[~again]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _extended(own: np.ndarray, text: np.ndarray, seeds: np.ndarray, first: np.ndarray, low: int) -> np.ndarray:
    """The stretches around seeds that are long enough; a seed inside one of its period is done."""
    rows, known = [], (0, 0)
    for lag, place in seeds.tolist():
        if known[0] == lag and place + lag <= known[1]:
            continue
        t = text[place]
        if text[place + lag] != t:
            continue
        start, end = _agreeing(own, place, lag, int(first[t]) - low, int(first[t + 1]) - low)
        known = (lag, end)
        if end - start >= max(LEAST_LENGTH, LEAST_EXPONENT * lag):
            rows.append((start + low, end + low, lag))
    return np.array(rows, np.int64).reshape(-1, 3)


def _kept_texts(words: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by single spaces."""
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    past = np.cumsum(size)
    data = np.concatenate([words.data, np.zeros(1, np.uint8)])
    took = data[np.repeat(start - (past - size), size) + np.arange(past[-1] if len(past) else 0)]
    if len(past):
        took[past - 1] = 32
    count = np.concatenate([[0], np.cumsum(keep)])[words.first]
    bounds = np.concatenate([[0], past])[count]
    whole = took.tobytes()
    return [whole[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def periodic_runs(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_words, runs, kept_text`` of every text, after the columns of ``carry``.

    ``docs(text, ...)``. A run is a stretch of consecutive words with smallest period q and at
    least 6 and 4 * q words, which no neighbouring word extends; ``runs`` lists
    ``start, length, period`` by start, then period, in words from 0. ``kept_text`` joins by
    single spaces the words that no run contains after its first period.

    Words are runs of bytes other than ASCII white space, compared by 64-bit hashes. Texts are
    read whole and by themselves, so repeated rows give repeated results and nothing is
    shuffled. A null text, an empty one and one without words have no words, no runs and an
    empty ``kept_text``. Other columns may hold anything; ``carry`` may not name an output.
    """
    outputs = ("n_words", "runs", "kept_text")
    if clash := set(outputs) & set(carry):
        raise ValueError(f"columns to carry have names of outputs: {sorted(clash)}")
    docs = docs.select(*carry, "text")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batch, out: Emitter):
        for words in words_of(batch.column("text")):
            rows = runs(words.hash, words.first)
            inside = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(inside, rows[:, 0] + rows[:, 2], 1)
            np.add.at(inside, rows[:, 1], -1)
            keep = np.cumsum(inside)[:-1] == 0
            owner = np.searchsorted(words.first, rows[:, 0], side="right") - 1
            # Texts without words share their first place with the next one.
            offsets = np.searchsorted(owner, np.arange(len(words.first)))
            listed = pa.StructArray.from_arrays(
                [
                    pa.array(rows[:, 0] - words.first[owner]),
                    pa.array(rows[:, 1] - rows[:, 0]),
                    pa.array(rows[:, 2]),
                ],
                fields=list(item),
            )
            out.add(
                **{c: batch.column(c)[words.rows] for c in carry},
                n_words=np.diff(words.first).astype(np.int64),
                runs=pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), listed),
                kept_text=pa.array(_kept_texts(words, keep), pa.binary()).cast(pa.string()),
            )

    listed = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return map_batches(docs, work, f"{kinds}, n_words bigint, runs {listed}, kept_text string")


def looped(docs: DataFrame) -> DataFrame:
    """Texts of about every tenth document, by the hash of its id, made to repeat from some word on.

    With n words, h = crc32 of the decimal id and g = floor(h / 10), a text with h % 10 = 0 goes
    on from word a = g % n with period 1 + floor((n - a) / (3 + g % 8)). Texts without words,
    and of documents without an id, stay as they are.
    """
    hashed = docs.withColumn("__h", F.crc32(F.col("doc_id").cast("string")))
    words = hashed.withColumn(
        "__w", F.expr(r"IF(__h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), NULL)")
    )
    placed = words.withColumn("__n", F.size("__w").cast("bigint")).withColumn("__g", F.expr("__h div 10"))
    placed = placed.withColumn("__a", F.expr("IF(__n > 0, __g % __n, NULL)"))
    placed = placed.withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    again = """array_join(transform(sequence(0L, __n - 1),
        i -> __w[CAST(IF(i < __a, i, __a + (i - __a) % __p) AS INT)]), ' ')"""
    text = F.expr(f"IF(__n > 0, {again}, text)")
    return placed.withColumn("text", F.coalesce(text, F.col("text"))).drop("__h", "__w", "__n", "__g", "__a", "__p")


def digests(found: DataFrame) -> DataFrame:
    """One row per document: the run of the greatest length by period, and checksums of all."""
    best = F.expr(
        """aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
            (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best))"""
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(ended, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )
