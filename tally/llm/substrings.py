"""Exact removal of repeated passages through paths of word windows under minimiser k-mers.

The paths stand in for a compacted De Bruijn graph, which is not built: there is no table of
all k-mers and no node degrees. The smallest k-mer of each window of words, its edge, names
the path that the window lies on. Consecutive windows under one such edge are compacted into a path,
which travels through the joins as one row. A path that occurs twice is a repeated
nonbranching path. Paths that share their edge but differ branch; only those are unfolded
again into windows at their source coordinates, which are counted by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, carried, map_batches, refuse_clash
from tally.llm.storage import stored
from tally.llm.words import U64, mixed, signed, words_of

_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Spans:
    """Hashes of spans of a sequence of word hashes, from prefix sums of a polynomial."""

    def __init__(self, word: np.ndarray):
        powers = np.full(len(word) + 1, _BASE, U64)
        powers[0] = 1
        self.back = np.full(len(word) + 1, _INVERSE, U64)
        self.back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(len(word) + 1, U64)
        np.cumsum(word * powers[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw ^ mixed((end - start).astype(U64)))


def smallest_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its first smallest one."""
    n = len(values) - width + 1
    best, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[: len(best) - step], best[step:]
        first = left <= right
        best, place = np.where(first, left, right), np.where(first, place[: len(best) - step], place[step:])
        have += step
    return place[:n]


def paths_of(word: np.ndarray, first: np.ndarray, window: int, edge: int):
    """Compacted paths of several texts: text, first and last window, edge hash, path hash."""
    if len(word) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U64), none.astype(U64)
    spans = Spans(word)
    starts = np.arange(len(word) - edge + 1)
    edges = spans.of(starts, starts + edge)
    chosen = smallest_places(edges, window - edge + 1)
    at = np.arange(len(chosen))
    text = np.searchsorted(first, at, side="right") - 1
    at = at[at + window <= first[text + 1]]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U64), none.astype(U64)
    text, chosen = text[at], chosen[at]
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([new[1:] - 1, [len(at) - 1]])
    head, tail = at[new], at[last]
    return text[new], head - first[text[new]], tail - first[text[new]], edges[chosen[new]], spans.of(head, tail + window)


def _paths(docs: DataFrame, window: int, edge: int) -> DataFrame:
    """``edge, path, text_key, head, tail, again``: a row for each path of each text.

    ``again`` marks paths that a batch holds twice. They are known to repeat before
    anything is shuffled; the commonest passages are all among them.
    """

    def work(batch, out: Emitter):
        keys, parts = batch.column("text_key").to_numpy(), []
        for words in words_of(batch.column("text")):
            text, head, tail, edges, path = paths_of(words.hash, words.first, window, edge)
            parts.append((edges, path, keys[words.rows][text], head, tail))
        edges, path, text_key, head, tail = (np.concatenate(x) for x in zip(*parts))
        _, at, n = np.unique(path, return_inverse=True, return_counts=True)
        out.add(
            edge=signed(edges), path=signed(path), text_key=text_key, head=head.astype(np.int32),
            tail=tail.astype(np.int32), again=n[at] > 1,
        )

    texts = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("text_key"))
    return map_batches(texts, work, "edge bigint, path bigint, text_key bigint, head int, tail int, again boolean")


def _unfolded(asked: DataFrame, window: int) -> DataFrame:
    """``window_key, text_key, at, n`` of each window of the paths asked for in ``asked(text, text_key, paths)``."""

    def work(batch, out: Emitter):
        keys, paths = batch.column("text_key").to_numpy(), batch.column("paths")
        for words in words_of(batch.column("text")):
            spans = Spans(words.hash)
            for row in range(words.rows.start, words.rows.stop):
                for path in paths[row].as_py():
                    at = np.arange(path["head"], path["tail"] + 1)
                    begin = at + words.first[row - words.rows.start]
                    out.add(
                        window_key=signed(spans.of(begin, begin + window)),
                        text_key=np.full(len(at), keys[row]), at=at.astype(np.int32),
                        n=np.full(len(at), path["n"]),
                    )

    return map_batches(asked, work, "window_key bigint, text_key bigint, at int, n bigint")


def covered(count: int, heads: np.ndarray, tails: np.ndarray, window: int) -> np.ndarray:
    """Which of ``count`` words lie in a window that starts in one of the closed ranges."""
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, heads, 1)
    np.add.at(edges, np.minimum(tails + window, count), -1)
    return np.cumsum(edges[:count]) > 0


def remaining(data: np.ndarray, start: np.ndarray, end: np.ndarray, keep: np.ndarray) -> bytes:
    """The kept words of a text, joined by one space."""
    raw = data.tobytes()
    return b" ".join([raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())])


def _assemble(window: int, columns: list[str], rejoin: bool):
    def work(batch, out: Emitter):
        ranges = batch.column("ranges")
        ends = pa.array(ranges.flatten())
        heads, tails = ends.field("head").to_numpy(), ends.field("tail").to_numpy()
        until = np.cumsum(np.nan_to_num(ranges.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
        texts = batch.column("text")
        for words in words_of(texts):
            n_words, n_removed, kept, lists = [], [], [], []
            for i, row in enumerate(range(words.rows.start, words.rows.stop)):
                a, b = words.first[i], words.first[i + 1]
                of = slice(until[row - 1] if row else 0, until[row])
                gone = covered(b - a, heads[of], tails[of], window)
                n_words.append(b - a)
                n_removed.append(int(gone.sum()))
                if not texts[row].is_valid or not (rejoin or n_removed[-1]):
                    kept.append(texts[row].as_py())
                else:
                    kept.append(remaining(words.data, words.start[a:b], words.end[a:b], ~gone).decode())
            out.add(
                **carried(batch, columns, words.rows),
                n_words=np.array(n_words, np.int64), n_removed=np.array(n_removed, np.int64), kept_text=kept,
            )

    return work


def without_repeats(
    docs: DataFrame, window: int = 50, edge: int = 8, carry: tuple[str, ...] = ("doc_id",), rejoin: bool = True
) -> DataFrame:
    """``*carry, n_words, n_removed, kept_text``: the texts without their repeated passages.

    A word goes if it lies in ``window`` consecutive words of a document whose sequence also
    starts at another place of any document, its own included; all occurrences go. Windows
    are judged on the input. Words are runs of bytes other than ASCII white space, compared
    unchanged; kept words are joined by one space, but without ``rejoin`` texts that lose
    nothing stay as they are. A null text has no words and stays null;
    texts with fewer than ``window`` words keep them all. Every row counts as a document,
    also one that repeats another. Words and windows are compared by 64-bit hashes. ``docs``
    needs ``text`` and the columns to ``carry``, which may not name an output; others are ignored.
    """
    if not 1 <= edge <= window:
        raise ValueError("an edge has at least one word and at most as many as a window")
    refuse_clash(carry, ("n_words", "n_removed", "kept_text"))
    paths = stored(_paths(docs, window, edge), "paths")
    source = F.struct("text_key", "head", "tail")
    distinct = paths.groupBy("edge", "path").agg(F.count(F.lit(1)).alias("n"), F.min(source).alias("source"))
    per_edge = F.struct("path", "n", "source")
    distinct = stored(distinct, "distinct")
    edges = distinct.groupBy("edge").agg(F.count(F.lit(1)).alias("paths")).where("paths > 1")
    branching = distinct.join(edges, "edge").select("n", "source.*")
    texts = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("text_key"))
    asked = branching.groupBy("text_key").agg(F.collect_list(F.struct("head", "tail", "n")).alias("paths"))
    unfolded = _unfolded(stored(asked, "asked").join(texts, "text_key"), window)
    # Copies of a text give the same rows; the source counts once.
    unfolded = stored(unfolded.groupBy("window_key", "text_key", "at").agg(F.max("n").alias("n")), "windows")
    again = unfolded.groupBy("window_key").agg(F.sum("n").alias("total")).where("total > 1").select("window_key")
    single = unfolded.where("n = 1").join(stored(again, "again"), "window_key").select(
        "text_key", F.col("at").alias("head"), F.col("at").alias("tail")
    )
    # Only paths that no batch has shown to repeat must be looked up.
    place = ["text_key", "head", "tail"]
    apart = paths.where("NOT again").join(distinct.where("n > 1").select("path", "edge"), ["edge", "path"])
    whole = paths.where("again").select(place).unionByName(apart.select(place))
    ranges = whole.unionByName(single).groupBy("text_key").agg(F.collect_set(F.struct("head", "tail")).alias("ranges"))
    ranges = stored(ranges, "ranges")
    columns = [c for c in carry if c != "text"]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "n_words bigint, n_removed bigint, kept_text string"])
    marked = docs.select(*columns, "text", F.xxhash64("text").alias("text_key")).join(ranges, "text_key", "left")
    return map_batches(marked.select(*columns, "text", "ranges"), _assemble(window, columns, rejoin), schema)
