"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Spaces become the white-space marker, one more marker precedes a text, and the pieces with
the largest sum of log scores are taken. Characters outside the vocabulary become bytes.
Pieces never continue after a marker, so texts are cut before markers; equal segments are
encoded once per batch, many at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import schema_of

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_UNIT = 1 << 19  # bytes of segments encoded at once
_KEPT = 300_000  # segments that a task remembers
_UNKNOWN_BELOW = 10.0


class DoubleArray:
    """A trie of byte strings: the child of node s by byte c is t = base[s] + c where check[t] = s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][byte]
            value[node] = number
        size = 2 * len(children) + 512
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        # Lone children fill the holes that branching nodes leave behind ``ahead``.
        place, free, ahead, queue = {0: 0}, 257, 257, [0]
        for node in queue:
            own = children[node]
            if not own:
                continue
            while taken[free]:
                free += 1
            codes = sorted(own)
            base = (free if len(codes) == 1 else ahead) - codes[0]
            while any(taken[base + c] for c in codes):
                base += 1
                if base + 256 >= len(taken):
                    grown = len(taken)
                    taken.extend(bytes(grown))
                    self.base = np.concatenate([self.base, np.zeros(grown, np.int32)])
                    self.check = np.concatenate([self.check, np.full(grown, -1, np.int32)])
                    self.value = np.concatenate([self.value, np.full(grown, -1, np.int32)])
            if len(codes) > 1:
                ahead = base + codes[0]
            self.base[place[node]] = base
            for code in codes:
                at = base + code
                taken[at] = 1
                self.check[at] = place[node]
                place[own[code]] = at
                self.value[at] = value[own[code]]
                queue.append(own[code])

    def matches(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """``start place, length, value`` of each key that begins at a place ``start`` and ends by ``end``."""
        who, node, length = np.arange(len(start)), np.zeros(len(start), np.int64), 0
        found = []
        while len(who):
            at = start[who] + length
            inside = at < end[who]
            who, node, at = who[inside], node[inside], at[inside]
            child = self.base[node].astype(np.int64) + data[at]
            child = np.minimum(child, len(self.check) - 1)
            step = self.check[child] == node
            who, node = who[step], child[step]
            length += 1
            hit = self.value[node] >= 0
            found.append((who[hit], np.full(int(hit.sum()), length), self.value[node[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (who, who, who)


@dataclass
class Vocabulary:
    """Pieces with their scores; ``kind`` is n(ormal), b(yte), c(ontrol) or u(nknown)."""

    pieces: list[str]
    scores: list[float]
    kinds: str

    def __post_init__(self):
        normal = {p.encode(): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == "n"}
        self.trie = DoubleArray(normal)
        self.score = np.array(self.scores, float)
        own = [self.scores[i] for i in normal.values()]
        self.unknown_score = min(own, default=0.0) - _UNKNOWN_BELOW
        self.unknown = self.kinds.find("u")
        numbers = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == "b"}
        self.bytes = np.array([numbers[b] for b in range(256)]) if len(numbers) == 256 else None
        self.whole = any(MARK in p.lstrip(MARK) for p in self.pieces)
        out = []
        for piece, kind in zip(self.pieces, self.kinds):
            byte = bytes([int(piece[3:5], 16)]) if kind == "b" else b""
            out.append({"n": piece.replace(MARK, " ").encode(), "u": " ⁇ ".encode()}.get(kind, byte))
        self.spelled = out

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a SentencePiece model file."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = "".join(
            "b" if model.is_byte(i) else "u" if model.is_unknown(i) else "c" if model.is_control(i) or model.is_unused(i)
            else "n" for i in ids
        )
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], kind)

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.whole else _SEGMENT.findall(marked)

    def encode_all(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment as 32-bit integers; of equal sums the one with the longest last piece, then before it."""
        raw = [s.encode() for s in segments]
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = np.cumsum([0, *map(len, raw)])
        # Node p + segment stands before byte p; each segment has one more for its end.
        owner = np.repeat(np.arange(len(raw)), np.diff(first))
        char = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.diff(np.append(char, len(data)))
        stop = first[owner[char] + 1]
        who, length, piece = self.trie.matches(data, char, stop)
        known = np.zeros(len(char), bool)
        known[who[length == width[who]]] = True
        lone = np.flatnonzero(~known)
        who = np.concatenate([who, lone])
        length = np.concatenate([length, width[lone]])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        gain = np.where(piece >= 0, self.score[piece], self.unknown_score)
        begin = char[who]
        order = np.argsort(begin - first[owner[begin]], kind="stable")
        begin, length, piece, gain = begin[order], length[order], piece[order], gain[order]
        offset = begin - first[owner[begin]]
        source, target = begin + owner[begin], begin + owner[begin] + length
        best = np.full(len(data) + len(raw), -np.inf)
        best[first[:-1] + np.arange(len(raw))] = 0
        back, chosen = np.zeros(len(best), np.int64), np.full(len(best), -1)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(offset)) + 1, [len(offset)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            # Pieces from one place of a segment end at different places: no target repeats.
            reached = best[source[a:b]] + gain[a:b]
            better = np.flatnonzero(reached > best[target[a:b]]) + a
            to = target[better]
            best[to], back[to], chosen[to] = reached[better - a], source[better], piece[better]
        return self._traced(first + np.arange(len(first)), back, chosen, data, owner, len(raw))

    def _traced(self, nodes, back, chosen, data, owner, count: int) -> list[bytes]:
        """Follow the best pieces back from the ends of all segments at once."""
        at = nodes[1:] - 1  # the end node of each segment
        start = nodes[:-1]
        who = np.arange(count)[at > start]
        at = at[at > start]
        steps = []
        while len(who):
            steps.append((who, back[at], at, chosen[at]))
            at = back[at]
            more = at > start[who]
            who, at = who[more], at[more]
        if not steps:
            return [b""] * count
        who, low, high, piece = (np.concatenate(x[::-1]) for x in zip(*steps))
        lone = piece < 0
        if lone.any() and self.bytes is not None:
            times = np.where(lone, high - low, 1)
            from_ = np.repeat(np.arange(len(who)), times)
            nth = np.arange(len(from_)) - np.repeat(np.cumsum(times) - times, times)
            byte = data[np.minimum(low[from_] - who[from_] + nth, len(data) - 1)]
            piece = np.where(lone[from_], self.bytes[byte], piece[from_])
            who = who[from_]
        elif lone.any():
            piece = np.where(lone, self.unknown, piece)
        order = np.argsort(who, kind="stable")
        ids = piece[order].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(who, minlength=count))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_batch(self, texts: list[str | None], known: dict[str, bytes]) -> list[bytes | None]:
        """Ids of each text as 32-bit integers; ``known`` keeps segments between calls."""
        cut = [None if t is None else self.segments(t) for t in texts]
        new = [s for s in dict.fromkeys(s for segs in cut if segs for s in segs) if s not in known]
        fresh: dict[str, bytes] = {}
        at = 0
        while at < len(new):
            until, size = at, 0
            while until < len(new) and (until == at or size < _UNIT):
                size += len(new[until])
                until += 1
            fresh.update(zip(new[at:until], self.encode_all(new[at:until])))
            at = until
        if len(known) + len(fresh) > _KEPT:
            needed = {s: known[s] for segs in cut if segs for s in segs if s in known}
            known.clear()
            known.update(needed)
        known.update(fresh)
        return [None if segs is None else b"".join(map(known.__getitem__, segs)) for segs in cut]

    def decode(self, ids) -> str:
        """The text of ids: markers become spaces, the first one goes, bytes are joined."""
        raw = b"".join(map(self.spelled.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def encoded(docs: DataFrame, vocabulary: Vocabulary, rows: int = 256) -> DataFrame:
    """``doc_id, ids`` of each row of ``docs(doc_id, text, ...)``, from its whole text.

    A null text has null ids, an empty one none. A marker in a text counts as a space. The
    vocabulary travels with the tasks; it alone bounds what they hold, besides ``rows`` texts.
    """
    struct = schema_of("doc_id bigint, ids array<int>")

    def run(batches):
        known: dict[str, bytes] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = vocabulary.encode_batch(part.column("text").to_pylist(), known)
                sizes = np.array([len(x) // 4 if x is not None else 0 for x in found])
                values = pa.array(np.frombuffer(b"".join(x for x in found if x), np.int32))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                null = pa.array([x is None for x in found])
                ids = pa.ListArray.from_arrays(ends, values, mask=null)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, struct)


def decoded(encoded_rows: DataFrame, vocabulary: Vocabulary, rows: int = 256) -> DataFrame:
    """``doc_id, ids, text`` of each row of ``encoded_rows(doc_id, ids, ...)``; null ids give a null text."""
    struct = schema_of("doc_id bigint, ids array<int>, text string")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column("ids")
                null = ids.is_null().to_pylist()
                ends = np.cumsum([n or 0 for n in ids.value_lengths().to_pylist()]).tolist()
                values = ids.flatten().to_numpy()
                texts = [
                    None if none else vocabulary.decode(values[a:b].tolist())
                    for none, a, b in zip(null, [0, *ends], ends)
                ]
                columns = [part.column("doc_id"), ids, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    return encoded_rows.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, struct)
