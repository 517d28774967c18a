"""Shards, packing and pieces: brute force, exact round trips, every token in one place."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm.packing import Sizes, best_fit, packed
from tally.llm.pieces import MARK, DoubleArray, Vocabulary, decoded, encoded
from tally.llm.queries import PIECES
from tally.llm.sharding import shards

ODD = [(900, None), (901, ""), (None, "no id"), (None, None), (902, " \n"), (903, "y" * 40_000)]


def corpus(seed, n=300):
    draw = random.Random(seed)
    rows = [(i, " ".join("w" * draw.randrange(1, 9) for _ in range(draw.randrange(1, 60)))) for i in range(n)]
    rows += [(1000 + i, "the same text " * 5) for i in range(n // 2)]  # a third of all rows
    return rows + [rows[7], rows[7], (8, rows[9][1])] + ODD


def brute_shards(spark, rows, count):
    """Records in the order of their hashes, each where its middle lies."""
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.xxhash64("text"))
    keyed = frame.withColumn("tie", F.xxhash64("doc_id", "key")).collect()
    keyed.sort(key=lambda r: (r.key, r.tie))
    size = [len((r.text or "").encode()) + 16 for r in keyed]
    out, at, total, slots = [], 0, sum(size), defaultdict(int)
    for r, s in zip(keyed, size):
        shard = min((2 * at + s) * count // (2 * total), count - 1)
        out.append((r.doc_id, s, None if r.text is None else zlib.crc32(r.text.encode()), shard, slots[shard]))
        slots[shard] += 1
        at += s
    return out


@pytest.mark.parametrize("sample", [8192, 30])
def test_shards(spark, documents, sample):
    rows = corpus(1)
    got = shards(documents(rows), 12, sample=sample).collect()
    found = sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=str)
    assert found == sorted(brute_shards(spark, rows, 12), key=str)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    bytes_ = defaultdict(int)
    for r in got:
        bytes_[r.shard] += r.size
    mean, longest = sum(bytes_.values()) / 12, max(r.size for r in got)
    assert all(abs(b - mean) <= longest for b in bytes_.values())


def test_rows_that_repeat_are_spread_as_well(documents):
    short = [row for row in corpus(3) if len(row[1] or "") < 600]
    rows = shards(documents([(None, "")] * 10_000 + short), 40).collect()
    assert len(rows) == 10_000 + len(short)
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert len(slots) == 40 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / 40
    assert max(abs(s - mean) for s in size.values()) <= 616  # less than the records at both ends


def test_shards_of_nothing_and_of_one(documents):
    assert shards(documents([]), 4).collect() == []
    [row] = shards(documents([(1, "x")]), 4).collect()
    assert (row.size, row.slot) == (17, 0)
    with pytest.raises(ValueError):
        shards(documents([]), 0)


SIZES = Sizes(lengths=(8, 16, 64), fixed=2, quadratic=1 / 128)


def test_every_token_is_packed_once(documents):
    rows = corpus(2)
    got = best_fit(documents(rows), SIZES, group=100).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        if r.length:
            pieces[r.doc_id].append((r.piece, r.start, r.length))
            bins[r.bin].append((r.offset, r.length, r.capacity))
        else:
            assert (r.piece, r.start, r.bin, r.offset, r.capacity) == (0, 0, None, None, None)
    assert sum(not r.length for r in got) == sum(t is None for _, t in rows)
    expected = defaultdict(list)
    for doc_id, text in rows:
        if text is not None:
            n = len(text.split()) + 1
            expected[doc_id] += [(p, p * 64, min(64, n - p * 64)) for p in range(-(-n // 64))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    for items in bins.values():
        at = 0
        for offset, length, capacity in sorted(items):
            assert offset == at
            at += length
        assert {c for *_, c in items} == {SIZES.cheapest(at)}


def slow_best_fit(lengths, sizes):
    """The bins' contents tried one by one; of equally full bins the one filled last is taken."""
    bins, where = [], {}  # a bin: size opened, tokens in it, step of its last piece
    left = sum(lengths)
    for step, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        n = lengths[i]
        fitting = [(size - used, -last, b) for b, (size, used, last) in enumerate(bins) if size - used >= n]
        if fitting:
            b = min(fitting)[2]
        else:
            per_token = {}
            for size in sizes.lengths:
                if size >= n:
                    cost = sizes.fixed + size + sizes.quadratic * size * size
                    per_token[size] = cost / min(size, left)
            b = len(bins)
            bins.append((min(per_token, key=lambda size: (per_token[size], size)), 0, step))
        size, used, _ = bins[b]
        where[i] = (b, used)
        bins[b] = (size, used + n, step)
        left -= n
    final = [
        min((sizes.fixed + c + sizes.quadratic * c * c, c) for c in sizes.lengths if c >= used)[1] for _, used, _ in bins
    ]
    return [(*where[i], final[where[i][0]]) for i in range(len(lengths))]


@pytest.mark.parametrize("sizes", [Sizes(), SIZES, Sizes((7,)), Sizes((3, 50, 51), fixed=0.0, quadratic=1.0)])
def test_packing_against_slow_best_fit(sizes):
    draw = random.Random(11)
    largest = sizes.lengths[-1]
    for _ in range(60):
        few = draw.choice([3, 20, largest])  # many ties, or hardly any
        lengths = [draw.randint(1, min(few, largest)) for _ in range(draw.randrange(0, 200))]
        got = packed(np.array(lengths, np.int64), sizes)
        assert [tuple(map(int, row)) for row in zip(*got)] == slow_best_fit(lengths, sizes)


def test_packing_is_tight():
    draw = np.random.default_rng(3)
    lengths = draw.integers(1, 65, 5000)
    bin_, _, capacity = packed(lengths, SIZES)
    cost = sum(SIZES.cost(c) for c in dict(zip(bin_.tolist(), capacity.tolist())).values())
    # No token costs less than in the cheapest size that its piece fits into.
    least = sum(n * min(SIZES.cost(c) / c for c in SIZES.lengths if c >= n) for n in lengths.tolist())
    assert cost <= 1.1 * least


def test_several_sizes_beat_one():
    lengths = np.minimum(np.random.default_rng(4).geometric(0.1, 5000), 64)
    bin_, _, capacity = packed(lengths, SIZES)
    cost = sum(SIZES.cost(c) for c in dict(zip(bin_.tolist(), capacity.tolist())).values())
    one = Sizes(lengths=(64,), fixed=2, quadratic=1 / 128)
    alone, _, _ = packed(lengths, one)
    assert cost < 0.95 * one.cost(64) * len(set(alone.tolist()))


def test_packing_follows_costs():
    long_is_cheap, short_is_cheap = Sizes((4, 16), 100.0, 0.0), Sizes((4, 16), 0.0, 1.0)
    assert set(packed(np.array([4, 4, 4, 4]), long_is_cheap)[2]) == {16}
    assert set(packed(np.array([4, 4, 4, 4]), short_is_cheap)[2]) == {4}
    assert packed(np.array([3]), long_is_cheap)[2].tolist() == [4]  # shrunk to its contents
    assert len(packed(np.zeros(0, int), SIZES)[0]) == 0
    with pytest.raises(ValueError):
        Sizes(lengths=(8, 4))


def test_nothing_to_pack(documents):
    assert best_fit(documents([])).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(PIECES)


TEXTS = [
    "", " ", "  a  b\n c", "é\tx", " lead", "trail ", "漢𝄞 字", "Á ﬁ ①", "a" * 17 + "  " * 20, "x" * 5000,
    "The quick brown fox", "\x00\x01", "naïve façade — 12,345 %%% $$$", "🙂🙂 end",
]


def test_round_trip(spark, vocabulary):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "x"), (99, None)]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id bigint, text string, ids string, piece string")
    got = decoded(encoded(docs, vocabulary, rows=4), vocabulary).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    assert all((r.ids is None) == (r.text is None) for r in got)
    assert encoded(docs.limit(0), vocabulary).collect() == []


def test_a_marker_counts_as_a_space(vocabulary):
    [ids] = vocabulary.encode_batch([f"a{MARK}b"], {})
    [same] = vocabulary.encode_batch(["a b"], {})
    assert ids == same


def slow_best(vocabulary, segment):
    """The largest sum of scores over all ways to cut a segment."""
    number = {p: i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if k == "n"}
    best = [0.0] + [-np.inf] * len(segment)
    for end in range(1, len(segment) + 1):
        for start in range(max(0, end - 20), end):
            piece = segment[start:end]
            if piece in number:
                best[end] = max(best[end], best[start] + vocabulary.scores[number[piece]])
            elif end == start + 1:
                best[end] = max(best[end], best[start] + vocabulary.unknown_score)
    return best[-1]


def test_the_best_sum_is_found(vocabulary):
    draw = random.Random(5)
    segments = list({MARK + "".join(draw.choice("abehinorst,.éè①漢") for _ in range(draw.randrange(1, 15))) for _ in range(200)})
    for segment, raw in zip(segments, vocabulary.encode_all(segments)):
        total, unknown = 0.0, 0
        for i in np.frombuffer(raw, np.int32):
            if vocabulary.kinds[i] == "b":
                unknown += 1
            else:
                total += vocabulary.scores[i]
        lone = sum(c not in vocabulary.pieces for c in segment)
        assert total + lone * vocabulary.unknown_score == slow_best(vocabulary, segment)
        assert vocabulary.decode(np.frombuffer(raw, np.int32)) == segment.removeprefix(MARK)
        assert (unknown > 0) == (lone > 0)


def test_agrees_with_a_library(vocabulary):
    """Another unigram encoder, given the same pieces."""
    from tokenizers import Tokenizer, models

    scores = [s if k == "n" else -1e12 for s, k in zip(vocabulary.scores, vocabulary.kinds)]
    library = Tokenizer(models.Unigram(list(zip(vocabulary.pieces, scores)), 0, True))
    words = "the thinonat hetiin ereast Über naïve internationalisation zzz queryable Ouréeux 漢字x éa".split()
    for word, ids in zip(words, vocabulary.encode_batch(words, {})):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(MARK + word).ids


def test_double_array():
    keys = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff\x00": 4}
    trie = DoubleArray(keys)
    data = np.frombuffer(b"abcab\xff\x00", np.uint8)
    start = np.arange(len(data))
    who, length, value = trie.matches(data, start, np.full(len(data), len(data)))
    found = {(int(w), int(n), int(v)) for w, n, v in zip(who, length, value)}
    raw = data.tobytes()
    assert found == {(i, len(k), v) for k, v in keys.items() for i in range(len(raw)) if raw.startswith(k, i)}
