import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tally.llm.bytebpe import ByteBpe
from tally.llm.vectorpack import _LEAST_CUT, Limits, fill, packed, packed_documents, padded

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n\n", "a", " a  b\tc\n", "x " * 3000, "word" * 2000, "nbsp\xa0 \xa0x　  y\x1c z\x85 w",
    "it's <|endoftext|> over <|endoftext|>", "né 日本語 テスト \U0001f600 \x00 ok", "tail   ", "1234 5,678 ... !!! \r\n\r\n  q",
]


def slow(lengths, losses, limits):
    """Piece by piece, comparing every waiting one."""
    loss = [[1] * n if own is None else [int(x) for x in own] for n, own in zip(lengths, losses)]
    waiting = [(p, 0, n) for p, n in enumerate(lengths) if n]
    order = list(range(len(waiting)))
    count = len(waiting)
    most = (limits.tokens, limits.segments, limits.loss)
    demand = (sum(lengths), count, sum(map(sum, loss)))
    weight = [float(d) / float(m) / float(m) ** 2 for d, m in zip(demand, most)]
    done = []
    while waiting:
        left, held = list(most), []
        while left[0] and left[1]:
            def rank(i):
                p, a, b = waiting[i]
                n, own = b - a, sum(loss[p][a:b])
                return (weight[0] * n * left[0] + weight[1] * left[1] + weight[2] * own * left[2], n, own, -order[i])

            whole = [i for i, (p, a, b) in enumerate(waiting) if b - a <= left[0] and sum(loss[p][a:b]) <= left[2]]
            if whole:
                i = max(whole, key=rank)
                p, a, to = waiting.pop(i)
                order.pop(i)
            else:
                able = [i for i, (p, a, b) in enumerate(waiting) if loss[p][a] <= left[2]]
                if not able:
                    break
                i = max(able, key=rank)
                p, a, b = waiting[i]
                to = a
                while to < b and to - a < left[0] and sum(loss[p][a : to + 1]) <= left[2]:
                    to += 1
                if held and to - a < min(left[0], _LEAST_CUT):
                    break
                waiting[i], order[i] = (p, to, b), count
                count += 1
            held.append((p, a, to))
            left = [left[0] - (to - a), left[1] - 1, left[2] - sum(loss[p][a:to])]
        used = most[0] - left[0]
        beyond = 0 if used == most[0] else used - 2 ** (used.bit_length() - 1)
        while beyond:
            p, a, b = held.pop()
            cut = max(a, b - beyond)
            beyond -= b - cut
            waiting.append((p, cut, b))
            order.append(count)
            count += 1
            if cut > a:
                held.append((p, a, cut))
        done.append(held)
    return done


def check(found, lengths, losses, limits):
    cover = [[] for _ in lengths]
    for held in found:
        used = sum(b - a for _, a, b in held)
        assert 0 < used <= limits.tokens and len(held) <= limits.segments and padded(used, limits) == 0
        bearing = sum(b - a if losses[p] is None else int(sum(losses[p][a:b])) for p, a, b in held)
        assert bearing <= limits.loss
        for p, a, b in held:
            cover[p] += range(a, b)
    assert [sorted(own) for own in cover] == [list(range(n)) for n in lengths]


@pytest.mark.parametrize("limits", [Limits(64, 5, 64), Limits(64, 64, 20), Limits(50, 3, 17), Limits(1, 1, 1)])
def test_filling_equals_the_slow_one(limits):
    rng = random.Random(limits.segments)
    for trial in range(12):
        lengths = [rng.choice([0, 1, 2, 7, 30, limits.tokens]) for _ in range(rng.choice([0, 1, 40]))]
        lengths = [min(n, limits.tokens) for n in lengths]
        losses = []
        for n in lengths:
            mask, bears = [], rng.random() < 0.5
            while len(mask) < n:  # turns of some tokens
                mask += [bears] * rng.randint(1, 12)
                bears = not bears
            losses.append(np.array(mask[:n], bool) if trial % 3 and rng.random() < 0.7 else None)
        found = fill(lengths, losses, limits)
        check(found, lengths, losses, limits)
        assert found == slow(lengths, losses, limits)


def test_ids_are_those_of_the_tokenizer():
    tokenizer, cached = Tokenizer.from_file(PATH), ByteBpe(PATH)
    rng = random.Random(4)
    d = "/root/testdata/sf0.001/documents.parquet"
    for text in pq.read_table(d, columns=["text"]).column(0).to_pylist():
        assert cached.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    texts = ODD + ["".join(rng.choice(" \n\ta1.é\xa0 'sß日\x1f") for _ in range(60)) for _ in range(400)]
    texts += [chr(rng.randrange(0xD800)) * 3 + " " + chr(rng.randrange(0x10000, 0x1FFFF)) for _ in range(2000)]
    for text in texts:
        assert cached.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_query_covers_every_id_once(spark, documents):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(i, text) for i, text in enumerate(ODD)] + [(900, None), (None, "no id"), (None, None)]
    rows += [(500 + i, "short text of some words " * (i % 30)) for i in range(90)]
    ids = {}
    for doc_id, text in rows:
        ids[doc_id] = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
    limits = Limits(2048, 16, 2048)
    found = packed_documents(documents(rows), PATH, limits, group=32).collect()
    for r in found:
        assert len(r.ids) == r.length and r.loss is None
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    bare = packed_documents(documents(rows), PATH, limits, group=32, with_ids=False).collect()
    assert [tuple(r) for r in bare] == [(*r[:4], *r[6:]) for r in found]
    parts, sequences = {}, {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id is not None:
            own = ids[r.doc_id]
            assert r.doc_tokens == len(own)
            assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
            parts.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc_id, own in ids.items():
        if doc_id is not None:
            at = 0
            for start, length in sorted(parts[doc_id]):
                assert start == at
                at += length
            assert at == len(own)
    assert sum(r.length for r in found if r.doc_id is None) == len(ids[None]) + len(
        tokenizer.encode("no id", add_special_tokens=False).ids
    ) + 1
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and len(own) <= 16 and padded(at, limits) == 0


def test_instruction_turns_keep_their_loss_masks(spark):
    """Turns of users bear no loss; a sequence holds no more loss than allowed."""
    rng = random.Random(8)
    rows, expected = [], {}
    for i in range(200):
        n = rng.randint(0, 60)
        ids, loss = [rng.randrange(50_000) for _ in range(n)], None if i % 7 == 0 else [i % 2 == 1] * n
        rows.append((i, "assistant" if i % 2 else "user", 0, ids if i else None, loss))
        expected[i] = [(x, True if loss is None else loss[0]) for x in ids] if i else []
    turns = spark.createDataFrame(rows * 2, "turn bigint, role string, start bigint, ids array<int>, loss array<boolean>")
    limits = Limits(128, 6, 48)
    found = packed(turns.repartition(3, "turn"), limits).collect()
    sequences, parts = {}, {}
    for r in found:
        bears = [True] * r.length if r.loss is None else r.loss
        assert len(r.ids) == r.length == len(bears) and r.role == ("assistant" if r.turn % 2 else "user")
        sequences.setdefault(r.sequence_id, []).append((r.length, sum(bears)))
        parts.setdefault(r.turn, []).extend(zip(range(r.start, r.start + r.length), r.ids, bears))
    for own in sequences.values():
        assert sum(n for n, _ in own) <= 128 and len(own) <= 6 and sum(b for _, b in own) <= 48
    for turn, own in expected.items():
        twice = sorted((i, x, b) for i, (x, b) in enumerate(own) for _ in range(2))
        assert sorted(parts.get(turn, [])) == twice


def test_empty_tables_and_clashing_names(spark, documents):
    assert packed_documents(documents([]), PATH).collect() == []
    pieces = spark.createDataFrame([("x", 0, [5, 6, 1]), ("y", 0, None), ("z", 0, [])], "group string, start int, ids array<int>")
    assert packed(pieces.limit(0)).collect() == []
    with pytest.raises(ValueError, match="names of outputs"):
        packed(pieces.withColumn("offset", F.lit(1)))
    with pytest.raises(ValueError, match="positive"):
        Limits(0)
    with pytest.raises(Exception, match="longer than the 2 tokens"):
        packed(pieces, Limits(2)).collect()
    kept = packed(pieces).collect()
    assert sum(r.length for r in kept) == 3 and {r.group for r in kept} == {"x"} and "loss" not in kept[0]
