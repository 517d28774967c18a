import hashlib
import random
import zlib

import numpy as np
import pytest

from tally.llm.periods import digests, looped, periodic_runs, runs, window_minima
from tally.llm.words import mixed


def brute(words):
    """(start, length, period) of all runs, from every lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words = [f"w{rng.randrange(rng.choice([2, 3, 6, 900]))}" for _ in range(rng.choice([0, 3, 25, 120, 300, 700]))]
    for _ in range(rng.randrange(4)):
        if len(words) > 12:
            a = rng.randrange(len(words))
            p, end = rng.randint(1, max(1, (len(words) - a) // rng.randint(2, 6))), rng.randint(a, len(words))
            words = [words[a + (i - a) % p] if a <= i < end else w for i, w in enumerate(words)]
    return words


def test_window_minima_are_the_first_of_the_smallest():
    rng = np.random.default_rng(2)
    for width in (1, 4, 8):
        value = mixed(rng.integers(0, 40, 301).astype(np.uint64))
        least = {i + int(np.argmin(value[i : i + width])) for i in range(len(value) - width + 1)}
        assert window_minima(value, width).tolist() == sorted(least)
    assert not len(window_minima(np.zeros(3, np.uint64), 4))


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        names = {w: i for i, w in enumerate({w for t in texts for w in t})}
        hashed = mixed(np.array([names[w] + 1 for t in texts for w in t], np.uint64))
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        expected = [(int(f) + s, int(f) + s + n, q) for t, f in zip(texts, first) for s, n, q in brute(t)]
        assert [tuple(r) for r in runs(hashed, first).tolist()] == sorted(expected, key=lambda r: (r[0], r[2]))


def test_query_equals_brute_force(spark, documents):
    rng = random.Random(12)
    rows = [(i, "  ".join(some_words(rng)) + rng.choice(["", "\n", "\tend"])) for i in range(150)]
    rows += [(None, "a b " * 9), (7001, None), (7002, ""), (7003, " \t\n"), (7004, "one")]
    rows += [(8000, "né ü né ü né ü né ü né ü"), (3, rows[3][1]), (3, rows[3][1])]  # repeated rows
    rows += [(8001, "x " * 60_000), (8002, "a b c d e f g h i j k l m " * 9_000)]  # very long
    expected = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        if doc_id is not None and words:
            h = zlib.crc32(str(doc_id).encode())
            n, g = len(words), h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if len(words) > 5_000:  # one run, known without comparing every lag
            period = 1 if words[0] == "x" else 13
            found = [(0, len(words), period)]
        else:
            found = brute(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept(words, found))]
        expected.append((doc_id, len(found), *best, milli, *sums))
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows[:150])
    got = [tuple(r) for r in digests(periodic_runs(looped(documents(rows)))).collect()]

    def key(row):
        return (row[0] is None, row[0] or 0, row[1:2])

    assert sorted(got, key=key) == sorted(expected, key=key)


def test_outputs_and_carried_columns(documents):
    docs = documents([(1, "go stop " * 4 + "end"), (2, None)])
    rows = {r.doc_id: r for r in periodic_runs(docs, carry=("doc_id", "lang", "size")).collect()}
    assert rows[1].n_words == 9 and rows[1].kept_text == "go stop end" and rows[1].lang == "xx"
    assert [tuple(r) for r in rows[1].runs] == [(0, 8, 2)]
    assert (rows[2].n_words, rows[2].runs, rows[2].kept_text) == (0, [], "")
    with pytest.raises(ValueError, match="names of outputs"):
        periodic_runs(docs.withColumnRenamed("lang", "runs"), carry=("doc_id", "runs"))


def test_empty_table(documents):
    assert digests(periodic_runs(looped(documents([])))).collect() == []
