"""Near-duplicates, repeated passages and repeated lines against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from tally.llm.language import predicted
from tally.llm.lines import without_later_lines
from tally.llm.minhash import Banding, near_duplicates, one_of_each
from tally.llm.quality import scored
from tally.llm.substrings import without_repeats
from tests.llm.conftest import reachable

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (800, None), (801, ""), (802, " \t\n"), (803, "one"), (804, "ONE"), (805, "one two"), (806, "two  ONE"),
    (807, "\x85   ü Ü"), (None, "a text without an id but words"), (None, None), (808, "w" * 3000),
]


def prose(draw, n):
    return [f"{draw.choice('abcdefgh')}{draw.randrange(40)}" for _ in range(n)]


def edited(draw, words, share):
    return [f"new{draw.randrange(10**6)}" if draw.random() < share else w for w in words]


def corpus(seed):
    """Texts, copies of them with more or fewer edits, shared passages, and repeated rows."""
    draw = random.Random(seed)
    rows, originals = [], [prose(draw, draw.randrange(40, 120)) for _ in range(8)]
    passage = prose(draw, 20)
    for n, words in enumerate(originals):
        for share in (0, 0, 0.01, 0.02, 0.04, 0.08):
            own = edited(draw, words, share)
            if n % 2:
                own = own[:10] + passage + own[10:]
            lines = [" ".join(own[i : i + 7]) for i in range(0, len(own), 7)]
            rows.append((len(rows), "\n".join(lines).upper() if draw.random() < 0.2 else "\n".join(lines)))
    rows += [rows[3], (rows[5][0], rows[6][1])]  # a repeated row, and a repeated id
    rows.append((700, " ".join(prose(draw, 20_000))))
    return rows + ODD


def shingle_set(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def brute_classes(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    root = reachable(range(len(rows)), links)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(least.get(root[i], 10**9), doc_id)
    return [(rows[i][0], len(sets[i]), least.get(root[i]), rows[i][0] == least.get(root[i])) for i in range(len(rows))]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("size,percent,tile", [(3, 85, 256), (5, 80, 2)])
def test_near_duplicates(documents, size, percent, tile):
    rows = corpus(1)
    expected = brute_classes(rows, size, percent)
    assert 3 < sum(not kept for *_, kept in expected)
    got = near_duplicates(documents(rows), Banding(size=size, percent=percent, tile=tile))
    assert ordered(tuple(r)[:4] for r in got.collect()) == ordered(expected)


def test_one_document_of_each_group(documents):
    rows = corpus(2)
    kept = one_of_each(documents(rows), Banding()).select("doc_id", "text").collect()
    expected = [row for row, (*_, keep) in zip(rows, brute_classes(rows, 5, 80)) if keep]
    assert ordered(map(tuple, kept)) == ordered(expected)


def brute_repeats(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, text), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), None if text is None else kept))
    return out


@pytest.mark.parametrize("window,edge", [(12, 4), (8, 8), (2, 1)])
def test_repeated_passages(documents, window, edge):
    rows = corpus(3) + [(900, "x y " * 30), (901, "z " * 12)]  # repeats inside one text
    got = without_repeats(documents(rows), window=window, edge=edge).collect()
    assert ordered(map(tuple, got)) == ordered(brute_repeats(rows, window))


def brute_lines(rows, run):
    places = []
    for at, (doc_id, text) in enumerate(rows):
        lines = (text or "").split("\n")
        filled = [i for i, line in enumerate(lines) if line.strip()]
        for p in range(len(filled) - run + 1):
            key = tuple(lines[i] for i in filled[p : p + run])
            places.append((key, (doc_id is not None, doc_id or 0), at, p, filled[p : p + run]))
    first = {}
    for key, doc, at, p, _ in places:
        # Rows with the same id and text count as one document.
        first[key] = min(first.get(key, ((True, 10**9), "", 0)), (doc, rows[at][1], p))
    gone = {}
    for key, doc, at, p, lines in places:
        if (doc, rows[at][1], p) != first[key]:
            gone.setdefault(at, set()).update(lines)
    out = []
    for at, (doc_id, text) in enumerate(rows):
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        lines, drop = text.split("\n"), gone.get(at, set())
        out.append((doc_id, len(lines), len(drop), "\n".join(x for i, x in enumerate(lines) if i not in drop)))
    return out


@pytest.mark.parametrize("gram,window", [(1, 2), (2, 2), (1, 1)])
def test_repeated_lines(documents, gram, window):
    rows = [r for i, r in enumerate(corpus(4)) if i != 49]  # ids with two texts have no fixed order
    rows += [(950, "a\n\nb\na\nb\n \na\nb"), (951, "b\na\nc"), (952, "a\nb")]
    got = without_later_lines(documents(rows), gram=gram, window=window).collect()
    assert ordered(map(tuple, got)) == ordered(brute_lines(rows, gram + window - 1))


def test_no_documents(documents):
    none = documents([])
    assert near_duplicates(none).collect() == []
    assert without_repeats(none).collect() == []
    assert without_later_lines(none).collect() == []


def test_kept_text_of_the_query(spark):
    from tally.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    expected = {
        (i, n, m, hashlib.sha256((kept or "").encode()).hexdigest()) for i, n, m, kept in brute_repeats(texts, 35)
    }
    assert {tuple(r) for r in QUERIES["op7_substring_dedup"](spark, d).collect()} == expected


def test_a_line_between_differing_neighbours_goes_but_for_its_first_place(documents):
    line = "All rights reserved"
    rows = [(1, f"one\n{line}\ntwo"), (2, f"three\n\n{line}\nfour"), (3, line), (4, f"{line}\nfive\n{line}"), (5, "six")]
    got = {r.doc_id: r.kept_text for r in without_later_lines(documents(rows), gram=1, window=1).collect()}
    assert got == {1: f"one\n{line}\ntwo", 2: "three\n\nfour", 3: "", 4: "five", 5: "six"}


def test_ten_thousand_repeats_of_a_row(documents):
    text = "one copy of a row is compared however often it stands in the table"
    rows = [(7, text)] * 10_000 + [(3, text + " again"), (9, "nothing like the others in any of its words")]
    found = near_duplicates(documents(rows), Banding(size=3, percent=85)).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(7, 3), (3, 3), (9, 9)}
    assert sum(r.kept for r in found) == 2


@pytest.mark.parametrize("operator,output", [
    (without_later_lines, "kept_text"), (without_repeats, "n_words"),
    (lambda docs, carry: predicted(docs, None, carry), "lang_pred"),
    (lambda docs, carry: scored(docs, None, carry), "score"),
])
def test_a_carried_column_may_not_name_an_output(documents, operator, output):
    docs = documents([(1, "a text")]).withColumnRenamed("source", output)
    with pytest.raises(ValueError, match=output):
        operator(docs, carry=("doc_id", output))
