"""Runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from heatgrid.llm import periodic


def plain_runs(words):
    """All runs, period by period; a stretch that a smaller period covers too is that period's."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def numbered(words):
    numbers = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def noisy_repeats(rng):
    words = []
    for _ in range(rng.randint(1, 8)):
        letters = "ab" if rng.random() < 0.5 else [str(i) for i in range(40)]
        root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 16, 17, 31, 33, 40]))]
        if rng.random() < 0.3:
            root = root * rng.randint(1, 5) + [rng.choice(letters)]
        words += root * rng.randint(1, 6) + root[: rng.randint(0, len(root))]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_a_plain_search(seed):
    rng = random.Random(seed)
    texts = [noisy_repeats(rng) for _ in range(25)]
    found = periodic.runs_of([numbered(words) for words in texts])
    for words, runs in zip(texts, found):
        assert runs == plain_runs(words), words


def test_texts_of_two_words_only():
    rng = random.Random(5)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 400))] for _ in range(60)]
    assert periodic.runs_of([numbered(words) for words in texts]) == [plain_runs(words) for words in texts]


def test_fibonacci_words_and_periods_within_periods():
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    inner = (["x"] * 30 + ["y"]) * 5
    texts = [list(b), inner * 4 + inner[:17], [str(i) for i in range(500)] * 4, ["w"] * 5000]
    found = periodic.runs_of([numbered(words) for words in texts])
    assert found[0] == plain_runs(texts[0])
    assert found[1] == plain_runs(texts[1])
    assert found[2] == [(0, 2000, 500)]
    assert found[3] == [(0, 5000, 1)]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


def digests(docs):
    return sorted(map(tuple, periodic.run_digests(periodic.periodic_runs(periodic.planted(docs))).collect()), key=str)


def test_query_columns_equal_a_plain_version(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(noisy_repeats(rng))) for i in range(300)]
    rows += [(301, "é " * 9 + " x  x\x1cy " * 6), (302, "a b " * 3 + "\t\x0b" + "a b " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert digests(docs) == sorted((plain_row(i, t) for i, t in rows), key=str)


def test_odd_rows(odd, odd_rows):
    rows = [row for row in odd_rows if len(row[1] or "") < 10_000]
    assert digests(odd.where("text is null or length(text) < 10000")) == sorted((plain_row(i, t) for i, t, _ in rows), key=str)
    assert len(digests(odd)) == len(odd_rows)


def test_a_run_through_a_whole_long_text(table):
    """Twenty thousand words whose last three quarters repeat seventeen hundred."""
    head = [f"h{i}" for i in range(5_000)]
    root = [f"r{i % 1700}" for i in range(15_000)]
    row = periodic.periodic_runs(table([(7, " ".join(head + root), "a")])).first()
    assert [tuple(run) for run in row.runs] == [(5_000, 15_000, 1700)]
    assert row.collapsed.decode() == " ".join(head + root[:1700])


def test_no_rows(empty):
    assert digests(empty) == []
