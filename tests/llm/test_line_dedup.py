"""Boilerplate lines against exact counts in Python."""

import random
import re
from collections import defaultdict

import pytest

from heatgrid.llm import line_dedup

SPACE = r"[\x20\x09-\x0D]"


def wordy(line, words=3):
    return len([w for w in re.split(SPACE, line) if w]) >= words


def expected(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc_id, text, site in rows:
        for line in (text or "").split("\n"):
            if wordy(line):
                sites[line].add(site or "")
                key = (doc_id is None, doc_id)
                first[line] = min(first.get(line, key), key)
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if not wordy(x) or len(sites[x]) < min_sites or first[x] == (doc_id is None, doc_id)]
        out.append((doc_id, text if left == lines else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.row.doc_id, r.clean_text, r.n_lines, r.n_removed) for r in df.collect()), key=repr)


def test_spread_over_sites(table):
    """Lines on every number of sites around the threshold, repeated within documents, and first holders."""
    rng = random.Random(8)
    lines = [f"shared line number {n}" for n in range(25)]
    rows = []
    for doc in range(300):
        site = doc % 20
        own = [f"own words of document {doc}", "", "two words"]
        # Line n is on about n sites.
        own += [line for n, line in enumerate(lines) if site < n and rng.random() < 0.7] * rng.choice([1, 1, 2])
        rng.shuffle(own)
        rows.append((doc, "\n".join(own), f"site{site}"))
    assert found(line_dedup.clean(table(rows), min_sites=10)) == expected(rows, 10)


@pytest.mark.parametrize("min_sites", [2, 3])
def test_odd_rows(odd, odd_rows, min_sites):
    got = line_dedup.clean(odd, min_sites=min_sites)
    assert found(got) == expected(odd_rows, min_sites)
    assert {r.row.kept for r in got.collect()} == {True} and got.schema["row"].dataType == odd.schema


def test_estimates_far_above_the_margin_and_none(table, empty):
    rows = [(i, "a line on many sites\nmine %d is kept" % i, f"s{i}") for i in range(3000)]
    assert found(line_dedup.clean(table(rows), min_sites=1500)) == expected(rows, 1500)
    assert line_dedup.clean(empty).count() == 0


def kept_in(df, line):
    return sum(line in r.clean_text.split("\n") for r in df.collect())


def test_long_passages_on_few_sites_beside_a_hot_source(table):
    """One of 20 sources holds a third of the rows; passages of 60 words stand on 4 to 9 sites, many times on the hot one."""
    rng = random.Random(3)
    passages = {n: " ".join(f"p{n}w{i}" for i in range(60)) for n in range(4, 10)}
    shorter = " ".join(f"s{i}" for i in range(40))
    rows = [(doc, f"own words of document {doc}", "hot" if doc % 3 == 0 else f"site{rng.randrange(19)}") for doc in range(600)]
    for n, passage in passages.items():
        sites = ["hot"] * 9 + [f"site{i}" for i in range(n - 1)]
        rows += [(1000 * n + i, f"own words {n} {i}\n{passage}\n{shorter if n == 9 else n}", s) for i, s in enumerate(sites)]
    got = line_dedup.clean(table(rows))
    assert {n: kept_in(got, p) for n, p in passages.items()} == {4: 12} | {n: 1 for n in range(5, 10)}
    # Shorter lines need ten sites.
    assert kept_in(got, shorter) == 17


@pytest.mark.parametrize("sites", [11, 12, 40])
def test_other_sites_of_the_corpus_do_not_matter(table, sites):
    """One line on 5 sites and 50 documents, beside more and more sites that have nothing to do with it."""
    rows = [(i, f"one line on five sites\nown words of {i}", f"s{i % 5}") for i in range(50)]
    rows += [(100 + i, f"other words of {i}", f"s{5 + i}") for i in range(sites - 5)]
    assert kept_in(line_dedup.clean(table(rows)), "one line on five sites") == 50
    assert kept_in(line_dedup.clean(table(rows), min_sites=5), "one line on five sites") == 1
