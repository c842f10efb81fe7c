"""Signatures that estimate similarity, and classes against brute force."""

import random

import numpy as np
import pytest

from heatgrid.llm import near_dedup


@pytest.mark.parametrize("weighted", [False, True])
def test_agreement_is_similarity(weighted):
    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.8):
        common = int(2000 * share / (1 + share))
        a, b = (rng.integers(0, 2**62, 1000).astype(np.uint64) for _ in "ab")
        b[:common] = a[:common]
        wa, wb = (rng.uniform(0.1, 3, 1000) if weighted else np.ones(1000) for _ in "ab")
        signs, _ = near_dedup.signatures([(a, wa), (b, wb)], 3000)
        both = np.minimum(wa[:common], wb[:common]).sum()
        assert (signs[0] == signs[1]).mean() == pytest.approx(both / (wa.sum() + wb.sum() - both), abs=0.04)


def test_few_elements_fill_all_coordinates():
    one = near_dedup.signatures([(np.array([5], np.uint64), np.ones(1)), (np.array([5], np.uint64), np.ones(1))], 240)[0]
    assert (one[0] == one[1]).all() and (one != 0).all()


def shingle_set(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def classes(rows):
    """Smallest doc_id of each component by comparing every pair; NULL is larger than all."""
    sets = [shingle_set(text) for _, text, _ in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for x, (doc_id, *_) in zip(label, rows, strict=True):
        least[x] = min(least.get(x, np.inf), np.inf if doc_id is None else doc_id)
    return sorted(
        ((doc_id, None if least[x] == np.inf else int(least[x])) for x, (doc_id, *_) in zip(label, rows, strict=True)), key=repr
    )


def found(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=repr)


def test_odd_rows_and_none(odd, odd_rows, empty):
    assert found(near_dedup.near_duplicates(odd)) == classes(odd_rows)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_clouds_of_edited_copies_match_brute_force(table, monkeypatch):
    """Copies with few and with many edits, around and below the similarity asked for; blocks of two."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    rng = random.Random(6)
    rows = []
    for group in range(6):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(120)]
        for copy in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
                words[rng.randrange(120)] = f"edit{rng.randint(0, 10**6)}"
            rows.append((group * 100 + copy, " ".join(words), "a"))
    rng.shuffle(rows)
    assert found(near_dedup.near_duplicates(table(rows))) == classes(rows)


def test_weights_count_repeated_shingles(table):
    once, often = "a b c d e f g h", " ".join(["a b c d e f g h"] * 30)
    cyclic = " ".join(["a b c d e f g h"] * 31)
    rows = [(1, once, "s"), (2, often, "s"), (3, cyclic, "s")]
    by_set = dict(found(near_dedup.near_duplicates(table(rows))))
    by_weight = dict(found(near_dedup.near_duplicates(table(rows), weighted=True)))
    assert by_set[2] == by_set[3] and by_weight[2] == by_weight[3] != by_weight[1]


def test_components(spark):
    links = [(b"a", b"b"), (b"c", b"b"), (b"x", b"y")] + [(bytes([n]), bytes([n + 1])) for n in range(30)]
    df = spark.createDataFrame(links, "a binary, b binary")
    got = {bytes(r.node): bytes(r.component) for r in near_dedup.components(df).collect()}
    assert got == {b"a": b"a", b"b": b"a", b"c": b"a", b"x": b"x", b"y": b"x"} | {bytes([n]): b"\x00" for n in range(31)}


def test_pairs_below_the_similarity_are_not_compared_whole(table, monkeypatch):
    """A group in which every pair has a similarity of some 0.75: the sketches tell nearly all of them apart."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for copy in range(60):
        words = list(base)
        for place in rng.sample(range(2, 298, 5), 5):
            words[place] = f"edit{copy}x{place}"
        rows.append((copy, " ".join(words), "a"))
    sets = [shingle_set(text) for _, text, _ in rows]
    likeness = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    assert sum(0.7 < x < 0.8 for x in likeness) > 0.5 * len(likeness)
    compared, whole = [], near_dedup.similar
    monkeypatch.setattr(near_dedup, "similar", lambda pairs, *rest: compared.append(pairs.count()) or whole(pairs, *rest))
    assert found(near_dedup.near_duplicates(table(rows))) == classes(rows)
    assert sum(compared) < 0.25 * len(likeness)


def test_few_shingles_take_few_rounds(monkeypatch):
    calls, whole = [], near_dedup.mixed
    monkeypatch.setattr(near_dedup, "mixed", lambda x: calls.append(1) or whole(x))
    keys, *_ = near_dedup.band_keys(["one", "", "one", "a b c d e f g"], False, 40, 6)
    assert len(calls) < 400 and (keys[0] == keys[2]).all() and (keys[0] != keys[1]).all()
