"""Temperature mixing: targets met, whole permutations, blocks with the weights."""

import math
from collections import Counter, defaultdict

import pytest

from heatgrid.llm import mixing


@pytest.fixture(scope="module")
def skewed(table):
    rows = [(i, f"w{i} " * (5 + i % 7), "big" if i % 10 < 7 else f"s{i % 3}") for i in range(600)]
    return table(rows)


def weights(dealt):
    tokens = Counter()
    for row in dealt:
        tokens[row.source] += row.n_tokens
    total = sum(tokens.values())
    return {source: n / total for source, n in tokens.items()}


def entropy(shares):
    return -sum(p * math.log(p) for p in shares)


def test_entropy_target(skewed):
    dealt = mixing.mix(skewed, entropy_part=0.95, max_repeats=None, block_tokens=500).collect()
    got = weights(dealt)
    assert entropy(got.values()) == pytest.approx(0.95 * math.log(len(got)), abs=0.01)


def test_natural_weights_where_they_are_spread_enough(skewed):
    dealt = mixing.mix(skewed, entropy_part=0.1, max_repeats=None).collect()
    assert Counter(r.doc_id for r in dealt) == Counter(range(600))


def test_limit_on_repeats_prevails(skewed):
    dealt = mixing.mix(skewed, entropy_part=1.0, max_repeats=1.5, block_tokens=500).collect()
    most = Counter(r.doc_id for r in dealt).most_common(1)[0][1]
    assert most == 2
    with pytest.raises(ValueError, match="more often"):
        mixing.mix(skewed, budget=10**9, max_repeats=2.0)


def test_streams_are_whole_permutations_and_blocks_hold_the_weights(skewed):
    dealt = mixing.mix(skewed, entropy_part=0.99, max_repeats=None, block_tokens=800).collect()
    epochs = defaultdict(list)
    for row in dealt:
        epochs[row.source, row.epoch].append(row.doc_id)
    last = {source: max(e for s, e in epochs if s == source) for source, _ in epochs}
    sizes = Counter("big" if i % 10 < 7 else f"s{i % 3}" for i in range(600))
    for (source, epoch), ids in epochs.items():
        assert len(ids) == len(set(ids))
        assert epoch == last[source] or len(ids) == sizes[source]
    overall = weights(dealt)
    blocks = defaultdict(list)
    for row in dealt:
        blocks[row.block].append(row)
    assert sorted(blocks) == list(range(len(blocks)))
    for rows in blocks.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert sum(r.n_tokens for r in rows) == pytest.approx(800, rel=0.2)
        for source, share in weights(rows).items():
            assert share == pytest.approx(overall[source], abs=0.06)


def test_odd_rows(odd, odd_rows):
    dealt = mixing.mix(odd, entropy_part=None, max_repeats=None).collect()
    # With the weights as they are and one budget's worth, each row is dealt once.
    assert Counter(r.doc_id for r in dealt) == Counter(i for i, *_ in odd_rows)
    assert {r.source for r in dealt} == {"", "a", "b", "c"}


def test_empty_table(empty):
    assert mixing.mix(empty).count() == 0
