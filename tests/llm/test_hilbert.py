"""The curve, the cuts, and shards that can be pruned."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from heatgrid.llm import hilbert


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_point_by_unit_steps(dims, bits):
    points = np.array(list(itertools.product(range(2**bits), repeat=dims)))
    index = hilbert.curve_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_odd_rows(odd, odd_rows):
    rows = hilbert.curve_sharded(odd, ["source", "lang", "n_chars", "doc_id"], 5).collect()
    expected = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(expected, key=repr)
    by_shard = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(5)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)


def test_fewer_rows_than_shards_and_none(table, empty):
    rows = hilbert.curve_sharded(table([(1, "a", "s"), (2, "b", "s")]), ["source", "doc_id"], 24).collect()
    assert [r.slot for r in rows] == [0, 0] and len({r.shard for r in rows}) == 2
    assert hilbert.curve_sharded(empty, ["source", "n_chars"], 24).count() == 0


def test_a_shard_is_narrow_in_every_dimension(table):
    rng = np.random.default_rng(3)
    rows = [(int(i), "x" * int(rng.integers(1, 400)), f"site-{rng.integers(0, 16):02d}") for i in rng.permutation(2000)]
    lengths, sources = {i: len(t) for i, t, _ in rows}, {i: s for i, _, s in rows}
    found = hilbert.curve_sharded(table(rows), ["source", "n_chars"], 16).collect()
    share = []
    for shard in range(16):
        ids = [r.doc_id for r in found if r.shard == shard]
        share.append((np.ptp([lengths[i] for i in ids]) / 400, len({sources[i] for i in ids}) / 16))
    # Sorted by one dimension only, the other would span its whole range in each shard.
    assert np.mean(share, axis=0).max() < 0.5


def test_strings_count_by_their_whole_value(table):
    """Values that part after forty characters, and one that starts otherwise."""
    rows = [(i, "t", f"https://www.example.org/a/very/long/common/start/{i % 16:02d}") for i in range(320)] + [(999, "t", "other")]
    found = hilbert.curve_sharded(table(rows), ["source"], 16).orderBy("shard", "slot").collect()
    sources = [r.dimensions.source for r in found]
    assert sources == sorted(sources)
    ranks = {r.value: r["rank"] for r in hilbert.value_ranks(table(rows), "source").collect()}
    assert ranks == {v: sum(o < v for _, _, o in rows) for v in {s for _, _, s in rows}}


def test_bounds_are_read_from_few_shards(spark, table, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(i), "x" * int(rng.integers(1, 400)), f"site-{rng.integers(0, 16):02d}") for i in rng.permutation(4000)]
    rows += [(5000, None, None)]
    path = str(tmp_path / "shards")
    hilbert.write_shards(hilbert.curve_sharded(table(rows), ["source", "n_chars"], 64), path)
    for bounds in ({"source": ("site-03", "site-04")}, {"n_chars": (100, 130)}, {"source": ("site-09", "site-10"), "n_chars": (1, 60)}):
        some = hilbert.read_shards(spark, path, **bounds)
        low, high = bounds.get("source", ("", "~"))
        least, most = bounds.get("n_chars", (0, 1000))
        want = sorted(i for i, t, s in rows if s and low <= s <= high and least <= len(t) <= most)
        assert sorted(r.doc_id for r in some.collect()) == want
        files = {f for (f,) in some.select(F.input_file_name()).distinct().collect()}
        assert len({f.split("shard=")[1].split("/")[0] for f in files}) <= 20
    assert hilbert.read_shards(spark, path, n_chars=(5000, 6000)).collect() == []
    ranges = spark.read.parquet(f"{path}/ranges").collect()
    assert len(ranges) == 64 and sum(r.rows for r in ranges) == 4001 and sum(r.source_nulls for r in ranges) == 1
