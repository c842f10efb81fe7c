"""Exact dedup against grouping in Python."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from heatgrid.llm import exact_dedup
from heatgrid.llm.shared import stored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = True
        for doc_id in ids:
            kept = left and doc_id == keep
            left = left and not kept
            out.append((doc_id, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_rows(odd, odd_rows):
    assert found(exact_dedup.mark_duplicates(odd)) == expected(odd_rows)


def test_empty_table(empty):
    assert exact_dedup.mark_duplicates(empty).count() == 0


def test_small_buckets_give_the_same(table):
    rows = [(i, f"text {i % 37}", "a") for i in range(200)]
    assert found(exact_dedup.mark_duplicates(table(rows), capacity=2)) == expected(rows)


def test_the_directory_doubles_until_no_bucket_is_overfull(spark):
    entries = stored(spark.range(500).select(F.xxhash64("id").alias("text_hash")), "test")
    buckets, depth = exact_dedup.directory(entries, capacity=8)
    rows = buckets.collect()
    assert sum(r.hashes for r in rows) == 500 and max(r.hashes for r in rows) <= 8
    assert max(r.depth for r in rows) == depth and min(r.depth for r in rows) < depth
    slots = exact_dedup.slots(buckets, depth)
    placed = entries.withColumn("slot", exact_dedup.leading(depth)).join(slots, "slot")
    assert placed.count() == 500 and slots.groupBy("slot").count().where("count > 1").isEmpty()


def test_equal_hashes_form_a_chain_that_is_not_split(spark):
    entries = spark.createDataFrame([(7,)] * 30 + [(-9,)] * 5, "text_hash long")
    buckets, _ = exact_dedup.directory(entries, capacity=1)
    assert sorted(r.hashes for r in buckets.collect()) == [1, 1]
