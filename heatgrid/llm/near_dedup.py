"""Near-duplicate classes by DartMinHash signatures and banded joins.

A document is the set of its runs of five words, each with a weight: 1, or its number of occurrences.
Every shingle throws darts, the same ones in every document: one stream of darts per unit of weight, which
arrive at random times at rate 1, each at a random coordinate and height. A dart counts if its height is
below the part of that unit the weight covers. The earliest dart per coordinate makes the signature. Only
darts up to a time limit are thrown, which is set so that all coordinates are likely hit by the document's
total weight, and doubled for documents where some coordinate is not. Two documents agree in a coordinate
with the probability of their (weighted) Jaccard similarity.

Bands of the signature are join keys; texts alike in one band share a bucket. Candidates are found in three
steps, each verified on whole shingle sets, and links give components:

1. in the first few bands, each member of a bucket with the bucket's first,
2. in all bands, one member of each component in a bucket with the bucket's first,
3. all members of a bucket that are still in different components.

The first two join a group of copies with about as many pairs as it has members, so the last, which leaves
nothing out, meets few. A pair is taken at the first band it shares only, and only if two sketches allow it;
large buckets are compared in blocks. The odd sketch has a bit for each hash value, set if an odd number of
shingles falls there: two of them differ in at most as many bits as their texts in shingles, and in almost as
many where those are few, so that hardly a pair just below the similarity is compared whole. For long texts,
where it is full, four bits of each signature coordinate have to agree about as often as they should. So no link
between two texts is lost but by chance: with 40 bands of 6, a pair of similarity 0.8 shares no band with
probability 5e-6, and fails on either sketch, at 4.5 standard errors, with 3e-6.

Exactly equal texts are one node throughout. A class is a component of links, named after its smallest
doc_id.

Defined cases: a NULL text counts as empty. Texts of fewer than five words are one shingle, texts without
words are alike. A NULL doc_id comes after all others; the class of documents that all have none is NULL.
Repeated rows belong to one class, of which one row is kept. An empty table gives an empty result.
"""

import hashlib
import math
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import drop_stored, stored, stored_so_far, text_or_empty

WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 40, 6
FIRST_BANDS = 8
BLOCK = 256  # members of a bucket that are compared with as many others in one go
ODD_BITS = 2048
STANDARD_ERRORS = 4.5
ROWS = 64
MAX_ID = (1 << 63) - 1

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: a 64-bit mixer's
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stepped(x: np.ndarray, step: int) -> np.ndarray:
    return mixed(x + np.uint64((step * int(_STEP)) % (1 << 64)))


class Codes(dict):
    """64-bit hashes of the words met so far, per Python worker; emptied when there are too many."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return code


_codes = Codes()


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles as 64-bit hashes in order, and how often each occurs."""
    if len(_codes) > 200_000:
        _codes.clear()
    found = text.encode("utf-8", "surrogatepass").split()
    if len(found) < words:
        whole = hashlib.blake2b(b" ".join(found), digest_size=8).digest()
        return np.frombuffer(whole, np.uint64), np.ones(1, np.int64)
    code = np.fromiter(map(_codes.__getitem__, found), np.uint64, len(found))
    size = len(code) - words + 1
    total = np.zeros(size, np.uint64)
    for i in range(words):
        total = stepped(total ^ code[i : i + size], i + 1)
    return np.unique(total, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The identity of the earliest dart at each coordinate, a row for each (elements, weights); and the odd sketches."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    left = np.arange(len(sets))
    limits = np.array([coordinates * (np.log(coordinates) + 2) / weights.sum() for _, weights in sets])
    streams = [units(*some) for some in sets]
    while len(left):
        earliest = thrown([streams[i] for i in left], limits[left], coordinates)
        done = (earliest != 0).all(1)
        out[left[done]] = earliest[done]
        left = left[~done]
        limits[left] *= 2
    return out, odd_sketches([seed for seed, _ in streams])


def units(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A seed per unit of weight, and how much of the unit the weight covers."""
    whole = np.ceil(weights).astype(np.int64)
    unit = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    seed = stepped(np.repeat(elements, whole) + mixed(unit.astype(np.uint64)), 101)
    return seed, np.minimum(np.repeat(weights, whole) - unit, 1.0)


def odd_sketches(seeds: list[np.ndarray]) -> np.ndarray:
    """A row of ODD_BITS bits for each, those set where an odd number of seeds falls."""
    owner = np.repeat(np.arange(len(seeds)), [len(seed) for seed in seeds])
    place = (np.concatenate(seeds) % np.uint64(ODD_BITS)).astype(np.int64)
    odd = np.bincount(owner * ODD_BITS + place, minlength=len(seeds) * ODD_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(seeds), -1), axis=1).view(np.uint64)


def thrown(streams: list[tuple[np.ndarray, np.ndarray]], limits: np.ndarray, coordinates: int) -> np.ndarray:
    """The earliest darts of all sets, given as ``units``, within their time limits; 0 for none.

    Each round throws as many darts of every stream as are to be expected in the time it has left, so that a
    text of one shingle takes few rounds too.
    """
    seed, cover = (np.concatenate(parts) for parts in zip(*streams))
    owner = np.repeat(np.arange(len(streams)), [len(seed) for seed, _ in streams])
    left = limits[owner]  # time until each stream's limit
    before = np.zeros(len(seed), np.int64)  # darts thrown by each
    times, darts, places = [], [], []
    while len(seed):
        many = np.ceil(left).astype(np.int64)
        ends = np.cumsum(many)
        stream = np.repeat(np.arange(len(seed)), many)
        number = np.arange(ends[-1]) + (before - ends + many)[stream]
        value = mixed(seed[stream] + (number.astype(np.uint64) + np.uint64(1)) * _STEP)
        wait = -np.log1p((value >> np.uint64(11)).astype(np.float64) * -(2.0**-53))
        passed = np.cumsum(wait)
        ahead = (left + passed[ends - many] - wait[ends - many])[stream] - passed
        hits = np.flatnonzero(ahead > 0)  # those that arrive in time
        at = stream[hits]
        dart = stepped(value[hits], 13) | np.uint64(1)
        low = np.flatnonzero(((dart & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32) < cover[at])
        dart = dart[low]
        place = (((dart >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)).astype(np.int64)
        times.append(ahead[hits[low]])
        darts.append(dart)
        places.append(owner[at[low]] * coordinates + place)
        ahead = ahead[ends - 1]
        more = np.flatnonzero(ahead > 0)
        before = (before + many)[more]
        seed, owner, cover, left = seed[more], owner[more], cover[more], ahead[more]
    order = np.argsort(np.concatenate(times))  # the earliest has most time left and comes last
    earliest = np.zeros(len(streams) * coordinates, np.uint64)
    earliest[np.concatenate(places)[order]] = np.concatenate(darts)[order]  # the last written stays
    return earliest.reshape(len(streams), coordinates)


def band_keys(
    texts: list[str], weighted: bool, bands: int, rows: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text the keys of its bands; four bits of each coordinate, 16 of them to a number and the last
    ones 0; the odd sketch; and the total weight."""
    sets = [shingles(text) for text in texts]
    if not weighted:
        sets = [(elements, np.ones(len(elements))) for elements, _ in sets]
    parts, odd = signatures(sets, bands * rows)
    bits = np.zeros((len(texts), -(-parts.shape[1] // 16) * 16), np.uint64)
    bits[:, : parts.shape[1]] = mixed(parts) % np.uint64(15) + np.uint64(1)
    bits = bits.reshape(len(texts), -1, 16)
    marks = np.bitwise_or.reduce(bits << (np.uint64(4) * np.arange(16, dtype=np.uint64)), axis=2)
    weight = np.array([weights.sum() for _, weights in sets])
    parts = parts.reshape(len(texts), bands, rows)
    key = np.broadcast_to(mixed(np.arange(bands, dtype=np.uint64) + np.uint64(1)), (len(texts), bands))
    for i in range(rows):
        key = mixed(key ^ parts[:, :, i])
    return key.view(np.int64), marks.view(np.int64), odd.view(np.int64), weight


def signed(docs: DataFrame, weighted: bool, bands: int, rows: int) -> DataFrame:
    """(doc_id, node, bands, sketch) of every row; the node is a digest of the text."""

    def lists(values: np.ndarray) -> pa.ListArray:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                texts = [text.as_py() or "" for text in some.column(1)]
                nodes = [hashlib.md5(text.encode("utf-8", "surrogatepass")).digest() for text in texts]
                keys, marks, odd, weight = band_keys(texts, weighted, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(nodes, pa.binary()),
                        lists(keys),
                        pa.StructArray.from_arrays(
                            [lists(marks), lists(odd), pa.array(weight, pa.float64())], ["marks", "odd", "weight"]
                        ),
                    ],
                    ["doc_id", "node", "bands", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        made, "doc_id long, node binary, bands array<long>, sketch struct<marks:array<long>,odd:array<long>,weight:double>"
    )


def alike(a: str, b: str, similarity: float, coordinates: int) -> Column:
    """Whether two texts may be as similar as asked for, by their sketches.

    Of n coordinates a share of at least the similarity has the same dart; different darts agree in their four
    bits with probability 1/15. Of all shingles of two similar texts at most (1 - s) / (1 + s) are in one only, and
    the odd sketches differ in no more bits than that, in fewer where several fall on one bit.
    """

    def summed(part: str, ones: Callable[[Column, Column], Column]) -> Column:
        counts = F.zip_with(F.col(a)[part], F.col(b)[part], lambda x, y: F.bit_count(ones(x, y)))
        return F.aggregate(counts, F.lit(0), lambda total, n: total + n)

    def disagreeing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(F.lit(0x1111111111111111))

    most = (F.col(a)["weight"] + F.col(b)["weight"]) * ((1 - similarity) / (1 + similarity))
    mean = (1 - F.exp(most * math.log1p(-2 / ODD_BITS))) * (ODD_BITS / 2)
    likely = mean + STANDARD_ERRORS * F.sqrt(mean * (1 - mean / ODD_BITS)) + 1
    differ = (1 - similarity) * 14 / 15 * coordinates
    error = STANDARD_ERRORS * math.sqrt(differ * (1 - differ / coordinates))
    return (summed("odd", Column.bitwiseXOR) <= F.least(most + 1e-6, likely)) & (
        summed("marks", disagreeing) <= differ + error + 1
    )


def stars(buckets: DataFrame, classes: DataFrame | None) -> DataFrame:
    """(a, b): the first of each bucket with one member of every component in it; without ``classes``, with all."""
    if classes is None:
        members = buckets.select("bucket", "node")
    else:
        members = (
            buckets.join(classes, "node", "left")
            .groupBy("bucket", F.coalesce("component", "node").alias("component"))
            .agg(F.min("node").alias("node"))
        )
    heads = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    return (
        members.join(heads.select("bucket", "a"), "bucket")
        .where("node <> a")
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


def open_pairs(
    buckets: DataFrame, classes: DataFrame, nodes: DataFrame, similarity: float, coordinates: int
) -> DataFrame:
    """(a, b): all members of one bucket that are in different components and may be similar, each pair once.

    Members are dealt into blocks, and each block meets every other in a group of its own.
    """
    placed = buckets.join(classes, "node", "left").select(
        "bucket", "band", "node", F.coalesce("component", "node").alias("component")
    )
    sizes = placed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = sizes.where("low <> high").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = (
        stored(placed.join(blocks, "bucket"), "open")
        .join(nodes.select("node", "bands", "sketch"), "node")
        .withColumn("own", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("other", other).select(
        "bucket",
        "band",
        F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"),
        "own",
        "component",
        "node",
        "bands",
        "sketch",
    )
    keys = ["bucket", "first", "second"]
    right = dealt.select(*keys, *(F.col(c).alias(f"{c}_b") for c in ("own", "component", "node", "bands", "sketch")))
    first_shared = F.array_position(F.zip_with("bands", "bands_b", lambda x, y: x == y), F.lit(True)) - 1
    pairs = dealt.join(right, keys).where(
        (F.col("component") < F.col("component_b"))
        # Two of one block meet in the group of that block only.
        & ((F.col("own") != F.col("own_b")) | (F.col("first") == F.col("second")))
        & (first_shared == F.col("band"))
        & alike("sketch", "sketch_b", similarity, coordinates)
    )
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b"))


def similar(pairs: DataFrame, texts: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """The pairs whose shingle sets are as similar as asked for. ``texts`` is (node, text), once per node."""
    needed = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    schema = "node binary, elements array<long>, counts array<int>"

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                sets = [shingles(text.as_py()) for text in some["text"]]
                ends = pa.array(np.cumsum([0, *(len(elements) for elements, _ in sets)]).astype(np.int32))
                elements = np.concatenate([elements for elements, _ in sets]).view(np.int64)
                counts = np.concatenate([counts for _, counts in sets]).astype(np.int32)
                columns = [some["node"], pa.ListArray.from_arrays(ends, pa.array(elements))]
                columns.append(
                    pa.ListArray.from_arrays(ends, pa.array(counts)) if weighted else pa.nulls(len(sets), pa.list_(pa.int32()))
                )
                yield pa.RecordBatch.from_arrays(columns, ["node", "elements", "counts"])

    sets = stored(texts.join(needed, "node", "left_semi").mapInArrow(shingled, schema), "sets")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array(value: pa.Scalar) -> np.ndarray:
            return value.values.to_numpy(zero_copy_only=False)

        for batch in batches:
            holds = []
            for row in range(batch.num_rows):
                a, b = array(batch["elements_a"][row]), array(batch["elements_b"][row])
                common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                if weighted:
                    m, n = array(batch["counts_a"][row]), array(batch["counts_b"][row])
                    both, every = int(np.minimum(m[i], n[j]).sum()), int(m.sum() + n.sum())
                else:
                    both, every = len(common), len(a) + len(b)
                holds.append(both >= similarity * (every - both) - 1e-9)
            mask = pa.array(holds, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("node").alias(name), F.col("elements").alias(f"elements_{name}"), F.col("counts").alias(f"counts_{name}")
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(verified, "a binary, b binary")


def lay_out(docs: DataFrame, table: str) -> None:
    """Every different text once, as a table bucketed by node in the warehouse: fetching some needs no shuffle of all."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = docs.select(F.unhex(F.md5(text_or_empty())).alias("node"), text_or_empty().alias("text"))
    once = once.groupBy("node").agg(F.first("text").alias("text"))
    once.write.bucketBy(buckets, "node").sortBy("node").saveAsTable(table)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    Each round hangs every node under that of its neighbours, itself included, which a hash of the round
    puts first, and goes on with the edges between what is left, so edges shrink by a factor per round.
    """
    edges = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(edges, "edges")
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    turn = 0
    while not edges.isEmpty():
        def ranked(name: str, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), name).alias("rank"), F.col(name).alias("node"))

        first = edges.groupBy("a").agg(F.min(ranked("b")).alias("first"))
        above = stored(first.select("a", F.least(ranked("a"), "first")["node"].alias("above")), "above")
        ends = above.select(F.col("a").alias("b"), F.col("above").alias("above_b"))
        met = edges.join(above, "a").join(ends, "b").where("above <> above_b")
        edges = stored(met.select(F.col("above").alias("a"), F.col("above_b").alias("b")).distinct(), "edges")
        moved = labels.join(above.withColumnRenamed("a", "root"), "root", "left")
        labels = stored(moved.select("node", F.coalesce("above", "root").alias("root")), "labels")
        turn += 1
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return stored(labels.join(least, "root").select("node", "component"), "components")


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links, found on the graph of components."""
    ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    alone = ends.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    every = stored(found.select("node", "component").unionAll(alone), "every")
    sides = [every.select(F.col("node").alias(x), F.col("component").alias(f"component_{x}")) for x in "ab"]
    between = links.join(sides[0], "a").join(sides[1], "b").where("component_a <> component_b")
    joined = components(between.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("new"))
    result = every.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return stored(result, "merged")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    weighted: bool = False,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """(doc_id, node, class_id, class_size, keep_node) of every row.

    ``keep_node`` is the text that stays of the class, that of the smallest doc_id; ``node`` is the row's own.
    """
    spark, since = docs.sparkSession, stored_so_far()
    marked = stored(signed(docs, weighted, bands, rows), "signed")
    nodes = stored(
        marked.groupBy("node").agg(
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.min(F.coalesce("doc_id", F.lit(MAX_ID))).alias("id"),
            F.count("*").alias("rows"),
        ),
        "nodes",
    )
    rows_of = stored(marked.select("doc_id", "node"), "rows")
    drop_stored(spark, since, [nodes, rows_of])
    every = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(every.join(shared.select("bucket"), "bucket", "left_semi"), "buckets")
    texts = f"llm_texts_{uuid4().hex}"
    lay_out(docs, texts)

    def likely(pairs: DataFrame) -> DataFrame:
        sides = [nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"sketch_{x}")) for x in "ab"]
        met = pairs.join(sides[0], "a").join(sides[1], "b")
        return met.where(alike("sketch_a", "sketch_b", similarity, bands * rows)).select("a", "b")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        return stored(similar(stored(pairs, name), spark.table(texts), similarity, weighted), f"{name}-links")

    try:
        links = linked(likely(stars(buckets.where(F.col("band") < FIRST_BANDS), None)), "first")
        found = components(links)
        more = linked(likely(stars(buckets, found)), "second")
        if not more.isEmpty():
            found = merged(found, more)
        last = linked(open_pairs(buckets, found, nodes, similarity, bands * rows), "open")
        if not last.isEmpty():
            found = merged(found, last)
    finally:
        spark.sql(f"DROP TABLE {texts}")
    classed = stored(
        nodes.join(found, "node", "left").select("node", "id", "rows", F.coalesce("component", "node").alias("component")),
        "classed",
    )
    groups = classed.groupBy("component").agg(
        F.min(F.struct("id", "node")).alias("least"), F.sum("rows").alias("class_size")
    )
    classes = classed.join(groups, "component").select(
        "node",
        F.when(F.col("least.id") < MAX_ID, F.col("least.id")).alias("class_id"),
        "class_size",
        F.col("least.node").alias("keep_node"),
    )
    drop_stored(spark, since, [rows_of, classed])
    return rows_of.join(classes, "node")
