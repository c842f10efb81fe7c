"""Exact dedup over an extendible-hash index on shared files. Columns and aggregates only.

Texts are equal when identical after lower-casing A-Z. An index entry stands for one distinct text;
entries of the same hash form a chain, in which texts are told apart by their bytes. The directory
starts small and doubles: buckets with too many entries are split by one more leading bit of
the hash until none is overfull. Entries of a chain share all bits, so a chain is never split, and copies
of one text are one entry, so a text with very many copies overfills nothing. Owner tasks hold ranges of
buckets, and the index is one table in the shared folder, sorted by bucket and hash.

Defined cases: a NULL text counts as empty. The row with the largest doc_id stays; a NULL doc_id loses
against any other. Of rows alike in doc_id and text exactly one stays. An empty table gives an empty
result. Columns other than doc_id and text are neither read nor returned.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import stored, text_or_empty

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENTRIES_PER_BUCKET = 1 << 16
HASH_BITS = 64


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else. Texts without other characters take the quick way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def leading(bits: int, column: str = "text_hash") -> Column:
    return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned(F.col(column), HASH_BITS - bits)


def entries_of(docs: DataFrame, normalise=lower_ascii) -> DataFrame:
    """One row per distinct text: hash, digest, number of rows and the largest doc_id.

    Grouping goes by the hash and then by the whole text. It is summed up within each task before the
    shuffle, so a text moves once per task that holds it, however many rows have it.
    """
    text = normalise(text_or_empty())
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .groupBy(F.xxhash64("text").alias("text_hash"), "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("text_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )


def directory(entries: DataFrame, capacity: int = ENTRIES_PER_BUCKET) -> tuple[DataFrame, int]:
    """(bucket, depth) of all buckets, and the directory's depth.

    A bucket is named by its leading hash bits, filled up with zeros to the depth of the directory, so
    that a hash belongs to the bucket with the largest name not above its own bits.
    """
    overfull = entries.groupBy("text_hash").agg(F.count("*").alias("chain"))
    overfull = stored(overfull, "hashes")
    # As many buckets to begin with as would do if hashes were spread evenly.
    depth, settled = max(0, (overfull.count() // capacity).bit_length() - 1), []
    while True:
        prefix = leading(depth)
        sizes = overfull.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("hashes"))
        if depth == HASH_BITS - 1:
            settled.append((sizes, depth))
            break
        settled.append((sizes.where(F.col("hashes") <= capacity), depth))
        too_large = stored(sizes.where(F.col("hashes") > capacity).select("prefix"), "overfull")
        if too_large.isEmpty():
            break
        overfull = overfull.join(too_large, prefix == F.col("prefix"), "left_semi")
        depth += 1
    buckets = None
    for sizes, bits in settled:
        some = sizes.select(
            F.shiftleft("prefix", depth - bits).alias("bucket"), F.lit(bits).alias("depth"), "hashes"
        )
        buckets = some if buckets is None else buckets.unionAll(some)
    return buckets, depth


def slots(buckets: DataFrame, depth: int) -> DataFrame:
    """The directory proper: each of its slots with the bucket it points to."""
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    return buckets.select(F.explode(F.sequence("bucket", F.col("bucket") + width - 1)).alias("slot"), "bucket", "depth")


def build_index(docs: DataFrame, capacity: int = ENTRIES_PER_BUCKET, normalise=lower_ascii) -> DataFrame:
    """The index as a table in the shared folder: each task owns a range of buckets and writes it sorted."""
    entries = stored(entries_of(docs, normalise), "entries")
    buckets, depth = directory(entries, capacity)
    placed = entries.withColumn("slot", leading(depth)).join(slots(buckets, depth), "slot").drop("slot")
    owned = placed.repartitionByRange("bucket", "text_hash").sortWithinPartitions("bucket", "text_hash")
    return stored(owned, "index")


def mark_duplicates(docs: DataFrame, capacity: int = ENTRIES_PER_BUCKET, normalise=lower_ascii) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    index = build_index(docs, capacity, normalise)
    text = normalise(text_or_empty())
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.sha2("text", 256).alias("text_sha256"))
        .groupBy("doc_id", "text_hash", "text_sha256")
        .agg(F.count("*").alias("rows"))
    )
    found = rows.join(index.select("text_hash", "text_sha256", "keep_id", "group_size"), ["text_hash", "text_sha256"])
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("nth"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )
