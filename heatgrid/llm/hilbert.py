"""Sharding by Hilbert-curve order, so that files can be pruned by several metadata columns.

Each dimension is cut into 2 ** BITS cells of about as many rows each, by approximate quantiles over all rows.
The cells of a row are a point, its place on the Hilbert curve through all points is its index, and rows
sorted by index are cut into runs. A run holds neighbours in every dimension, so the range of each column
within a shard is narrow. Law ``rows``: shard sizes are at most one apart.

A string counts as the number of rows with a smaller value, so that its whole value decides and cells hold
as many rows as those of numbers.

``write_shards`` lays rows out by shard and keeps the range of every dimension in each; ``read_shards`` reads
only shards whose ranges meet the bounds asked for.

Defined cases: a NULL dimension lies in the first cell; a NULL text has no bytes; equal indexes are ordered by
doc_id (NULL first), then by checksum of the text, and repeated rows follow each other; a table with fewer
rows than shards leaves some shards empty; an empty table gives an empty result. Columns besides doc_id, text
and the dimensions are neither read nor returned.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.llm.shared import running_totals, stored, text_or_empty

BITS = 6
ACCURACY = 1000
LAW = "rows"


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with as many coordinates as there are columns.

    Coordinates are turned into the curve's own frame from the highest bit down, then their bits are
    taken in turn, as Gray code.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for i in range(dims):
            set_bit = (x[i] >> bit) & 1 == 1
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(set_bit, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def value_ranks(docs: DataFrame, column: str) -> DataFrame:
    """(value, rank) of each value of a column: how many rows have a smaller one."""
    values = docs.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
    counts = values.agg(F.count("*").alias("times"))
    return running_totals(counts, [], ["value"], "times", "values").select("value", F.col("before").alias("rank"))


def curve_sharded(docs: DataFrame, dimensions: list[str], shards: int, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot, dimensions) of every row; the last is a struct of its values."""
    kinds = {c: docs.schema[c].dataType for c in dimensions}
    names = [f"d{i}" for i in range(len(dimensions))]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty()) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
        F.struct(*dimensions).alias("dimensions"),
    )
    for name, column in zip(names, dimensions):
        if isinstance(kinds[column], T.NumericType):
            rows = rows.withColumn(name, F.col("dimensions")[column].cast("double"))
        else:
            # Values are few or rare each; Spark splits a partition that one of them fills.
            ranks = value_ranks(docs, column).withColumnRenamed("value", f"value_{name}")
            met = F.col("dimensions")[column].cast("string") == F.col(f"value_{name}")
            rows = rows.join(ranks, met, "left").drop(f"value_{name}").withColumn(name, F.col("rank").cast("double")).drop("rank")
    rows = stored(rows, "points")
    parts = [i / 2**bits for i in range(1, 2**bits)]
    cuts = rows.agg(*(F.percentile_approx(n, parts, ACCURACY).alias(n) for n in names)).first()

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        cells = [
            np.where(c.isna(), 0, np.searchsorted(np.array(cuts[i] or [], float), c.to_numpy(float), "left"))
            for i, c in enumerate(columns)
        ]
        return pd.Series(curve_index(np.stack(cells, 1), bits))

    placed = rows.select("doc_id", "size", "text_crc32", "dimensions", index(*names).alias("curve"), F.lit(1).cast("long").alias("one"))
    ranked = running_totals(placed, [], ["curve", "doc_id", "text_crc32", "size"], "one", "ranked")
    count = ranked.agg(F.count("*")).first()[0]
    # Shard s holds the ranks from s * count / shards, rounded down, up to where the next begins.
    shard = F.expr(f"({shards}L * (before + 1L) - 1L) div {max(1, count)}L")
    return ranked.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        "curve",
        "shard",
        (F.col("before") - F.expr(f"(shard * {count}L) div {shards}L")).alias("slot"),
        "dimensions",
    )


def shard_ranges(sharded: DataFrame) -> DataFrame:
    """Per shard the number of rows, and the smallest and largest value of each dimension, and its NULLs."""
    facts = [F.count("*").alias("rows")]
    for name in sharded.schema["dimensions"].dataType.names:
        value = F.col("dimensions")[name]
        facts += [F.min(value).alias(f"{name}_low"), F.max(value).alias(f"{name}_high"), F.count_if(value.isNull()).alias(f"{name}_nulls")]
    return sharded.groupBy("shard").agg(*facts)


def write_shards(sharded: DataFrame, path: str) -> None:
    """``rows`` by shard, in the order of the curve, and ``ranges``, below the path."""
    spread = sharded.hint("rebalance", "shard").sortWithinPartitions("shard", "curve", "slot")
    spread.write.partitionBy("shard").parquet(f"{path}/rows")
    shard_ranges(sharded.sparkSession.read.parquet(f"{path}/rows")).coalesce(1).write.parquet(f"{path}/ranges")


def read_shards(spark: SparkSession, path: str, **bounds: tuple) -> DataFrame:
    """The rows whose dimensions lie within (low, high), both included, from the shards that may hold any.

    There are as many ranges as shards.
    """
    rows, ranges = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/ranges")
    for name, (low, high) in bounds.items():
        ranges = ranges.where((F.col(f"{name}_low") <= high) & (F.col(f"{name}_high") >= low))
        rows = rows.where(F.col("dimensions")[name].between(low, high))
    return rows.where(F.col("shard").isin([row.shard for row in ranges.select("shard").collect()]))
