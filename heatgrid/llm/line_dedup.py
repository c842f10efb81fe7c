"""Removal of lines that spread over many sites. Columns and aggregates only.

Every line with enough words is hashed. One HyperLogLog sketch per line hash, merged by aggregation,
estimates on how many distinct sites the line stands. Where the estimate is too close to the threshold to
tell, the sites are counted exactly. Lines on at least that many sites are boilerplate. Lines of many words do not
recur by chance, so fewer sites are enough for them. Both thresholds are arguments and do not depend on the
corpus. The document with the smallest doc_id that has one keeps it, all others lose it, so that no content
vanishes altogether. Lines count as equal by a 64-bit hash: among n different lines some n * n / 2 ** 65 pairs
are taken for one another.

Defined cases: a NULL text counts as empty and stays NULL; a NULL site is one site of its own; a NULL
doc_id comes after all others; rows alike in doc_id and text get the same text, and both keep a line if
one is its first holder. Lines of fewer words, blank ones among them, always stay. A document may end up
empty; its row remains. Other columns pass through ``clean`` untouched, whatever their names.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import stored, text_or_empty

MIN_SITES = 10
MIN_WORDS = 3
LONG_SITES, LONG_WORDS = 5, 50
LG_K = 12
SPACE = r"\x20\x09-\x0D"


def wordy(words: int) -> str:
    """A pattern for lines of at least that many words."""
    return rf"^[{SPACE}]*" + rf"[^{SPACE}]+" + rf"[{SPACE}]+[^{SPACE}]+" * (words - 1)


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def site_lines(docs: DataFrame, site: str, min_words: int, long_words: int) -> DataFrame:
    """One row per document and different line of it: (doc_id, text_hash, site, line_hash, is_long)."""
    lines = F.filter(text_lines(text_or_empty()), lambda line: line.rlike(wordy(min_words)))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.explode(
            F.array_distinct(
                F.transform(
                    lines,
                    lambda line: F.struct(
                        F.xxhash64(line).alias("line_hash"), line.rlike(wordy(long_words)).alias("is_long")
                    ),
                )
            )
        ).alias("line"),
    ).select("doc_id", "text_hash", "site", "line.*")


def widespread(lines: DataFrame, min_sites: int, long_sites: int) -> DataFrame:
    """(line_hash, first_doc, first_text): the lines on at least so many sites as they need, and their first holders."""
    need = F.when(F.col("is_long"), min(min_sites, long_sites)).otherwise(min_sites)
    # Four standard errors of a sketch; below a few hundred sites estimates are all but exact.
    margin = math.ceil(4 * 1.04 / math.sqrt(2**LG_K) * min_sites)
    holder = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.col("text_hash").alias("text"))
    spread = lines.groupBy("line_hash").agg(
        F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min(holder).alias("first"), F.first("is_long").alias("is_long")
    )
    spread = stored(
        spread.withColumn("sites", F.hll_sketch_estimate("sketch"))
        .where(F.col("sites") >= need - margin)
        .select(
            "line_hash", F.col("first.doc").alias("first_doc"), F.col("first.text").alias("first_text"), "sites", need.alias("need")
        ),
        "spread",
    )
    near = spread.where(F.col("sites") <= F.col("need") + margin)
    # Distinct pairs come first, so that a line on very many documents is no more rows than it has sites.
    exact = (
        lines.select("line_hash", "site")
        .distinct()
        .join(near.select("line_hash"), "line_hash", "left_semi")
        .groupBy("line_hash")
        .agg(F.count("*").alias("exact"))
    )
    sure = spread.where(F.col("sites") > F.col("need") + margin)
    told = near.join(exact, "line_hash").where(F.col("exact") >= F.col("need")).drop("exact")
    return sure.unionByName(told).drop("sites", "need")


def clean(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    long_sites: int = LONG_SITES,
    long_words: int = LONG_WORDS,
) -> DataFrame:
    """(row, clean_text, n_lines, n_removed): ``row`` is the row as it came."""
    lines = stored(site_lines(docs, site, min_words, long_words), "lines")
    first = F.col("first_doc").eqNullSafe(F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    drops = (
        lines.join(widespread(lines, min_sites, long_sites), "line_hash")
        .where(~(first & (F.col("first_text") == F.col("text_hash"))))
        .groupBy(F.col("doc_id").alias("drop_doc"), F.col("text_hash").alias("drop_text"))
        .agg(F.collect_set("line_hash").alias("drop"))
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("drop_doc")) & (F.col("text_hash") == F.col("drop_text"))
    all_lines = text_lines(text_or_empty("row.text"))
    left = F.filter(all_lines, lambda line: ~(line.rlike(wordy(min_words)) & F.array_contains("drop", F.xxhash64(line))))
    return (
        rows.join(drops, same, "left")
        .select("row", "drop", F.when(F.col("drop").isNotNull(), left).alias("left"), F.size(all_lines).alias("n_lines"))
        .select(
            "row",
            F.when(F.col("drop").isNull(), F.col("row.text").cast("string"))
            .otherwise(F.array_join("left", "\n"))
            .alias("clean_text"),
            F.col("n_lines").cast("long").alias("n_lines"),
            F.coalesce(F.col("n_lines") - F.size("left"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
