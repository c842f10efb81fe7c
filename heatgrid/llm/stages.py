"""The stages of the pipeline: each takes (spark, docs, sf_dir); all but the last return the columns of docs."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.llm import bpe, line_dedup, mixing, near_dedup, quality
from heatgrid.llm.shared import text_or_empty

BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and that the votes hold to be good."""
    # Counting twice takes less than keeping a copy of all rows with their counts.
    table = quality.posteriors(quality.text_counts(docs))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return quality.judged(quality.text_counts(rows, "row"), table).where("kept").select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand on many sites; ``n_chars`` follows the text."""
    cleaned = line_dedup.clean(docs)
    row = F.col("row").withField("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        length = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("row.n_chars")))
    return cleaned.select(row.alias("row")).select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest doc_id.

    Rows alike in doc_id and text are one document; which of them stays, where other columns differ, is open.
    """
    classes = near_dedup.near_duplicates(docs)
    stay = classes.where((F.col("node") == F.col("keep_node")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    stay = stay.select(F.col("doc_id").alias("stay_id"), F.col("node").alias("stay_node")).distinct()
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.unhex(F.md5(text_or_empty())).alias("node"),
    )
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("node") == F.col("stay_node"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["id", "node"]).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture deals it. Rows alike in doc_id, text and source share evenly, rounded up."""
    keys = ["doc_id", "source", "fingerprint"]
    dealt = mixing.mix(docs).groupBy(*keys).agg(F.count("*").alias("times"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("from"),
        F.md5(text_or_empty()).alias("print"),
    )
    copies = mixing.costs(docs, "source").groupBy(*keys).agg(F.count("*").alias("copies"))
    same = (F.col("id").eqNullSafe(F.col("doc_id"))) & (F.col("from") == F.col("source")) & (F.col("print") == F.col("fingerprint"))
    dealt = dealt.withColumnsRenamed({key: f"dealt_{key}" for key in keys})
    also = F.col("doc_id").eqNullSafe(F.col("dealt_doc_id"))
    for key in keys[1:]:
        also = also & (F.col(key) == F.col(f"dealt_{key}"))
    each = dealt.join(copies, also).select(*keys, F.ceil(F.col("times") / F.col("copies")).cast("int").alias("each"))
    return rows.join(each, same).select("row", F.explode(F.sequence(F.lit(1), "each"))).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of every document, encoded and decoded again."""
    return bpe.round_trip_digests(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)
