"""Helpers that several operators use: tables in the shared folder, and totals along an order."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heatgrid.session import remove, shared_folder

ROWS_PER_RANGE = 1_000_000

_made: list[str] = []  # paths of stored tables, in order


def scratch(spark: SparkSession) -> str:
    """This application's folder below the one the cluster names in spark.checkpoint.dir.

    Without that setting only a session on one machine has a folder, in its warehouse.
    """
    return f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table to the shared folder and read again, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def stored_so_far() -> int:
    return len(_made)


def drop_stored(spark: SparkSession, since: int, keep: list[DataFrame]) -> None:
    """Delete the tables stored since then but those to keep; for use when nothing reads them any more."""
    kept = {table.stored_at for table in keep}
    for path in [path for path in _made[since:] if path not in kept]:
        remove(spark, path)
        _made.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the operators have stored for this application; for use after the results are written."""
    remove(spark, scratch(spark))
    _made.clear()


def running_totals(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``before`` (long), the sum of ``value`` over the rows of the same keys that come earlier.

    The rows are sorted into ranges of (keys, order), as many as there are millions of them; sums of
    the ranges give where each one starts, so that no window spans more than one range however many
    rows share a key. Rows equal in ``order`` follow each other in any order.
    """
    spark = df.sparkSession
    df = stored(df, name)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // ROWS_PER_RANGE + 1)
    ranged = df.repartitionByRange(ranges, *keys, *order).withColumn("range_no", F.spark_partition_id())
    ranged = stored(ranged, name)
    sums = ranged.groupBy(*keys, "range_no").agg(F.sum(value).alias("range_sum"))
    earlier = Window.partitionBy(*keys or [F.lit(0)]).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *(F.col(key).alias(f"start_{key}") for key in keys),
        F.col("range_no").alias("start_no"),
        F.coalesce(F.sum("range_sum").over(earlier), F.lit(0)).alias("range_start"),
    )
    same = F.col("range_no") == F.col("start_no")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"start_{key}"))
    within = Window.partitionBy(*keys, "range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("range_start") + F.coalesce(F.sum(value).over(within), F.lit(0))
    return ranged.join(starts, same).select(*df.columns, before.cast("long").alias("before"))


def text_or_empty(column: str | Column = "text") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
