"""Whether two tables hold the same rows, without putting them side by side."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def print_of(columns: Sequence[str]) -> Column:
    """An aggregate that identifies the rows of a table whatever their order.

    It is made of the number of rows and the sums of two independent 64-bit hashes of a row, so rows can
    be summed up per task. Repeated rows count, NULL differs from every value and from NULL elsewhere.
    """
    parts = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    sums = [
        F.coalesce(F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")), F.lit(0)).cast("string")
        for seed in ("first", "second")
    ]
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with ``fingerprint``, equal for tables with the same rows in these columns and types."""
    return df.agg(print_of(columns or df.columns).alias("fingerprint"))
