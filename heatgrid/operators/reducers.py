"""Further reductions of a day beside minimum, mean and maximum.

A reducer keeps a bounded state per metric and cell-day, made of aggregates that Spark combines within the
task that scans the hours; its result is a column of those. All reducers of a run share the one
aggregation of ``reduce_daily``.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from heatgrid.operators.calendar import hour_bit
from heatgrid.schema import HOURS_PER_DAY


@dataclass(frozen=True)
class Reducer:
    """``states`` makes aggregates by name from the hourly value, ``result`` the statistic from their columns.

    The hour is in ``ts``.
    """

    states: Callable[[Column], dict[str, Column]]
    result: Callable[[dict[str, Column]], Column]


def _hour_of_extreme(value: Column) -> dict[str, Column]:
    # Value and hour as one number, so that a plain maximum keeps both; earlier hours are the larger.
    nano = (value * 1e9).cast("decimal(29,0)")
    return {"at": F.max(nano * 100 + (HOURS_PER_DAY - 1 - F.hour("ts")))}


#: The first hour of the day, in UTC, at which the value is largest; values are compared to nine digits.
HOUR_OF_MAX = Reducer(
    _hour_of_extreme, lambda state: (HOURS_PER_DAY - 1 - F.pmod(state["at"], F.lit(100).cast("decimal(3,0)"))).cast("int")
)


def longest_run_above(threshold: float) -> Reducer:
    """The longest row of hours with a value above the threshold. Hours without a value break a row.

    The state is a set of hours as 24 bits. The set and itself shifted by an hour, combined by AND, holds
    what begins two hours above in a row, and so on; a row of k hours lasts k - 1 such steps.
    """

    def longest(state: dict[str, Column]) -> Column:
        hours = F.coalesce(state["hours"], F.lit(0))
        left, length = hours, F.lit(0)
        for step in range(HOURS_PER_DAY):
            length = length + F.when(left != 0, 1).otherwise(0)
            left = left.bitwiseAND(F.shiftright(hours, step + 1))
        return length

    return Reducer(lambda value: {"hours": F.bit_or(F.when(value > threshold, hour_bit("ts")))}, longest)
