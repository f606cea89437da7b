"""Change rows that arrive again, left out with a state store.

A change is named by its key columns.  The state holds a key from its first arrival on for the given time, so it
is bounded by the changes that arrive in that time, not by the stream.  The clock is the arrival (the time stamped on a micro-batch,
which a restart takes from the checkpoint), not the change time: a change that comes late is never taken for one that
is too late.

Defined cases: rows with a null key, and rows with an empty text as key, name no change and pass without state; of rows of one key in
one micro-batch any one stays; a row that comes again after ``within`` passes again; further columns are kept.  Copies of one key meet in one
task, which reads them one by one and holds the key once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What makes two rows the same change.
CHANGE_KEYS = ("id", "dateUpdated")


def without_repeats(changes: DataFrame, within: str = "7 days", keys: tuple[str, ...] = CHANGE_KEYS) -> DataFrame:
    """The stream ``changes`` without rows whose keys arrived before, less than ``within`` ago."""
    arrived = "_arrived"
    while arrived in changes.columns:
        arrived = f"_{arrived}"
    named = reduce(lambda x, y: x & y, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys])
    once = changes.where(named).withColumn(arrived, F.current_timestamp()).withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(keys))
    return once.drop(arrived).unionByName(changes.where(~named))
