"""CDC changes to current state.

The state keeps one row per key, deleted keys included: without the mark of a
deletion an older update that arrives late would bring the row back. Keeping the
newest version per key gives the same state in whatever portions the changes come
and however often one is applied again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cdc import DELETE_OP
from millrace.operators.latest import latest_per_key

NEWEST_BY = ("cdc_ts_ms", "offset")


def reduce_changes(
    changes: DataFrame, keys: list[str], newest_by: tuple[str, ...] = NEWEST_BY
) -> DataFrame:
    """One change per key, the newest."""
    return latest_per_key(changes, keys, list(newest_by))


def merge_changes(
    state: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    newest_by: tuple[str, ...] = NEWEST_BY,
) -> DataFrame:
    """State after the changes: deletes, updates by newer versions, inserts."""
    if state is None:
        return reduce_changes(changes, keys, newest_by)
    return reduce_changes(
        state.unionByName(changes, allowMissingColumns=True), keys, newest_by
    )


def current_rows(state: DataFrame) -> DataFrame:
    """The rows a reader sees: every key that is not deleted."""
    return state.filter(F.col("op") != DELETE_OP)
