"""Pick one row per key by a total order.

``row_number() = 1`` over the key: Spark plans a group limit before the
exchange, so each map task ships at most one row per key, and a key holding a
third of all rows does not bring them into one task.  Unlike ``max_by`` over
structs, the payload travels once, and no sort aggregate is needed.

NULL ranks below any value, so "greatest" is ``ORDER BY c1 DESC NULLS LAST,
...`` and "least" is ``ORDER BY c1 ASC NULLS FIRST, ...``.  Payload columns
not already in the order are appended to it, so the winner never depends on
input order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def total_order(order: Sequence[str], payload: Sequence[str]) -> list[str]:
    return list(order) + [c for c in payload if c not in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str], greatest: bool = True) -> DataFrame:
    """One row per ``keys``: the ``payload`` of the row ranked first by ``order``
    (descending, nulls last when ``greatest``; ascending, nulls first otherwise)."""
    by = [F.col(c).desc_nulls_last() if greatest else F.col(c).asc_nulls_first()
          for c in total_order(order, payload)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where(F.col("_rank") == 1).select(*keys, *[c for c in payload if c not in keys])
