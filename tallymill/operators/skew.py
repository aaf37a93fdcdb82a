"""Joins of a table with one row a key, where one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, key: str | list[str], count: str = "n", how: str = "inner", share: int = SHARE) -> DataFrame:
    """rows joined with keyed, which has each key once and in `count` how many rows hold it.

    A key that holds more than one in `share` of the counted rows is sent to every task: there are fewer than `share` of
    them whatever the data. All other keys are shuffled, and none of them can fill a task. how is inner or left; rows
    with a null key are in no inner join, as usual. `count` stays a column of the result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.broadcast(keyed.where(F.col(count) * share > total))
    few = rows.join(hot, keys)
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(keyed.where(F.col(count) * share <= total), keys, how)
    return few.unionByName(rest.select(*few.columns))
