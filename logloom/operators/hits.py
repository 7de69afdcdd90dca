"""The page of hits: sorting, top rows, and the newest rows that a rollup says hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Model, day_at
from .histograms import ROLLUP_NS


def top(df: DataFrame, model: Model, sort: list[tuple[str, bool]], size: int) -> DataFrame:
    """The first rows by (field, descending) keys, ties by the id."""
    keys = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_first() for n, down in sort if n in model.fields]
    if model.id and model.id.name not in [n for n, _ in sort]:
        keys.append(F.col(model.id.name).asc())
    return (df.orderBy(*keys) if keys else df).limit(size)


def newest_bound(rollup: DataFrame, high: int | None, want: int) -> int | None:
    """The start, in nanoseconds, of the newest five-minute buckets up to a time that hold so many rows; None if all
    are fewer. As each bucket has a row, no more than `want` of them are looked at."""
    if high is not None:
        rollup = rollup.where((F.col("key") <= high // ROLLUP_NS) & (F.col("day") <= F.lit(day_at(high))))
    seen = 0
    for r in rollup.orderBy(F.col("key").desc()).limit(want).collect():
        seen += r["count"]
        if seen >= want:
            return r.key * ROLLUP_NS
    return None
