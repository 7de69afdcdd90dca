"""Current state of a change log: rows of sign +1 that later rows of sign -1 have not cancelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current(log: DataFrame, key: str, seq: str = "seq", sign: str = "sign") -> DataFrame:
    """For each key with a positive sum of signs, its latest row of sign +1; one hash aggregation."""
    rest = [c for c in log.columns if c not in (key, sign)]
    latest = F.max_by(F.struct(*rest), F.when(F.col(sign) > 0, F.col(seq))).alias("_row")
    alive = log.groupBy(key).agg(F.sum(sign).alias("_sum"), latest).where("_sum > 0")
    return alive.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
