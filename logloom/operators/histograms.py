"""Date histograms with named filters, conditional aggregates, and the five-minute rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import interval_ns
from ..model import Field, day_at, day_of, in_time, nanoseconds

ROLLUP_NS = 300 * 10**9
MS = 10**6


def bucket(ns: Column, width: int) -> Column:
    """The ordinal of the bucket; whole-number division, so that no boundary is rounded."""
    return F.call_function("div", ns, F.lit(width))


def date_histogram(df: DataFrame, f: Field, interval: str, filters: dict[str, Column] | None = None) -> DataFrame:
    """key (milliseconds), doc_count and a count for each named filter; one pass, empty buckets left out."""
    width = interval_ns(interval)
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in (filters or {}).items()]
    rows = df.withColumn("_bucket", bucket(nanoseconds(f), width)).where("_bucket is not null")
    found = rows.groupBy("_bucket").agg(F.count("*").alias("doc_count"), *counts)
    return found.select(F.call_function("div", F.col("_bucket") * width, F.lit(MS)).alias("key"), *[F.col(f"`{c}`") for c in found.columns if c != "_bucket"])


def filters(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """One row: a count for each named filter, and doc_count."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in named.items()], F.count("*").alias("doc_count"))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_where(value: Column, condition: Column) -> Column:
    """The sum over rows that hold the condition; 0 of none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def build_rollup(df: DataFrame, f: Field) -> DataFrame:
    """day, key (five-minute ordinal), count."""
    rows = df.withColumn("_ns", nanoseconds(f)).where("_ns is not null")
    return rows.groupBy(day_of(F.col("_ns")).alias("day"), bucket(F.col("_ns"), ROLLUP_NS).alias("key")).agg(F.count("*").alias("count"))


def merge_rollup(parts: DataFrame) -> DataFrame:
    """Rows of the same day and key added up, as appended partial counts are to be read."""
    return parts.groupBy("day", "key").agg(F.sum("count").alias("count"))


def fits_rollup(interval: str) -> bool:
    return interval_ns(interval) % ROLLUP_NS == 0


def histogram_from_rollup(rollup: DataFrame, raw: DataFrame, f: Field, interval: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """key, doc_count as date_histogram has them for low <= ns < high: whole five-minute buckets from the
    rollup, and the two edges from the raw rows, which are bounded by a bucket each."""
    if not fits_rollup(interval):
        raise ValueError("the interval is not a multiple of five minutes")
    width = interval_ns(interval)
    first = None if low is None else -(-low // ROLLUP_NS)
    last = None if high is None else high // ROLLUP_NS
    whole, edges = rollup, []
    if first is not None:
        whole = whole.where((F.col("key") >= first) & (F.col("day") >= F.lit(day_at(first * ROLLUP_NS))))
        if low < first * ROLLUP_NS:
            edges.append((low, first * ROLLUP_NS if high is None else min(high, first * ROLLUP_NS)))
    if last is not None:
        whole = whole.where((F.col("key") < last) & (F.col("day") <= F.lit(day_at(last * ROLLUP_NS))))
        if last * ROLLUP_NS < high and (first is None or last >= first):
            edges.append((last * ROLLUP_NS, high))
    parts = whole.select(F.call_function("div", F.col("key"), F.lit(width // ROLLUP_NS)).alias("b"), "count")
    for a, b in edges:
        rows = raw.where(in_time(f, ">=", a - a % 1000) & in_time(f, "<", -(-b // 1000) * 1000))
        rows = rows.withColumn("_ns", nanoseconds(f)).where((F.col("_ns") >= a) & (F.col("_ns") < b))
        parts = parts.unionByName(rows.groupBy(bucket(F.col("_ns"), width).alias("b")).agg(F.count("*").alias("count")))
    found = parts.groupBy("b").agg(F.sum("count").alias("doc_count"))
    return found.select(F.call_function("div", F.col("b") * width, F.lit(MS)).alias("key"), "doc_count")
