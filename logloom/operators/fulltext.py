"""Tokenised full-text search over an inverted index whose entries point to timestamps.

The index is kept as lists: of each column's word, the times of one minute at which it stands. A search reads
the lists of all its texts' words at once and intersects them minute by minute.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_list, tokens
from ..model import Field, Model, day_at, day_of, in_time, nanoseconds
from .predicates import literal, quoted_name

SPAN_NS = 60 * 10**9  # a list holds the times of so long, at most as many as the timestamp can tell apart in it
TASKS = 8  # that make lists of what one task reads


def span_of(ns: Column) -> Column:
    return F.call_function("div", ns - F.pmod(ns, F.lit(SPAN_NS)), F.lit(SPAN_NS))


def build_postings(df: DataFrame, model: Model) -> DataFrame:
    """day, ts, column, word, word_hash: of each full-text column's words, once for a timestamp."""
    if not model.full_text or model.timestamp is None:
        raise ValueError("the model has no full-text column or no timestamp")
    ts = nanoseconds(model.timestamp)
    # a part for each column, so that a search reads and splits only the columns that it names
    parts = [df.select(ts.alias("ts"), F.lit(f.name).alias("column"), F.explode(tokens(F.col(f.name).cast("string"))).alias("word")) for f in model.full_text]
    rows = reduce(DataFrame.unionByName, parts).where("ts is not null").distinct()
    return rows.select(day_of(F.col("ts")).alias("day"), "ts", "column", "word", F.xxhash64("word").alias("word_hash"))


def build_lists(postings: DataFrame) -> DataFrame:
    """day, span, column, word, word_hash, times: postings with the times of a span in one sorted list."""
    rows = postings.groupBy("day", span_of(F.col("ts")).alias("span"), "column", "word", "word_hash")
    return rows.agg(F.array_sort(F.collect_set("ts")).alias("times"))


def _by_span(rows: DataFrame) -> DataFrame:
    """Rows in ranges of spans, TASKS for each partition that is read, however many that are: a task holds all words of
    its rows, several times what the rows take, so ranges are not joined to the size that Spark would have them at."""
    return rows.repartitionByRange(TASKS * max(1, rows.rdd.getNumPartitions()), "span")


def lists_of_rows(df: DataFrame, model: Model) -> DataFrame:
    """The lists of all rows' words, and `rows`: how many rows hold the word at each of the times. Rows are brought
    together by span before they are split, so texts move once and their words, several times as large, do not."""
    if not model.full_text or model.timestamp is None:
        raise ValueError("the model has no full-text column or no timestamp")
    ts = nanoseconds(model.timestamp)
    texts = {f.name: f"_text_{i}" for i, f in enumerate(model.full_text)}
    rows = df.select(ts.alias("ts"), span_of(ts).alias("span"), *[F.col(c).cast("string").alias(t) for c, t in texts.items()])
    held = [_beside("column", F.lit(c), "word", tokens(F.col(t))) for c, t in texts.items()]
    return _lists(_by_span(rows.where("ts is not null")).select("span", "ts", F.inline(F.concat(*held))), F.count("*"))


def merge_lists(lists: DataFrame) -> DataFrame:
    """The lists that several batches have of a word and a span as one."""
    return _lists(_each_time(_by_span(lists)), F.sum("n"))


def _lists(words: DataFrame, rows: Column) -> DataFrame:
    """Lists of words at times (span, ts, column, word); rows: the aggregate that counts a time's rows."""
    counts = words.groupBy("span", "column", "word", "ts").agg(rows.alias("n"))
    lists = counts.groupBy("span", "column", "word").agg(F.array_sort(F.collect_list(F.struct("ts", "n"))).alias("at"))
    day, word_hash = day_of(F.col("span") * SPAN_NS).alias("day"), F.xxhash64("word").alias("word_hash")
    return lists.select(day, "span", "column", "word", word_hash, F.col("at.ts").alias("times"), F.col("at.n").alias("rows"))


def _each_time(lists: DataFrame) -> DataFrame:
    """Lists' words time by time, each with its number of rows (n), which is 1 in lists that don't tell."""
    at = F.arrays_zip("times", "rows") if "rows" in lists.columns else F.transform("times", lambda t: F.struct(t.alias("times"), F.lit(1).cast("long").alias("rows")))
    return lists.select("day", "span", "column", "word", "word_hash", F.inline(at)).select("day", "span", F.col("times").alias("ts"), "column", "word", "word_hash", F.coalesce("rows", F.lit(1)).alias("n"))


def postings_of(lists: DataFrame) -> DataFrame:
    """The postings that lists stand for, once each."""
    return lists.select("day", F.explode("times").alias("ts"), "column", "word", "word_hash").distinct()


def occurrences_of(lists: DataFrame) -> DataFrame:
    """The postings that lists stand for, once for each row that holds the word."""
    return _each_time(lists).withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("span", "n")


@dataclass(frozen=True)
class Text:
    """A search text on one column: what the index must have, and what the row itself must hold."""

    field: Field
    words: tuple[str, ...]

    @classmethod
    def of(cls, field: Field, text: str) -> Text:
        return cls(field, tuple(token_list(text)))

    def recheck(self) -> str:
        """Every word as part of the text, any case, in SQL."""
        low = f"lower(cast({quoted_name(self.field)} as string))"
        return " and ".join(f"coalesce(contains({low}, {literal(w)}), false)" for w in self.words) or "false"


def _listed(texts: Sequence[Text]) -> dict[str, list[str]]:
    """The words that are sought in each column."""
    out: dict[str, list[str]] = {}
    for t in texts:
        some = out.setdefault(t.field.name, [])
        some += [w for w in t.words if w not in some]
    return out


def _beside(name: str, value: Column, of: str, array: Column) -> Column:
    """Each of an array's values beside a fixed one."""
    return F.transform(array, lambda x: F.struct(value.alias(name), x.alias(of)))


class Lists:
    """An index that is stored."""

    def __init__(self, lists: DataFrame):
        self.lists = lists

    def of(self, texts: Sequence[Text], low: int | None, high: int | None) -> DataFrame:
        """span, column, word, times of the texts' words; one scan for all of them."""
        wanted = _listed(texts)
        rows = self.lists
        for bound, compare in ((low, ">="), (high, "<=")):
            if bound is not None:
                rows = rows.where(f"day {compare} date'{day_at(bound)}' and span {compare} {bound // SPAN_NS}")
        # the files are sorted by the words' hashes; the words themselves decide
        rows = rows.where(F.col("word_hash").isin(*[F.xxhash64(F.lit(w)) for w in dict.fromkeys(w for ws in wanted.values() for w in ws)]))
        rows = rows.where(reduce(or_, [(F.col("column") == c) & F.col("word").isin(*ws) for c, ws in wanted.items()]))
        return rows.select("span", "column", "word", "times")


class Rows:
    """An index that is made of the rows as it is asked."""

    def __init__(self, df: DataFrame, model: Model):
        self.df, self.model = df, model

    def of(self, texts: Sequence[Text], low: int | None, high: int | None) -> DataFrame:
        """The same as of stored lists: only the columns and times that are asked for are read, and only the words
        that are sought leave a row."""
        at, rows = self.model.timestamp, self.df
        for bound, compare in ((low, ">="), (high, "<=")):
            if bound is not None:
                rows = rows.where(in_time(at, compare, bound))
        sought = {c: ws for c, ws in _listed(texts).items() if c in self.model.fields and c in rows.columns}
        held = [_beside("column", F.lit(c), "word", F.array_intersect(tokens(F.col(c).cast("string")), F.array(*map(F.lit, ws)))) for c, ws in sought.items()]
        # a word is part of its text, which is faster to find than the text is to split
        rows = rows.where(reduce(or_, [F.lower(F.col(c).cast("string")).contains(w) for c, ws in sought.items() for w in ws], F.lit(False)))
        found = rows.select(nanoseconds(at).alias("ts"), F.inline(F.concat(*held))).where("ts is not null").distinct()
        return found.select(span_of(F.col("ts")).alias("span"), "column", "word", F.array("ts").alias("times"))


Index = Lists | Rows


def matching(indexes: Sequence[Index], texts: Sequence[Text], names: Sequence[str], low: int | None = None, high: int | None = None) -> DataFrame:
    """ts and a truth value for each text: whether the rows of that time together hold every word of it in its
    column. Only times at which one of them does, within the inclusive bounds."""
    texts = list(texts)
    entries = reduce(DataFrame.unionByName, [i.of(texts, low, high) for i in indexes])
    words = list(dict.fromkeys((t.field.name, w) for t in texts for w in t.words))
    of = {k: F.flatten(F.collect_list(F.when((F.col("column") == k[0]) & (F.col("word") == k[1]), F.col("times")))).alias(f"_{i}") for i, k in enumerate(words)}
    spans = entries.groupBy("span").agg(*of.values())
    times = [reduce(F.array_intersect, [F.col(f"_{words.index((t.field.name, w))}") for w in t.words]) if t.words else F.array().cast("array<bigint>") for t in texts]
    found = F.concat(*[_beside("text", F.lit(i), "ts", ts) for i, ts in enumerate(times)])
    rows = spans.select(F.inline(found))
    if low is not None:
        rows = rows.where(F.col("ts") >= low)
    if high is not None:
        rows = rows.where(F.col("ts") <= high)
    return rows.groupBy("ts").agg(*[F.max(F.col("text") == i).alias(n) for i, n in enumerate(names)])


def semi(df: DataFrame, ts: Column, times: DataFrame) -> DataFrame:
    """Rows at one of the times."""
    return df.join(times.select(F.col("ts").alias("_at")), ts == F.col("_at"), "left_semi")


def flagged(df: DataFrame, ts: Column, times: DataFrame, names: Sequence[str]) -> DataFrame:
    """All rows, with the truth values of their times; false at times that have none."""
    out = df.join(times.withColumnRenamed("ts", "_at"), ts == F.col("_at"), "left").drop("_at")
    return out.withColumns({n: F.coalesce(n, F.lit(False)) for n in names})
