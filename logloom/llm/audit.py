"""What filters remove, and how they overlap, in every order in which they could be applied.

A document's failures of five filters are a mask of five bits. Masks are counted by part of the corpus, and
again among documents of good quality and among toxic ones; these histograms are the rows of an integer
matrix with 32 columns. Each of the 120 orders with its 5 steps is a column of 32 by 600 matrices that say
of a mask whether it is kept, removed, redundant or the filter's alone there, so four products give the
outcomes of all orders at once, without a document being read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
REPEATED = 1 << FILTERS.index("E")  # the only filter that looks at other documents
ORDERS = ["".join(p) for p in permutations(FILTERS)]
CAPITALS, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
COUNTS = ["n", "good", "toxic"]
OUT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: str, data: bytes) -> int:
    """Bits of the filters A to D that a text fails: under 100 words; under 80 % distinct words; over 10 % of its
    characters A to Z; one of the signs #$%&*|. data: the text in UTF-8."""
    words = data.split()  # of bytes: at space and \x09 to \x0D
    few = len(words) < 100
    repeating = 100 * len(set(words)) < 80 * len(words)
    loud = 100 * (len(data) - len(data.translate(None, CAPITALS))) > 10 * len(text)
    signs = len(data.translate(None, SIGNS)) < len(data)
    return few | repeating << 1 | loud << 2 | signs << 3


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of the filters that look at the text alone, and the text's SHA-256: a row for each of docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, digests = [], []
            for t in b.column(2):
                text = t.as_py() or ""
                data = text.encode("utf-8", "surrogatepass")
                masks.append(failures(text, data))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string"))
    return rows.mapInArrow(each, "doc_id long, part string, mask int, digest binary")


def histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents fail just the filters of the mask.

    A text's copies are counted before they are shuffled, by id and then by part, so a text that a third of all
    documents share costs no more than others. Of each text the documents of its smallest id pass the last filter.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max((F.col(c) == 1).cast("int")).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    rows = masked(docs).join(known.where("doc_id is not null"), "doc_id", "left")
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTS]
    ids = rows.groupBy("digest", "mask", "part", "doc_id").agg(F.count("*").alias("n"), *sums[1:])
    named = F.col("doc_id").isNotNull()
    of = lambda c, where: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0)).alias(c)
    parts = ids.groupBy("digest", "mask", "part").agg(
        F.struct(*[F.sum(c).alias(c) for c in COUNTS]).alias("all"), F.struct(*[of(c, ~named) for c in COUNTS]).alias("no_id"), F.min(F.when(named, F.struct("doc_id", *COUNTS))).alias("first")
    )
    parts = parts.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest")))  # a row for each part of a text
    first = F.col("first.doc_id") == F.col("least")
    passed = {c: F.col(f"no_id.{c}") + F.when(first, F.col(f"first.{c}")).otherwise(0) for c in COUNTS}
    cells = F.array(
        F.struct(F.col("mask").alias("mask"), *[passed[c].alias(c) for c in COUNTS]),
        F.struct((F.col("mask") + REPEATED).alias("mask"), *[(F.col(f"all.{c}") - passed[c]).alias(c) for c in COUNTS]),
    )
    return parts.select("part", F.inline(cells)).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


@cache
def matrices() -> dict[str, np.ndarray]:
    """32 by 600, columns by order and step, 1 where documents of a mask have the outcome; `of`, 600 by 5, has each column's filter."""
    columns = [(order[:step], FILTERS.index(order[step])) for order in ORDERS for step in range(len(FILTERS))]
    bit = np.array([1 << f for _, f in columns])
    before = np.array([sum(1 << FILTERS.index(x) for x in earlier) for earlier, _ in columns])
    masks = np.arange(MASKS)[:, None]
    fails, gone = masks & bit != 0, masks & before != 0
    found = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique": np.broadcast_to(masks == bit, fails.shape), "of": np.eye(len(FILTERS))[[f for _, f in columns]]}
    return {k: m.astype(np.int64) for k, m in found.items()}


def outcomes(histograms: np.ndarray) -> dict[str, np.ndarray]:
    """Of one part: 3 by 32 counts (documents, good ones, toxic ones) to 600 of each outcome."""
    m = matrices()
    removed, good, toxic = histograms @ m["removed"]
    docs = histograms[0]
    shapley = removed @ m["of"]
    return {"kept": docs @ m["kept"], "removed": removed, "redundant": docs @ m["redundant"], "unique_fails": docs @ m["unique"], "good_lost": good, "toxic_lost": toxic, "shapley": m["of"] @ shapley}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and what the filter at that step of that order does there: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, and shapley, what it removes in all orders together.

    A null text counts as empty, a null lang is the part ''; no documents, no rows. A document without an id never
    counts as repeating another one; documents that share an id do not repeat each other. Labels count once an id,
    as 1 if any of its rows says so. Other columns are not read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts = np.zeros((len(COUNTS), MASKS), np.int64)
                for cell in cells:
                    counts[:, cell["mask"]] = [cell[c] for c in COUNTS]
                n = len(ORDERS) * len(FILTERS)
                columns = [pa.array([part] * n, pa.string()), pa.array(np.repeat(ORDERS, len(FILTERS))), pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)))]
                found = outcomes(counts)
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v) for v in found.values())], ["part", "filter_order", "step", *found])

    cells = histogram(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))  # 32 at most
    return cells.mapInArrow(each, OUT)


def sql() -> str:
    """The same in SQL, document by document."""
    letters = ", ".join(f"(values ('A'), ('B'), ('C'), ('D'), ('E')) t{k}(f{k})" for k in range(5))
    differ = " and ".join(f"f{i} <> f{j}" for i in range(5) for j in range(i))
    return f"""with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, [x for x in string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+') if x <> ''] as ws from documents),
marks as (
    select doc_id, part, (len(ws) < 100)::int + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::int
        + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as m from texts),
known as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as bad from labels group by 1),
masks as (select part, m, count(*) as n, count(*) filter (good = 1) as good, count(*) filter (bad = 1) as bad from marks left join known using (doc_id) group by 1, 2),
orders as (select f0 || f1 || f2 || f3 || f4 as filter_order from {letters} where {differ}),
steps as (
    select filter_order, s::int as step, substr(filter_order, s::int, 1) as f, 1 << (ascii(substr(filter_order, s::int, 1)) - 65) as bit,
        coalesce(list_sum([1 << (ascii(x) - 65) for x in string_split(substr(filter_order, 1, s::int - 1), '') if x <> '']), 0)::int as before from orders, range(1, 6) r(s)),
cells as (
    select part, filter_order, step, f, coalesce(sum(n) filter (m & (before | bit) = 0), 0)::bigint as kept, coalesce(sum(n) filter (m & bit <> 0 and m & before = 0), 0)::bigint as removed,
        coalesce(sum(n) filter (m & bit <> 0 and m & before <> 0), 0)::bigint as redundant, coalesce(sum(n) filter (m = bit), 0)::bigint as unique_fails,
        coalesce(sum(good) filter (m & bit <> 0 and m & before = 0), 0)::bigint as good_lost, coalesce(sum(bad) filter (m & bit <> 0 and m & before = 0), 0)::bigint as toxic_lost
    from masks, steps group by 1, 2, 3, 4)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, f)::bigint as shapley from cells"""
