"""Collocations: phrases of two to four words that occur together more often than their parts suggest.

Phrases are counted by PCY/DHP passes (`ngrams`); all of what follows are joins and aggregations of the
phrases that are frequent, the parts of which are frequent too.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ngrams
from .common import Cut

SCALE = 2_000_000
UNDETERMINED = "und"
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\xff" * 10)  # a byte that UTF-8 doesn't have
SALTS = (512, 16)  # the best rows of each language are found in so many parts first, then in fewer, then in one


def split(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words in lower case (A-Z), between spaces and tabs, and the number of the piece that each is in."""
    parts = text.lower().translate(BREAKS).replace(b"\xff", b" \xff ").split()
    ends = np.fromiter((p == b"\xff" for p in parts), bool, len(parts))
    return [p for p in parts if p != b"\xff"], np.cumsum(ends)[~ends]


def score() -> Column:
    """floor(2000000 a / (l + r)), in decimals, as the product may pass 64 bits."""
    return F.expr(f"cast(cast(a as decimal(27,0)) * cast({SCALE} as decimal(10,0)) div (l + r) as long)")


def _best(rows: DataFrame, top: int) -> DataFrame:
    """Each language's first rows. A language may hold most of them, so it is dealt into parts before it is sorted."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for salts in SALTS:
        part = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine(docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000, bits: int = 24) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the phrases of the highest score.

    a: how often the phrase occurs, `least` times or more; l and r: how often the two parts do into which the cut
    with the lowest score, floor(2000000 a / (l + r)), divides it, the first such cut; n: all words of the language.
    Phrases that a longer one holds which occurs `covered` % as often or more are left out. Ties are ordered by a,
    then by the phrase's bytes. Null texts count as empty, a null lang is `und`; texts that repeat count each time;
    doc_id and other columns are not read. No documents, no rows.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("group"), "text")
    tables = ngrams.frequent(rows, split, longest, least, bits)
    sizes = Cut(tables[0].df.groupBy(F.col("group").alias("lang")).agg(F.sum("count").alias("n")))
    levels = [t.df.where(F.col("count") >= least).select(F.col("group").alias("lang"), "phrase", F.col("count").alias("a")) for t in tables]
    counts = reduce(DataFrame.unionByName, levels)
    found = reduce(DataFrame.unionByName, [t.withColumn("words", F.lit(k + 1)) for k, t in enumerate(levels) if k])

    # a longer phrase that holds this one holds one in between that is one longer and occurs no less
    longer = found.where("words > 2").withColumn("w", F.split("phrase", " "))
    inner = longer.select("lang", "a", F.explode(F.array(F.array_join(F.slice("w", F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = found.join(most, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * covered, F.lit(True)))

    words = F.split("phrase", " ")
    cuts = left.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), words.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    lowest = cuts.withColumn("score", score()).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = Cut(lowest.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    for done in tables:
        done.drop()
    return _best(scored.df, top).join(sizes.df, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000) -> str:
    """The same in SQL, by counting all phrases."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""with pieces as (
    select coalesce(lang, '{UNDETERMINED}') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\n\\x0B\\f\\r]')) as piece from documents),
words as (select lang, [x for x in string_split_regex(piece, '[ \\t]+') if x <> ''] as ws from pieces),
spans as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from words),
grams as (select lang, ws[i:i + k - 1] as g, k from spans, range(1, {longest + 1}) r(k) where i + k - 1 <= len(ws)),
counts as (select lang, g, k, count(*) as a from grams group by 1, 2, 3),
often as (select * from counts where a >= {least}),
longer as (select lang, unnest([g[1:k - 1], g[2:k]]) as g, a from often where k > 2),
most as (select lang, g, max(a) as most from longer group by 1, 2),
kept as (select lang, g, k, a from often left join most using (lang, g) where k > 1 and (most is null or 100 * most < {covered} * a)),
cuts as (select o.lang, o.g, o.a, c, x.a as l, y.a as r, 2000000::hugeint * o.a // (x.a + y.a) as score
    from kept o, range(1, {longest}) r(c), often x, often y where c < o.k and x.lang = o.lang and x.g = o.g[1:c] and y.lang = o.lang and y.g = o.g[c + 1:]),
lowest as (select lang, g, a, min(score) as score, arg_min(l, score * 10 + c) as l, arg_min(r, score * 10 + c) as r from cuts group by 1, 2, 3),
ranked as (select lang, array_to_string(g, ' ') as phrase, a, l, r, score from lowest),
sizes as (select lang, sum(a)::bigint as n from counts where k = 1 group by 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from ranked join sizes using (lang) qualify rank <= {top}"""
