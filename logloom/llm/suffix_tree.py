"""Language-model scores by a probabilistic suffix tree over words.

The tree's states are contexts: the empty one, and the last words, up to `depth`, where they are frequent enough
and a divergence test says that what follows them differs from what follows the same context without its first
word. How frequent is a share of the corpus, as the method has it (a least probability), so at any size the same
texts give the same tree, and contexts are bounded in number: 2^18 of a length by default. A state's next-word
distribution has all words that ever follow it; it is discounted and smoothed by that of its suffix, down to the
words' own frequencies, so a word is predicted by the longest suffix of what stands before it that is a state.

Words get numbers where their hash deals them to, and so do contexts, which all tasks hold. A context and a next word are then one whole
number, exactly, and what is shuffled is sorted lists of such numbers, packed, of a few megabytes of text each,
dealt by context; those of a very frequent context to several places, by the next word. Counts are kept where they
were dealt to. A text is scored from counts alone: those of frequent n-grams, a bounded number, are with the tasks, for
all others each piece of texts sends its list to where the counts are and gets counts back in the same order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ngrams
from .common import Cut, released

SHARE = 1 << 20  # n-grams that make up 1 / SHARE of all tokens are sent to the tasks: at most so many of each length
KNOWN_BITS = 27  # of the bitmap that says which words may have been learned: 16 MB
PIECE = 4_000_000  # bytes of text that are looked at together
ROWS, PIECES = 500, 4  # texts, and pieces, that are handed to Python at once
PLACES = 256  # into how many places words are dealt at least, by hash
PART, LEAST_PARTS = 1_000_000, 64  # n-grams whose counts are kept in one place, and into how many places all are dealt at least
SEED = 42  # of Spark's xxhash64
END = ngrams.END.decode()


@dataclass
class Level:
    """Contexts of one length, numbered in the order of their keys: the number of the context without its last word,
    and the last word's. suffix: the number of the context without its first word; first, places: where its n-grams
    are dealt to."""

    bits: int
    keys: np.ndarray
    total: np.ndarray
    suffix: np.ndarray
    first: np.ndarray
    places: np.ndarray
    escape: np.ndarray | None = None
    state: np.ndarray | None = None
    often: np.ndarray | None = None  # n-grams that the tasks hold, sorted, with their counts
    counts: np.ndarray | None = None

    def dealt(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each place, which of the sorted keys belong there."""
        context, word = keys >> self.bits, keys & ((1 << self.bits) - 1)
        spread = (word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        place = self.first[context] + (spread % self.places[context].astype(np.uint64)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        at = np.flatnonzero(np.diff(place[order], prepend=-1))
        for a, b in zip(at, [*at[1:], len(order)]):
            yield int(place[order[a]]), order[a:b]


@dataclass
class Tree:
    """words: place, words, times; starts: a word's number is its place's start and its number there; grams: for each
    length of contexts place, keys, counts; states by length."""

    words: Cut
    starts: np.ndarray
    grams: list[Cut]
    levels: list[Level]
    tokens: int
    vocabulary: int
    states: list[Cut]
    depth: int
    discount: float
    bits: int

    @property
    def total(self) -> int:
        """What the probability of a word seen c times is (c + 1) of."""
        return self.tokens + self.vocabulary + 1

    def drop(self) -> None:
        for t in (self.words, *self.grams, *self.states):
            t.drop()


def find(among: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in a sorted array, -1 if nowhere."""
    if not len(among):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[at] == keys, at, -1)


def _list(values: pa.Array) -> pa.Array:
    """One row that is a list of these values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pack(numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(numbers.astype(np.int64), prepend=0).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int64))


def coded(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """How many tokens each text has, all different tokens, and for each token of the texts which of these it is.
    Tokens are words in lower case (A-Z) and the end; a null text is just an end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, of = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    made, of = words.filter(pa.array(some)).dictionary_encode(), of[some]
    lengths = np.bincount(of, minlength=len(texts)) + 1
    codes = np.full(int(lengths.sum()), len(made.dictionary), np.int32)
    codes[np.arange(len(of)) + of] = made.indices.to_numpy(zero_copy_only=False)
    return lengths, pa.concat_arrays([made.dictionary, pa.array([END])]), codes


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows id, text, as many together as a piece has."""
    held, size = [], 0
    for b in batches:
        sizes = np.cumsum(pc.binary_length(b.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) + size
        start = 0
        while start < b.num_rows:
            end = min(int(np.searchsorted(sizes, PIECE)) + 1, b.num_rows)
            held.append(b.slice(start, end - start))
            size, start = int(sizes[end - 1]), end
            if size >= PIECE:
                yield pa.concat_batches(held)
                held, sizes, size = [], sizes - size, 0
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, places: int, may: ngrams.Bitmap | None = None) -> Cut:
    """piece, ids and lengths of its texts, asked (its different tokens, by the place that their hash deals them to, and
    how often each occurs), n_words and codes (of each token the number among these). docs: doc_id, text. may: words
    that it rules out are not asked for and have code -1."""
    shared = docs.sparkSession.sparkContext.broadcast(may)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, may = TaskContext.get().partitionId() << 33, shared.value
        for texts in gathered(batches):
            lengths, words, codes = coded(texts.column(1))
            words = words.cast(pa.binary()).to_pylist()
            times = np.bincount(codes, minlength=len(words))
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
            place = (hashes % np.uint64(places)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            if may is not None:
                order = order[may.holds(hashes[order])]
            code = np.full(len(words), -1, np.int32)
            code[order] = np.arange(len(order))
            at = np.flatnonzero(np.diff(place[order], prepend=-1)).tolist()
            some = [order[i:j] for i, j in zip(at, [*at[1:], len(order)])]
            asked = [pa.array(place[order[at]]), pa.array([zstandard.compress(b" ".join([words[i] for i in x.tolist()]), 1) for x in some], pa.binary()), pa.array([pack(times[x]) for x in some], pa.binary())]
            lists = map(_list, (texts.column(0), pa.array(lengths), pa.StructArray.from_arrays(asked, ["place", "words", "times"])))
            codes = pa.array([zstandard.compress(code[codes].tobytes(), 1)])
            yield pa.RecordBatch.from_arrays([pa.array([piece]), *lists, pa.array([len(order)]), codes], ["piece", "ids", "lengths", "asked", "n_words", "codes"])
            piece += 1

    kind = "piece long, ids array<long>, lengths array<long>, asked array<struct<place: long, words: binary, times: binary>>, n_words long, codes binary"
    return Cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, kind), batch=ROWS)


def _words(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The words of all rows, one after another, and how many each row has."""
    lists = pc.split_pattern(pa.array([zstandard.decompress(x) for x in rows.column("words").to_pylist()], pa.binary()).cast(pa.string()), " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)


ANSWER = "place long, piece long, numbers binary, counts binary"


def learned(rows: pa.Table) -> pa.Table:
    """Of the words that are dealt to a place: these and their counts in one row; for each piece their numbers there."""
    words, sizes = _words(rows)
    made = words.dictionary_encode()
    numbers = made.indices.to_numpy(zero_copy_only=False)
    times = np.concatenate([unpack(x) for x in rows.column("times").to_pylist()])
    counts = np.bincount(numbers, times, len(made.dictionary)).astype(np.int64)
    answers = [pack(x) for x in np.split(numbers, np.cumsum(sizes)[:-1])]
    n, place = len(answers), rows.column("place").combine_chunks()
    offsets = lambda k: pa.array([0] * (n + 1) + [k], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets(len(counts)), x) for x in (made.dictionary, pa.array(counts))]
    return pa.table([pa.concat_arrays([place, place[:1]]), pa.array([*rows.column("piece").to_pylist(), None], pa.int64()), pa.array([*answers, None], pa.binary()), pa.nulls(n + 1, pa.binary()), *lists], names=["place", "piece", "numbers", "counts", "words", "times"])


def recognised(asks: pa.Table, held: pa.Table) -> pa.Table:
    """For each piece the numbers, -1 where there is none, and counts of the words that it asks a place for."""
    empty = [pa.array([], pa.string()), pa.array([], pa.int64())]
    words, counts = (pa.concat_arrays([e, *(x.values for x in held.column(c))]) for e, c in zip(empty, ("words", "times")))
    asked, sizes = _words(asks)
    numbers = pc.index_in(asked, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
    counts = np.append(counts.to_numpy(zero_copy_only=False), 0)[numbers]
    ends = np.cumsum(sizes, dtype=np.int64)
    columns = [pa.array([pack(y[e - k : e]) for e, k in zip(ends, sizes)], pa.binary()) for y in (numbers, counts)]
    return pa.table([asks.column("place"), asks.column("piece"), *columns], names=["place", "piece", "numbers", "counts"])


def numbered(made: Cut, answers: DataFrame, starts: np.ndarray) -> Cut:
    """piece, ids, lengths, n_words, codes, and numbers and counts (where these were asked for) of the piece's words."""

    def joined(rows: pa.Table, answers: pa.Table) -> pa.Table:
        numbers, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        told = answers.sort_by("place")
        for place, x, c in zip(*(told.column(name).to_pylist() for name in ("place", "numbers", "counts"))):
            found = unpack(x)
            numbers.append(np.where(found < 0, -1, found + starts[place]))
            counts.append(np.zeros(len(found), np.int64) if c is None else unpack(c))
        for name, x in (("numbers", numbers), ("counts", counts)):
            rows = rows.append_column(name, pa.array([pack(np.concatenate(x))], pa.binary()))
        return rows

    kind = "piece long, ids array<long>, lengths array<long>, n_words long, codes binary, numbers binary, counts binary"
    return Cut(made.df.drop("asked").groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(joined, kind))


def _asked(made: Cut) -> DataFrame:
    return made.df.select("piece", F.explode("asked").alias("e")).select("piece", "e.*")


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Number and count (where it was asked for) of each token of a piece; -1 and 0 of one that was not learned."""
    codes = np.frombuffer(zstandard.decompress(row["codes"]), np.int32)
    return np.append(unpack(row["numbers"]), -1)[codes], np.append(unpack(row["counts"]), 0)[codes]


def _rows(rows: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """Rows of `numbered`; ids and lengths as arrays."""
    for k in range(rows.num_rows):
        yield {c: rows.column(c)[k].as_py() for c in ("piece", "codes", "numbers", "counts")} | {c: rows.column(c)[k].values for c in ("ids", "lengths")}


def grams(words: np.ndarray, levels: list[Level]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of contexts: the context before each token and the n-gram that it makes with it, or -1.

    No context holds an end, so none goes beyond its text."""
    ending = find(levels[0].keys, words)
    for k, level in enumerate(levels):
        before = np.full(len(words), -1, np.int64)
        before[1:] = ending[:-1]
        keys = np.where((before >= 0) & (words >= 0), before << level.bits | words, -1)
        yield before, keys
        if k + 1 < len(levels):
            ending = find(levels[k + 1].keys, keys)


def count(rows: Cut, levels: list[Level], fewest: int, least: int) -> Cut:
    """Of the n-grams that begin with a context of the last level: place, keys and counts of those that occur `fewest`
    times; of each context there how many these are (kinds) and how often they occur (kept); those of `least` (often, times)."""
    shared = rows.spark.sparkContext.broadcast(levels)
    bits = levels[-1].bits

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for b in batches:
            for row in _rows(b):
                *_, (_, keys) = grams(_tokens(row)[0], levels)
                keys, counts = np.unique(keys[keys >= 0], return_counts=True)
                out = [(p, pack(keys[at]), pack(counts[at])) for p, at in levels[-1].dealt(keys)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["place", "keys", "counts"])

    def merged(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack(x) for x in rows.column("keys").to_pylist()])
        counts = np.concatenate([unpack(x) for x in rows.column("counts").to_pylist()])
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, counts = keys[new], np.add.reduceat(counts[order], new)
        enough = counts >= fewest
        keys, counts = keys[enough], counts[enough]
        context, of = np.unique(keys >> bits, return_inverse=True)
        often = counts >= least
        lists = [context, np.bincount(of, minlength=len(context)), np.bincount(of, counts, len(context)).astype(np.int64), keys[often], counts[often]]
        return pa.table([rows.column("place").slice(0, 1), pa.array([pack(keys)]), pa.array([pack(counts)]), *(_list(pa.array(x)) for x in lists)], names=["place", "keys", "counts", "context", "kinds", "kept", "often", "times"])

    kind = "place long, keys binary, counts binary"
    dealt = rows.df.mapInArrow(each, kind).groupBy("place")
    return Cut(dealt.applyInArrow(merged, f"{kind}, context array<long>, kinds array<long>, kept array<long>, often array<long>, times array<long>"), batch=PIECES)


def _lists(df: DataFrame, *columns: str) -> list[np.ndarray]:
    """Lists of all rows, one after another; the caller knows that they are bounded together."""
    rows = df.select(*columns).toArrow()
    return [rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]


def _level(keys: np.ndarray, total: np.ndarray, suffix: np.ndarray, bits: int) -> Level:
    if len(keys) and (len(keys) - 1).bit_length() + bits > 63:
        raise ValueError("too many contexts: least_share is too small for so many words")
    end = np.cumsum(total)
    size = max(1, min(PART, int(end[-1]) // LEAST_PARTS)) if len(end) else 1
    first = (end - total) // size
    return Level(bits, keys, total, suffix, first, np.maximum(1, (end - 1) // size - first + 1))


def differs(k: np.ndarray, kept: np.ndarray, total: np.ndarray, weighed: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The divergence test of a context that occurs `total` times and has k frequent next words, `kept` times in all.

    weighed: the sum over them of c ln(c / q), lower: that of q, the suffix's probability. All other words count as
    one. Twice the context's count times the divergence would be about chi-squared with k degrees of freedom if the
    context made no difference; it has to pass the mean by three standard deviations.
    """
    rest, expected = total - kept, np.maximum(1 - lower, 1e-12)
    some = np.where(rest > 0, rest, 1)
    divergence = weighed - kept * np.log(total) + np.where(rest > 0, rest * np.log(some / total / expected), 0)
    return (k > 0) & (2 * divergence > k + 3 * np.sqrt(2 * k))


def fit(docs: DataFrame, depth: int = 2, least_share: float = 2.0**-20, fewest: int = 1, context: int = 4, discount: float = 0.5, bits: int | None = None) -> Tree:
    """Learns from all texts of docs; a null text is just an end. Repeated texts count each time.

    All words are counted, and contexts of up to `depth` words that make up `context` times `least_share` of all
    tokens, `context` times `fewest` at least. These are tested by the next words that make up `least_share`. Of
    each all next words are counted, however rare; only a `fewest` above 1 leaves some to the suffix. What comes to
    the driver and goes to the tasks is contexts and n-grams of a least share. bits: 2 ** bits bits (KNOWN_BITS unless
    given) tell the tasks which words may have been learned; results are the same for any number.
    """
    spark = docs.sparkSession
    places = max(PLACES, 2 * docs.rdd.getNumPartitions())
    made = pieces(docs.select(F.lit(None).alias("doc_id"), "text"), places)
    held = Cut(_asked(made).groupBy("place").applyInArrow(learned, f"{ANSWER}, words array<string>, times array<long>"))
    dealt = held.df.where("piece is null")
    sizes = dealt.select("place", F.size("words").cast("long").alias("n"), F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x).alias("tokens")).toArrow()
    sizes, n = {p: k for p, k in zip(sizes.column("place").to_pylist(), sizes.column("n").to_pylist())}, sum(sizes.column("tokens").to_pylist())
    starts = np.cumsum([0, *(sizes.get(p, 0) for p in range(places))])
    v = int(starts[-1])
    words = dealt.select("place", F.posexplode(F.arrays_zip("words", "times")).alias("at", "e")).select("place", "at", F.col("e.words").alias("word"), F.col("e.times").alias("count"))
    least = max(fewest, math.ceil(n * least_share))
    least_context, width = max(1, context) * least, max(1, v.bit_length())
    common = words.where(F.col("count") >= least).select("place", "at", "count").toArrow()
    lower = starts[common.column("place").to_numpy()] + common.column("at").to_numpy()
    order = np.argsort(lower)
    lower, p = lower[order], (common.column("count").to_numpy()[order] + 1) / (n + v + 1)
    heads = words.where((F.col("count") >= least_context) | (F.col("word") == END)).toArrow().to_pylist()
    heads = sorted((int(starts[r["place"]]) + r["at"], r["word"], r["count"]) for r in heads)
    end = next((i for i, w, _ in heads if w == END), -1)
    ids, names, total = ([r[k] for r in heads if r[0] != end] for k in range(3))
    levels = [_level(np.array(ids, np.int64), np.array(total, np.int64), np.zeros(len(ids), np.int64), width)]
    rows = numbered(made, held.df.where("piece is not null").select("place", "piece", "numbers", "counts"), starts)
    words = Cut(dealt.select("place", "words", "times"))
    for done in (made, held):
        done.drop()
    released(spark)

    kept_grams, phrases = [], [names]
    for k in range(depth):
        level = levels[k]
        kept_grams.append(count(rows, levels, fewest, least))
        at, kinds, kept, keys, c = _lists(kept_grams[k].df, "context", "kinds", "kept", "often", "times")
        size, mask = len(level.keys), (1 << width) - 1
        kinds, kept = np.bincount(at, kinds, size), np.bincount(at, kept, size)
        level.escape = 1 - (kept - kinds * discount) / level.total
        order = np.argsort(keys)
        keys, c = keys[order], c[order]
        of = keys >> width
        shorter = keys & mask if not k else level.suffix[of] << width | keys & mask
        q = p[find(lower, shorter)]
        level.state = differs(*(np.bincount(of, x, size) for x in (np.ones(len(of)), c)), level.total, *(np.bincount(of, x, size) for x in (c * np.log(c / q), q)))
        lower, p = keys, (c - discount) / level.total[of] + level.escape[of] * q
        sent = c * SHARE >= n
        level.often, level.counts = keys[sent], c[sent]
        if k + 1 < depth:
            longer = (c >= least_context) & (keys & mask != end)
            levels.append(_level(keys[longer], c[longer], find(level.keys, shorter[longer]), width))
            last = find(levels[0].keys, keys[longer] & mask)
            phrases.append([f"{phrases[k][a]} {names[b]}" for a, b in zip(of[longer].tolist(), last.tolist())])
        released(spark)
    rows.drop()

    for k in range(depth - 1, 0, -1):  # a state's suffixes are states too
        levels[k - 1].state[levels[k].suffix[levels[k].state]] = True
    states = [Cut(spark.createDataFrame([(x, float(e)) for x, e, s in zip(phrases[k], levels[k].escape, levels[k].state) if s], "context string, escape double")) for k in range(depth)]
    return Tree(words, starts, kept_grams, levels, n, v, states, depth, discount, bits or KNOWN_BITS)


def sought(words: np.ndarray, levels: list[Level]) -> Iterator[tuple[Level, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of contexts: the tokens that follow a state and the states, those of these tokens that were learned
    and the n-grams that they make, told once each and in order, with the counts that the tasks hold, -1 for others."""
    for level, (before, keys) in zip(levels, grams(words, levels)):
        at = np.flatnonzero(before >= 0)
        at = at[level.state[before[at]]]
        learned = np.flatnonzero(keys[at] >= 0)
        ngram, of = np.unique(keys[at[learned]], return_inverse=True)
        yield level, at, before[at], learned, of, ngram, np.append(level.counts, -1)[find(level.often, ngram)]


def score(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score: one row for each row of docs.

    score: the tree's log10 probability of the text's words and its end; base_score: that of their frequencies alone,
    (c + 1) of tokens + vocabulary + 1; n_known: tokens that were learned from. Null and empty texts are an end
    alone. Rows that repeat or have no id are rows of their own, texts of any length are read whole. Only text is
    read besides the id. Of a tree of nothing every word has probability 1.
    """
    may = ngrams.bitmap_of(tree.words.df.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("h")), tree.bits)
    made = pieces(docs, len(tree.starts) - 1, may)
    asks = _asked(made).drop("times").groupBy("place").cogroup(tree.words.df.groupBy("place"))
    rows = numbered(made, asks.applyInArrow(recognised, ANSWER), tree.starts)
    made.drop()
    released(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tree.levels)
    total, tokens, discount = tree.total, tree.tokens, tree.discount

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for b in batches:
            for row in _rows(b):
                out = []
                for k, (level, *_, ngram, c) in enumerate(sought(_tokens(row)[0], levels)):
                    rest = ngram[c < 0]
                    out += [(k, place, row["piece"], pack(rest[at])) for place, at in level.dealt(rest)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["level", "place", "piece", "asked"])

    def answering(asks: pa.Table, held: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate([np.zeros(0, np.int64), *map(unpack, held.column(c).to_pylist())]) for c in ("keys", "counts"))
        counts = np.append(counts, 0)
        answers = [pack(counts[find(keys, unpack(x))]) for x in asks.column("asked").to_pylist()]
        return asks.drop_columns(["asked"]).append_column("answer", pa.array(answers, pa.binary()))

    def scoring(rows: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = _rows(rows)
        told = {(k, place): x for k, place, x in zip(*(answers.column(c).to_pylist() for c in ("level", "place", "answer")))}
        levels = shared.value
        words, counts = _tokens(row)
        base = (counts + 1) / total
        p = base.copy()
        for k, (level, at, state, learned, of, ngram, c) in enumerate(sought(words, levels)):
            rest = np.flatnonzero(c < 0)
            for place, some in level.dealt(ngram[rest]):
                c[rest[some]] = unpack(told[k, place])
            own = np.zeros(len(at))
            own[learned] = np.maximum(c - discount, 0)[of]
            p[at] = own / level.total[state] + level.escape[state] * p[at]
        lengths = row["lengths"].to_numpy(zero_copy_only=False)
        sums = lambda x: pa.array(np.add.reduceat(x, np.cumsum(lengths) - lengths))
        columns = [row["ids"], row["lengths"], sums((counts > 0).astype(np.int64)), pa.array(np.full(len(lengths), tokens)), sums(np.log10(base)), sums(np.log10(p))]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asks = rows.df.mapInArrow(asking, "level int, place long, piece long, asked binary")
    held = reduce(DataFrame.unionByName, [g.df.select(F.lit(k).alias("level"), "place", "keys", "counts") for k, g in enumerate(tree.grams)])
    told = asks.groupBy("level", "place").cogroup(held.groupBy("level", "place")).applyInArrow(answering, "level int, place long, piece long, answer binary")
    answers = Cut(told, batch=PIECES)
    released(docs.sparkSession)
    kind = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = Cut(rows.df.groupBy("piece").cogroup(answers.df.groupBy("piece")).applyInArrow(scoring, kind))
    for done in (rows, answers):
        done.drop()
    return out.df
