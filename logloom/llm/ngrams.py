"""Frequent n-grams by hashed buckets and Apriori (PCY/DHP), a pass over the texts for each length.

Each pass counts the n-grams of one length exactly and, meanwhile, adds the n-grams one longer to a table of
buckets, saturated at the least frequency that is asked for or, where that is a share of all words, which only
the first pass tells, at what its buckets can hold. A bucket below it holds no frequent n-gram, and
an n-gram is frequent only if both n-grams one shorter in it are. Both facts go to the next pass as bitmaps
of a fixed size, whatever the corpus: they say which n-grams need not be counted, and never drop a frequent
one. What is left is counted by the n-grams themselves, not by their hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut

CHUNK = 2_000_000  # bytes of text that are looked at together
HELD = 150_000  # n-grams whose counts a task holds before it hands them on
BLOCK = 1 << 18  # buckets of a row
FULL = 65_535  # what buckets are counted up to while the least frequency isn't known
END = b"\n"  # stands for a text's end; no word can be it

#: Splits a text into words, and says where each piece begins that n-grams stay within.
Split = Callable[[bytes], tuple[list[bytes], np.ndarray | None]]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def seed_of(group: str) -> int:
    return xxhash.xxh64_intdigest(group.encode("utf-8", "surrogatepass"), 3)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def phrase_hashes(groups: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes that n-grams of one length have in `Chunk`, of phrases with spaces between words."""
    if not phrases:
        return np.zeros(0, np.uint64)
    seeds = {g: seed_of(g) for g in set(groups)}
    h = np.array([seeds[g] for g in groups], np.uint64)
    for words in zip(*(p.encode("utf-8", "surrogatepass").split(b" ") for p in phrases)):
        h = mixed(h, hashes_of(list(words)))
    return h


class Chunk:
    """The words of some texts, each text with a group."""

    def __init__(self, texts: list[tuple[str, bytes]], split: Split):
        words: list[bytes] = []
        self.lengths = np.zeros(len(texts), np.int64)
        pieces, last = [], 0
        self.names = sorted({g for g, _ in texts})
        number = {g: k for k, g in enumerate(self.names)}
        for k, (_, t) in enumerate(texts):
            some, piece = split(t)
            words += some
            self.lengths[k] = len(some)
            pieces.append(np.full(len(some), last) if piece is None else piece + last)
            last += 1 if piece is None else (int(piece[-1]) + 1 if len(piece) else 0)
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.words = coded.dictionary.to_pylist()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.piece = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        self.group = np.repeat(np.array([number[g] for g, _ in texts], np.int64), self.lengths)
        self.plain = hashes_of(self.words)[self.ids]
        self.hash = [mixed(np.array([seed_of(g) for g in self.names], np.uint64)[self.group], self.plain)]

    def hashes(self, n: int) -> np.ndarray:
        """Of the n-gram that begins at each word; there are n - 1 fewer than words."""
        while len(self.hash) < n:
            before, k = self.hash[-1], len(self.hash)
            self.hash.append(mixed(before[: max(0, len(self.ids) - k)], self.plain[k:]))
        return self.hash[n - 1]

    def whole(self, n: int) -> np.ndarray:
        """Whether the n-gram that begins at each word lies in one piece."""
        return self.piece[: max(0, len(self.ids) - n + 1)] == self.piece[n - 1 :]

    def counted(self, at: np.ndarray, n: int) -> Iterator[tuple[str, bytes, int]]:
        """group, phrase, count of the n-grams that begin at these words, told apart by their words."""
        code, size = self.group[at], max(1, len(self.names))
        for j in range(n):
            if size * len(self.words) >= 1 << 62:
                some, code = np.unique(code, return_inverse=True)
                size = len(some)
            code, size = code * len(self.words) + self.ids[at + j], size * len(self.words)
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        where = at[first]
        columns = [self.ids[where + j].tolist() for j in range(n)]
        for g, c, *ids in zip(self.group[where].tolist(), counts.tolist(), *columns):
            yield self.names[g], b" ".join([self.words[i] for i in ids]), c


def chunks(batches: Iterator[pa.RecordBatch], split: Split) -> Iterator[Chunk]:
    """Chunks of rows (group, text); a null text is empty."""
    held: list[tuple[str, bytes]] = []
    size = 0
    for b in batches:
        for g, t in zip(b.column(0), b.column(1)):
            held.append((g.as_py(), (t.as_py() or "").encode("utf-8", "surrogatepass")))
            size += len(held[-1][1])
            if size >= CHUNK:
                yield Chunk(held, split)
                held, size = [], 0
    if held:
        yield Chunk(held, split)


class Bitmap:
    """2 ** bits bits, found by the upper bits of a hash."""

    def __init__(self, bits: int, data: bytes | bytearray):
        self.bits, self.data = bits, bytes(data)
        self._bytes = None

    def __reduce__(self):
        return Bitmap, (self.bits, self.data)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        if self._bytes is None:
            self._bytes = np.frombuffer(self.data, np.uint8)
        at = hashes >> np.uint64(64 - self.bits)
        return (self._bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(hashes: DataFrame, bits: int) -> Bitmap:
    """Of a column `h` of signed 64-bit hashes; only 2 ** bits bits come to the driver."""
    at = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.groupBy(F.shiftright(at, 15).alias("block")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    data = bytearray(1 << bits - 3)
    for r in rows:
        data[r.block << 12 : r.block + 1 << 12] = r.bits
    return Bitmap(bits, data)


def _kind(limit: int) -> type:
    """The numbers that buckets are counted in up to a limit."""
    return np.uint8 if limit <= 255 else np.uint16 if limit <= 65_535 else np.uint32


def _merged(parts: DataFrame, least: int, limit: int, bits: int) -> Bitmap:
    """Buckets that reach `least` in all tasks together, or `limit` in one; parts: block, buckets (compressed)."""
    enough = min(least, limit)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1)):
                new = np.minimum(np.frombuffer(zstandard.decompress(data.as_py()), _kind(limit)), enough)
                sums[k] = np.minimum(sums[k] + new.astype(np.uint64), enough).astype(_kind(enough)) if k in sums else new.astype(_kind(enough))
        if sums:
            full = [np.packbits(s >= enough, bitorder="little").tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(full, pa.binary())], ["block", "bits"])

    data = bytearray(1 << bits - 3)
    size = BLOCK >> 3
    for r in parts.repartition("block").mapInArrow(each, "block int, bits binary").collect():
        data[r.block * size : (r.block + 1) * size] = r.bits
    return Bitmap(bits, data)


def one_pass(docs: DataFrame, split: Split, n: int, limit: int, bits: int, shorter: Bitmap | None, buckets: Bitmap | None, longer: bool) -> Cut:
    """Two kinds of rows: group, phrase, count of n-grams in a task, and block, buckets of those one longer.

    docs: group, text. shorter: the frequent n-grams one shorter; buckets: those of this length. At length 1
    all words are counted, beyond it those n-grams that may be frequent; without buckets all that follow a frequent
    one. limit: what buckets are counted up to.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((shorter, buckets))
    size, block = 1 << bits, min(BLOCK, 1 << bits)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter, buckets = shared.value
        counts: dict[tuple[str, bytes], int] = {}
        table = np.zeros(size, _kind(limit)) if longer else None

        def rows(blocks: list[int], packed: list[bytes]) -> pa.RecordBatch:
            k = len(counts)
            columns = [pa.array([g for g, _ in counts] + [None] * len(blocks), pa.string()), pa.array([p for _, p in counts] + [None] * len(blocks), pa.binary()).cast(pa.string()),
                       pa.array(list(counts.values()) + [None] * len(blocks), pa.int64()), pa.array([None] * k + blocks, pa.int32()), pa.array([None] * k + packed, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["group", "phrase", "count", "block", "buckets"])

        for chunk in chunks(batches, split):
            may = chunk.whole(n)
            if shorter is not None:
                held = shorter.holds(chunk.hashes(n - 1))
                may &= held[:-1] if buckets is None else held[:-1] & held[1:] & buckets.holds(chunk.hashes(n))
            for g, p, c in chunk.counted(np.flatnonzero(may), n):
                counts[g, p] = counts.get((g, p), 0) + c
            if longer and len(may) > 1:
                both = may[:-1] & may[1:] & chunk.whole(n + 1)
                at, c = np.unique(chunk.hashes(n + 1)[both] >> np.uint64(64 - bits), return_counts=True)
                table[at] = np.minimum(table[at] + c.astype(np.uint64), limit)
            if len(counts) >= HELD:
                yield rows([], [])
                counts = {}
        blocks = [k for k in range(size // block) if longer and table[k * block : (k + 1) * block].any()]
        for i in range(0, max(1, len(blocks)), 64):
            some = blocks[i : i + 64]
            yield rows(some, [zstandard.compress(table[k * block : (k + 1) * block].tobytes(), 1) for k in some])
            counts = {}

    return Cut(docs.select(F.col("group"), F.col("text").cast("string")).mapInArrow(each, "group string, phrase string, count long, block int, buckets binary"))


def with_hashes(phrases: DataFrame) -> DataFrame:
    """Rows (group, phrase, ...) of one length with their hash as h."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = phrase_hashes(b.column(b.schema.get_field_index("group")).to_pylist(), b.column(b.schema.get_field_index("phrase")).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], [*b.schema.names, "h"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in phrases.schema.fields)
    return phrases.mapInArrow(each, f"{kinds}, h long")


def frequent(docs: DataFrame, split: Split, longest: int, least: int | Callable[[int], int], bits: int = 24) -> list[Cut]:
    """For each length from 1 to `longest` the table group, phrase, count: of words all of them, of longer n-grams
    those that occur `least` times or more. docs: group, text. The caller drops the tables.

    least: a number, or what makes one of the number of all words. bits: 2 ** bits buckets, each of a few bytes in a
    task and of a bit in what is sent to the tasks. More of them rule out more n-grams; results are the same for
    any number.
    """
    tables: list[Cut] = []
    shorter = buckets = None
    for n in range(1, longest + 1):
        limit = FULL if callable(least) else least
        made = one_pass(docs, split, n, limit, bits, shorter, buckets, n < longest)
        counted = made.df.where("phrase is not null").groupBy("group", "phrase").agg(F.sum("count").alias("count"))
        tables.append(Cut(counted if n == 1 else counted.where(F.col("count") >= least)))
        if callable(least):
            least = least(tables[0].df.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])
        if n < longest:
            buckets = _merged(made.df.where("block is not null").select("block", "buckets"), least, limit, bits)
            shorter = bitmap_of(with_hashes(tables[-1].df.where(F.col("count") >= least).select("group", "phrase")), bits)
        made.drop()
    return tables


def followed(docs: DataFrame, split: Split, n: int, contexts: DataFrame, bits: int = 24) -> Cut:
    """group, phrase, count of all n-grams, however rare, whose first n - 1 words are one of `contexts` (group, phrase),
    and of some others. The caller drops the table."""
    made = one_pass(docs, split, n, 1, bits, bitmap_of(with_hashes(contexts), bits), None, False)
    found = Cut(made.df.where("phrase is not null").groupBy("group", "phrase").agg(F.sum("count").alias("count")))
    made.drop()
    return found
