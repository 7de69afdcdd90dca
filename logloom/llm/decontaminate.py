"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

Passages of the corpus are TF-IDF rows. A randomised SVD in one pass (Nystroem's form: Z = A'(A W) for a
random W, from which the leading right singular vectors and values of A follow) gives a latent space in
which each direction counts alike. A word's vector there is brought to the length of the fourth root of
its idf, so that no few rare or frequent words decide alone; a window of text is the sum of the vectors of
its words but for those that no item has, which can't be in common. Windows of about an item's length, each
a quarter or less from the next, whose cosine with the item is high enough are candidates. A candidate's
place is verified: it must have enough of the item's words, and the longest common subsequence of words
must be long enough; for a share between the two limits the item's answer, its last sentence, must be there
too.

The cosine's limit is low, so that what it lets through is many times what holds an item, and next to
nothing that the LCS rule accepts is below it; the tests measure this against brute force.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, by_run, cut, runs

#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana and ideographs.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W_{UNSPACED}]+|(?=[^\W_])[{UNSPACED}]")
SPACED = re.compile(r"[^\W_]+")
ALONE = re.compile(f"[{UNSPACED}]")
PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))  # of UTF-8: ASCII that is in no word becomes a space
FEW = 24  # other characters than letters and digits of spaced scripts are replaced one by one up to so many
_letters = set(map(chr, range(128)))  # those met so far, and ASCII
TERMS = 1 << 14
PASSAGE = 64
DAMPED = 0.25
RANK, EXTRA = 112, 16
CHUNK = 1 << 15  # words that a step takes at once
SKETCHED = 1 << 12  # words that a step of the sketch takes at once, as a dense matrix of their terms and passages
TASK_WORDS = 1 << 23  # about how many words a task of the sketch sums up, so that tasks grow with the input
GROUP = 4  # windows begin and end at every fourth word
COSINES = 1 << 22  # that a step of the search holds at once
SHORT = 7  # items of fewer words are sought word for word
ITEMS = 2048
BLOCKS = 64
HITS = "doc_id long, item_id long, cosine double, lcs double, answer double, start long"


def words_of(text: str | None) -> np.ndarray:
    """CRC-32 of the words of a text in lower case; a character is a word in scripts without spaces."""
    text = (text or "").lower()
    if not text.isascii():
        other = set(text) - _letters
        odd = [c for c in other if ALONE.match(c) or not SPACED.match(c)]
        _letters.update(other.difference(odd))
        if len(odd) > FEW:
            text = " ".join(WORD.findall(text))
        else:
            for c in odd:
                text = text.replace(c, f" {c} " if WORD.match(c) else " ")
    words = text.encode("utf-8", "surrogatepass").translate(PLAIN).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, words: the word hashes of each document in four bytes each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                words = [words_of(t.as_py()).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.binary())], ["doc_id", "words"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, "doc_id long, words binary")


def _read(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u4") for x in column]


def _summed(rows: DataFrame, kind: str, columns: int) -> np.ndarray:
    """TERMS x columns: the sum of the tasks' arrays (block, task, data), added in the order of tasks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same in runs(batches, ["block"]):
            total = sum(np.frombuffer(x.as_py(), kind).astype(np.float64) for x in same.column("data"))
            yield pa.RecordBatch.from_arrays([same.column("block")[:1].combine_chunks(), pa.array([total.tobytes()], pa.binary())], ["block", "data"])

    dealt = rows.repartition("block").sortWithinPartitions("block", "task")
    out = np.zeros((BLOCKS, TERMS // BLOCKS * columns))
    for r in dealt.mapInArrow(each, "block int, data binary").collect():
        out[r.block] = np.frombuffer(r.data)
    return out.reshape(TERMS, columns)


def _by_block(total: np.ndarray) -> pa.RecordBatch:
    parts = total.reshape(BLOCKS, -1)
    some = [b for b in range(BLOCKS) if parts[b].any()]
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([task] * len(some), pa.int32()), pa.array([parts[b].tobytes() for b in some], pa.binary())], ["block", "task", "data"])


PARTS = "block int, task int, data binary"


def document_frequencies(words: DataFrame) -> tuple[np.ndarray, int, int]:
    """In how many documents each term is, over all documents, how many those are, and all their words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS, np.int64)
        for b in batches:
            for x in _read(b.column(0)):
                total += np.bincount(x & (TERMS - 1), minlength=TERMS) > 0
        yield _by_block(total)

    n, size = words.agg(F.count("*"), F.sum(F.length("words"))).first()
    return _summed(words.select("words").mapInArrow(each, PARTS), "<i8", 1)[:, 0], n, (size or 0) // 4


def random_directions(columns: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """A sparse random matrix: the column of each term's only entry, and the entry, 1 or -1."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, columns, TERMS), rng.choice([-1.0, 1.0], TERMS)


def _sketch(idf: np.ndarray, columns: int):
    """Z = A'(A W) of a task's passages, a row for each term."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, sign = random_directions(columns)
        total = np.zeros((TERMS, columns))

        def add(docs: list[np.ndarray]) -> None:
            starts, n = [], 0
            for x in docs:
                starts.append(np.arange(n, n + len(x), PASSAGE))
                n += len(x)
            at, terms = np.concatenate(starts), np.concatenate(docs)
            weight = idf[terms]
            row = np.repeat(np.arange(len(at)), np.diff(np.append(at, n)))
            weight = weight / np.sqrt(np.add.reduceat(weight * weight, at))[row]
            y = np.bincount(row * columns + column[terms], weight * sign[terms], columns * len(at)).reshape(len(at), columns)
            held = np.zeros(TERMS, np.int64)
            held[terms] = 1
            some = np.flatnonzero(held)
            held[some] = np.arange(len(some))
            a = np.bincount(held[terms] * len(at) + row, weight, len(some) * len(at)).reshape(len(some), len(at))
            total[some] += a.astype(np.float32) @ y.astype(np.float32)

        held, n = [], 0
        for b in batches:
            for x in _read(b.column(0)):
                x = (x & (TERMS - 1)).astype(np.int64)
                for i in range(0, len(x), SKETCHED):
                    held.append(x[i : i + SKETCHED])
                    n += len(held[-1])
                    if n >= SKETCHED:
                        add(held)
                        held, n = [], 0
        if n:
            add([x for x in held if len(x)])
        yield _by_block(total.astype(np.float32))

    return each


@dataclass
class Space:
    """The latent vector of each term, as long as a power of its idf."""

    vectors: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        return np.take(self.vectors, words & (TERMS - 1), axis=0)


def fit(words: DataFrame, rank: int = RANK, extra: int = EXTRA) -> Space:
    """The latent space of all passages in words (doc_id, words)."""
    df, n, size = document_frequencies(words)
    idf = (np.log((n + 1) / (df + 1)) + 0.2).astype(np.float32)
    tasks = max(2 * words.sparkSession.sparkContext.defaultParallelism, size // TASK_WORDS)
    z = _summed(words.select("words").coalesce(tasks).mapInArrow(_sketch(idf, rank + extra), PARTS), "<f4", rank + extra)
    column, sign = random_directions(rank + extra)
    w = np.zeros((TERMS, rank + extra))
    w[np.arange(TERMS), column] = sign
    shift = 1e-6 * max(np.linalg.norm(z), 1e-9)
    z = z + shift * w
    values, vectors = np.linalg.eigh((w.T @ z + z.T @ w) / 2)
    root = vectors / np.sqrt(np.maximum(values, shift * 1e-3))
    u, s, _ = np.linalg.svd(z @ root, full_matrices=False)
    u = u[:, :rank] / np.maximum(s[:rank], s[0] * 1e-3)
    return Space((idf[:, None] ** DAMPED * u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)).astype(np.float32))


def answer_of(text: str) -> set[int]:
    """Words of the last sentence that has three or more; of the last quarter if there is but one."""
    parts = [w for w in (words_of(s) for s in re.split(r"[.!?\u3002\uff01\uff1f\n]+", text)) if len(w) >= 3]
    words = words_of(text)
    return {int(w) for w in (parts[-1] if len(parts) > 1 else words[-max(1, len(words) // 4) :])}


class Item:
    """An item of the benchmark: its words, the least LCS that counts, and how far a place reaches beyond it."""

    def __init__(self, id: int, text: str, least: float):
        self.id, self.words, self.answer = id, words_of(text), answer_of(text)
        n = len(self.words)
        self.need = max(1, math.ceil(least * n - 1e-9)) if n >= SHORT else n
        self.slack = 4 + n // 4 if n >= SHORT else 0
        self.bits = _bits(self.words)


def _bits(item: np.ndarray) -> dict[int, int]:
    """Where each word stands in an item, a bit for each place."""
    bits: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        bits[w] = bits.get(w, 0) | 1 << i
    return bits


def _common(bits: dict[int, int], n: int, other: list[int]) -> int:
    full = v = (1 << n) - 1
    for w in other:
        if u := v & bits.get(w, 0):
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def lcs(item: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    return _common(_bits(item), len(item), other.tolist())


def scales(items: list[Item]) -> dict[int, list[int]]:
    """The long items by the groups in a window: a power of two or three quarters of one, nearest to a sixth
    more than the item."""
    out: dict[int, list[int]] = {}
    for k, x in enumerate(items):
        if (n := len(x.words)) >= SHORT:
            exact = max(1.0, n * 7 / 6 / GROUP)
            low = 1 << int(math.log2(exact))
            size = min((low, max(1, low * 3 // 2), 2 * low), key=lambda w: abs(math.log(w / exact)))
            out.setdefault(size, []).append(k)
    return out


def _sums(known: dict[int, np.ndarray], size: int, at: np.ndarray) -> np.ndarray:
    """The sums of `size` rows from each row in `at` on, a power of two or one and a half of one."""
    low = 1 << size.bit_length() - 1
    for b in range(1, size.bit_length()):
        if 1 << b not in known:
            half = known[1 << b - 1]
            known[1 << b] = half[: len(half) - (1 << b - 1)] + half[1 << b - 1 :]
    out = np.take(known[low], at, axis=0)
    if size > low:
        out += np.take(known[size - low], at + low, axis=0)
    return out


class Search:
    """Finds items in pieces of documents."""

    def __init__(self, items: list[Item], space: Space, cosine: float):
        self.items, self.cosine = items, cosine
        self.vectors = np.zeros((TERMS + 1, space.vectors.shape[1]), np.float32)  # the last one stands for no word
        self.has = np.zeros((len(items), TERMS + 1), bool)  # which terms an item has
        for k, x in enumerate(items):
            self.vectors[x.words & (TERMS - 1)] = space.of(x.words)
            self.has[k, x.words & (TERMS - 1)] = True
        self.scales = scales(items)
        self.need, self.slack, self.lengths = (np.array([f(x) for x in items], np.int64) for f in (lambda x: x.need, lambda x: x.slack, lambda x: len(x.words)))
        latent = np.array([space.of(x.words).sum(axis=0) for x in items], np.float32).reshape(len(items), space.vectors.shape[1])
        self.latent = latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9)
        self.reach = max([len(x.words) + 2 * x.slack for x in items], default=1)
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, x in enumerate(items):
            if len(x.words) < SHORT:
                self.short.setdefault(len(x.words), {}).setdefault(int(self.rolled(x.words, len(x.words))[0]), []).append(k)

    @staticmethod
    def rolled(words: np.ndarray, n: int) -> np.ndarray:
        """A number for each run of n words."""
        out = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)].astype(np.uint64)
        return out

    def near(self, windows: np.ndarray, some: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, item, cosine) of those that are near."""
        least = self.cosine * np.sqrt(np.einsum("ij,ij->i", windows, windows)) + 1e-9
        latent, which, high = self.latent[some].T, np.array(some), max(1, COSINES // len(some))
        for a in range(0, len(windows), high):
            dot = windows[a : a + high] @ latent
            i, j = np.divmod(np.flatnonzero(dot >= least[a : a + high, None]), len(some))
            yield a + i, which[j], dot[i, j] / least[a + i] * self.cosine

    def candidates(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, float, int, int]]:
        """(document, item, cosine, first and last word of the place) of places near an item, without those
        that have too few words of the item to hold it, in any order."""
        sizes = np.array([-(-len(x) // GROUP) for x in docs])
        ends = np.cumsum(sizes)
        begin, last = (ends - sizes) * GROUP, (ends - sizes) * GROUP + [len(x) for x in docs]
        terms = np.full(ends[-1] * GROUP, TERMS)
        for x, a in zip(docs, begin):
            terms[a : a + len(x)] = x & (TERMS - 1)
        groups = sum(np.take(self.vectors, terms[k::GROUP], axis=0) for k in range(GROUP))
        whole = np.add.reduceat(groups, ends - sizes, axis=0)
        of = np.repeat(np.arange(len(docs)), sizes)
        place = np.arange(ends[-1])
        left = ends[of] - place  # groups to the document's end
        known, found = {1: groups}, []
        for size, some in sorted(self.scales.items()):
            full = np.flatnonzero((left >= size) & (((place - (ends - sizes)[of]) & (max(1, (1 << size.bit_length() - 1) // 8) - 1) == 0) | (left == size)))
            for i, item, cosine in self.near(_sums(known, size, full), some) if len(full) else ():
                found.append((of[full[i]], item, cosine, full[i] * GROUP + size * GROUP // 2))
            less = np.flatnonzero(sizes < size)
            for i, item, cosine in self.near(whole[less], some) if len(less) else ():
                found.append((less[i], item, cosine, (begin + last)[less[i]] // 2))
        if not found:
            return
        doc, item, cosine, middle = (np.concatenate(x) for x in zip(*found))
        start = np.maximum(begin[doc], middle - self.lengths[item] // 2 - self.slack[item])
        stop = np.minimum(last[doc], middle - self.lengths[item] // 2 + self.lengths[item] + self.slack[item])
        for some in np.array_split(np.arange(len(doc)), 1 + int((stop - start).sum()) // COSINES):
            n = stop[some] - start[some]
            at = np.arange(n.sum()) + np.repeat(start[some] - np.cumsum(n) + n, n)
            inside = np.add.reduceat(self.has[np.repeat(item[some], n), terms[at]], np.cumsum(n) - n, dtype=np.int64)
            some = some[inside >= self.need[item[some]]]
            yield from zip(doc[some].tolist(), item[some].tolist(), cosine[some].tolist(), (start - begin[doc])[some].tolist(), (stop - begin[doc])[some].tolist())

    def word_for_word(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, first word) of the short items."""
        for n, hashes in self.short.items():
            rolled = self.rolled(words, n)
            for at in np.flatnonzero(np.isin(rolled, np.array(list(hashes), np.uint64))).tolist():
                for k in hashes[int(rolled[at])]:
                    if (words[at : at + n] == self.items[k].words).all():
                        yield k, at


Found = dict[int, tuple[float, float, float, int]]


def _hits(search: Search, docs: list[np.ndarray], sure: float) -> list[Found]:
    """For each document item: (cosine, LCS share, answer share, start) of its best place."""
    best: list[Found] = [{} for _ in docs]

    def better(d: int, k: int, row: tuple[float, float, float, int]) -> None:
        if k not in best[d] or (row[1], row[0], -row[3]) > (best[d][k][1], best[d][k][0], -best[d][k][3]):
            best[d][k] = row

    for d, k, cosine, start, stop in search.candidates(docs) if search.scales else ():
        item, region = search.items[k], docs[d][start:stop].tolist()
        if sum([w in item.bits for w in region]) < item.need or (common := _common(item.bits, len(item.words), region)) < item.need:
            continue
        answer = len(item.answer & set(region)) / len(item.answer)
        if common / len(item.words) >= sure or answer >= 0.5:
            better(d, k, (min(1.0, cosine), common / len(item.words), answer, start))
    for d, words in enumerate(docs) if search.short else ():
        for k, at in search.word_for_word(words):
            better(d, k, (1.0, 1.0, 1.0, at))
    return best


def _search(rows: list[tuple[int, str]], space: Space, least: float, sure: float, cosine: float):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search([x for x in (Item(i, text, least) for i, text in rows) if len(x.words)], space, cosine)
        piece = max(CHUNK, 4 * search.reach)  # long documents in pieces that overlap by a place

        def found(held: list[tuple[int | None, int, np.ndarray]]) -> list[tuple]:
            hits = _hits(search, [x for _, _, x in held], sure)
            return [(doc, search.items[k].id, c, share, answer, at + start) for (doc, at, _), some in zip(held, hits) for k, (c, share, answer, start) in some.items()]

        held, size = [], 0
        for b in batches if search.items else ():
            out = []
            for doc, x in zip(b.column(0).to_pylist(), _read(b.column(1))):
                for a in range(0, max(1, len(x) - search.reach), piece):
                    part = x[a : a + piece + search.reach]
                    if len(part):
                        held.append((doc, a, part))
                        size += len(part)
                    if size >= CHUNK:
                        out += found(held)
                        held, size = [], 0
            if held:
                out += found(held)
                held, size = [], 0
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in HITS.split(", ")])

    return each


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.6, sure: float = 0.8, cosine: float = 0.5) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer, start: a row for each item that a document holds.

    Candidates are windows with a latent cosine of `cosine` or more. An item is held if `sure` of its words,
    in order, stand in the place around such a window, or `least` of them with half of its answer's words. A
    place is a quarter of the item and four words longer than the item at both ends. Items of fewer than
    seven words are held where all their words stand side by side. Null items and those without a word are
    not sought; null and empty documents hold none. All items are sought in all documents, in blocks of
    about 2048 whose rows are written one after another. Repeated rows give one row; documents with a
    null id are reported as null.
    """
    words = Cut(hashed(docs), batch=1000)
    space = words.df.sparkSession.sparkContext.broadcast(fit(words.df))
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = -(-items.count() // ITEMS) or 1
    parts = []
    for b in range(blocks):
        rows = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()]
        parts.append(Cut(words.df.mapInArrow(lambda x, rows=rows: _search(rows, space.value, least, sure, cosine)(x), HITS)))
    best = F.max_by(F.struct("cosine", "lcs", "answer", "start"), F.struct("lcs", "cosine", -F.col("start"))).alias("best")
    held = cut(reduce(DataFrame.unionByName, [p.df for p in parts]).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*"))
    for written in (words, *parts):
        written.drop()
    return held
