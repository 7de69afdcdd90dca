"""Language identification by prediction with partial matching over bytes.

For each language a tree of byte contexts up to three bytes long holds how often each byte followed. A
byte costs -log2(n / (total + kinds)) bits in the longest known context that has seen it, and before
that -log2(kinds / (total + kinds)) bits for each escape from a longer one (method C); below the empty
context all 256 bytes are alike. The statistics are frozen: a text's code length under a language is
the sum over its bytes, and the language with the shortest code is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut

ORDER = 3
UNDETERMINED = "und"
BLOCK = 1 << 20
REMEMBERED = 1 << 24  # costs that a worker remembers; changes speed, never results


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The four bytes that end at each byte of each text (line ends stand before it), and where texts start."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.frombuffer(b"\n\n\n" + b"\n\n\n".join(texts), np.uint8).astype(np.uint32)
    all_grams = joined[3:] | joined[2:-1] << 8 | joined[1:-2] << 16 | joined[:-3] << 24
    if len(texts) > 1:  # drop what ends within the separators
        keep = np.ones(len(all_grams), bool)
        ends = np.cumsum(lengths)[:-1] + 3 * np.arange(len(texts) - 1)
        for k in range(3):
            keep[ends + k] = False
        all_grams = all_grams[keep]
    return all_grams, np.cumsum(lengths) - lengths


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


class Model:
    """Frozen statistics of all languages, and the code lengths that follow from them.

    Each language has its own tables of what followed each context of each length, so the model is as large
    as what was counted, whatever the number of languages.
    """

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray):
        """counts: a row for each four-byte key (sorted), a column for each language."""
        self.languages = languages
        self.levels = [self._tables(keys[c > 0], c[c > 0]) for c in counts.T]
        self._slots = None

    @classmethod
    def of(cls, counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
        """From the four-byte keys of each language and how often each occurred."""
        model = cls(sorted(counted), np.zeros(0, np.uint32), np.zeros((0, 0)))
        model.levels = [cls._tables(*counted[x]) for x in model.languages]
        return model

    def __getstate__(self):
        return self.__dict__ | {"_slots": None, "_known": None}

    @staticmethod
    def _tables(keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
        """By length of context: what followed and its bits, the contexts and the bits of an escape."""
        levels = []
        for k in range(ORDER + 1):
            part = keys & np.uint32((1 << 8 * (k + 1)) - 1) if k < ORDER else keys
            follow, at = np.unique(part, return_inverse=True)
            seen = np.bincount(at, counts, len(follow))
            context, at = np.unique(follow >> 8, return_inverse=True)
            total, kinds = np.bincount(at, seen, len(context)), np.bincount(at, minlength=len(context))
            levels.append((follow, -np.log2(seen / (total + kinds)[at]), context, -np.log2(kinds / (total + kinds))))
        return levels

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each key under each language."""
        out = np.full((len(keys), len(self.languages)), 8.0)
        for language, levels in enumerate(self.levels):
            left, escaped = np.arange(len(keys)), np.zeros(len(keys))
            for k in range(ORDER, -1, -1):
                follow, hit, context, escape = levels[k]
                if not len(follow):
                    continue
                part = keys[left] & np.uint32((1 << 8 * (k + 1)) - 1) if k < ORDER else keys[left]
                at = np.minimum(np.searchsorted(follow, part), len(follow) - 1)
                found = follow[at] == part
                out[left[found], language] = escaped[left[found]] + hit[at[found]]
                left, part = left[~found], part[~found]
                at = np.minimum(np.searchsorted(context, part >> 8), len(context) - 1)
                escaped[left] += np.where(context[at] == part >> 8, escape[at], 0.0)
            out[left, language] += escaped[left]
        return out

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """The same, with keys seen before looked up."""
        if self._slots is None:
            self._shift = np.uint32(32 - min(22, int(np.log2(REMEMBERED // len(self.languages)))))
            size = 1 << 32 - int(self._shift)
            self._slots, self._known = np.full(size, -1, np.int64), np.zeros((size, len(self.languages)), np.float32)
        at = (keys * np.uint32(0x9E3779B1)) >> self._shift
        out = self._known[at]
        missed = np.flatnonzero(self._slots[at] != keys)
        if len(missed):
            some, first, back = np.unique(keys[missed], return_index=True, return_inverse=True)
            new = self.costs(some).astype(np.float32)
            out[missed] = new[back]
            self._slots[at[missed[first]]], self._known[at[missed[first]]] = some, new
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            group.append(i)
            size += len(t)
            if size >= BLOCK or i + 1 == len(texts):
                keys, starts = grams([texts[j] for j in group])
                sums = np.zeros((len(group), len(self.languages)))
                if len(keys):
                    full = np.array([bool(texts[j]) for j in group])
                    for a in range(0, len(keys), 4 * BLOCK):  # very long texts in blocks
                        part = self.bits(keys[a : a + 4 * BLOCK])
                        inside = np.flatnonzero(full & (starts < a + len(part)) & (np.append(starts[1:], len(keys)) > a))
                        sums[inside] += np.add.reduceat(part, np.maximum(starts[inside] - a, 0), axis=0, dtype=np.float64)
                out[group] = sums
                group, size = [], 0
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and its share among all languages' probabilities of the text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        lengths = self.code_lengths([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        best = lengths.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(lengths.min(axis=1, keepdims=True) - lengths, -1000)).sum(axis=1)
        lettered = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)], np.where(lettered, share, 0.0)


def count_grams(rows: DataFrame) -> DataFrame:
    """lang, gram, n: of all four-byte sequences in rows (text, lang), summed within each task first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            of: dict[str, list[bytes]] = {}
            for text, lang in zip(b.column(0), b.column(1)):
                of.setdefault(lang.as_py(), []).append((text.as_py() or "").encode("utf-8", "surrogatepass"))
            for lang, texts in of.items():
                new = np.unique(grams(texts)[0], return_counts=True)
                held[lang] = _merged(*map(list, zip(held[lang], new))) if lang in held else new
        for lang, (keys, counts) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    counted = rows.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(each, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sampled(rows: DataFrame, most: int, in_all: int) -> DataFrame:
    """About `most` rows of each language that has more, by the hash of their text, and about `in_all` of all
    languages; all rows of the others. Rows are chosen as they are read: only the languages' sizes are collected."""
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = min(most, max(1, in_all // max(1, len(sizes))))
    large = {lang: share / n for lang, n in sizes.items() if n > share}
    if not large:
        return rows
    chances = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
    place = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.where(place < F.coalesce(F.try_element_at(chances, F.col("lang")), F.lit(1.0)))


def fit(rows: DataFrame, most: int = 20_000, in_all: int = 400_000) -> Model:
    """Learns from rows (text, lang) whose lang is not null; an empty or null text adds nothing.

    Of a language with more than `most` rows about so many are used, and of all together about `in_all`, in equal
    shares, which bounds the model; of these all counts are kept. Rows that repeat count as often; other columns are not read.
    """
    labelled = rows.where("lang is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = Cut(count_grams(sampled(labelled, most, in_all)))
    found = counted.df.toPandas()
    counted.drop()
    empty = labelled.select("lang").distinct().collect()  # a language may have empty texts alone
    grams = {lang: part for lang, part in found.groupby("lang")}
    none = np.zeros(0, np.uint32), np.zeros(0)
    of = {r.lang: none if (g := grams.get(r.lang)) is None else (g.gram.to_numpy(np.int64).astype(np.uint32), g.n.to_numpy(float)) for r in empty}
    return Model.of(of if len(found) else {})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score: one row per row of docs, in `und` and 0 where text is null or has no letter.

    Ties go to the language whose name sorts first. Repeated rows and null ids are rows of their own, texts of
    any length are read whole. Only text is read besides the id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, share = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(share)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, "doc_id long, lang_pred string, score double")
