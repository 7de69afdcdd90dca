"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding lower-cases, maps look-alike letters of other scripts to Latin ones and undoes digits and signs
used as letters inside words and at their edges. The lexicon is learned from labelled rows: beginnings of words (and whole
words) that are far more frequent in toxic texts, each weighted by its log odds. A word counts with its
longest known beginning, so a whole word that clean texts use is an exception to a shorter beginning. Pairs
of words, one of the lexicon, that clean texts rather than toxic ones hold are exceptions too. The sum of weights, as such and per word, goes through a logistic curve
fitted on a bounded sample of labelled rows, shifted so that the best cut falls at the threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, text_hash

# Look-alike letters and the Latin ones that they stand for.
HOMOGLYPHS = str.maketrans({
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b", "ԁ": "d",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "η": "n",
})
# Digits and signs that stand for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Harmless phrases, besides those that are learned.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "pond scum", "class clown", "sore loser", "loser of the match", "loser bracket")

WORD = re.compile(r"[^\W\d_]+")
LOOK_ALIKE = re.compile("[\u0370-\u03ff\u0400-\u052f\uff01-\uff5e\u200b-\u200d\u00ad]")
#: Inside a word any of these is a letter; at its edges a mark of exclamation is not.
INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![\w@$])[0134578@$]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$]+(?![\w@$.])")
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | dict.fromkeys((0x200B, 0x200C, 0x200D, 0xAD))
LONGEST = 16


def fold(text: str | None) -> str:
    text = (text or "").lower()
    if LOOK_ALIKE.search(text):
        text = text.translate(WIDE).lower().translate(HOMOGLYPHS)
    return INSIDE.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), " ".join(text.split()))


def beginnings(word: str, shortest: int) -> list[str]:
    """Beginnings of a word, and the word itself marked as whole."""
    return [word[:n] for n in range(shortest, min(len(word), LONGEST) + 1)] + [word[: 4 * LONGEST] + "|"]


@dataclass
class Lexicon:
    """weights: log odds by beginning or whole word (ends in '|'). curve: intercept and coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    shortest: int = 4
    curve: tuple[float, ...] = (-4.0, 1.0, 1.0, 1.0)
    _seen: dict[str, float] = field(default_factory=dict, repr=False)
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_seen": {}, "_automaton": None}

    def automaton(self):
        """Finds lexicon entries and exception phrases in one pass over a text."""
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for entry in self.weights:
                found.add_word(entry.rstrip("|"), (len(entry.rstrip("|")), False))
            for phrase in self.exceptions:
                found.add_word(phrase, (len(phrase), True))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def weight(self, word: str) -> float:
        if word not in self._seen:
            if len(self._seen) > 100_000:
                self._seen.clear()
            known = [b for b in beginnings(word, self.shortest) if b in self.weights]
            self._seen[word] = max(0.0, self.weights[known[-1]]) if known else 0.0
        return self._seen[word]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Of the folded text: log of the summed weight, log of the weight per 100 words, log of hits."""
        folded = fold(text)
        starts, spared = set(), set()
        if self.weights:
            for end, (n, phrase) in self.automaton().iter(folded):
                at = end - n + 1
                if at and folded[at - 1].isalpha():
                    continue
                if phrase:
                    if not folded[end + 1 : end + 2].isalpha():
                        spared.update(range(at, end + 1))
                else:
                    starts.add(at)
        hits = [w for at in starts - spared if (w := self.weight(WORD.match(folded, at)[0]))]
        total, words = sum(hits), max(1, len(folded.split()))
        return math.log1p(total), math.log1p(100 * total / words), math.log1p(len(hits))

    def score(self, text: str | None) -> float:
        x = self.curve[0] + sum(a * b for a, b in zip(self.curve[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _word_counts(rows: DataFrame) -> DataFrame:
    """word, bad, good: occurrences over all the labelled rows, pre-aggregated by batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[int, Counter] = defaultdict(Counter)
            for text, label in zip(b.column(0), b.column(1).to_pylist()):
                counts[label].update(WORD.findall(fold(text.as_py())))
            words = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([counts[k][w] for w in words], pa.int64()) for k in (1, 0))], ["word", "bad", "good"])

    return rows.select("text", "label").mapInArrow(each, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _pairs(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """phrase, bad, good: how often words of the lexicon stand beside each other word, by label."""

    def phrases(text: str | None) -> Iterator[str]:
        words = fold(text).split(" ")
        for left, right in zip(words, words[1:]):
            if left.isalpha() and (m := WORD.match(right)) and (lexicon.weight(left) or lexicon.weight(m[0])):
                yield f"{left} {m[0]}"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[int, Counter] = defaultdict(Counter)
            for text, label in zip(b.column(0), b.column(1).to_pylist()):
                counts[label].update(phrases(text.as_py()))
            some = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *(pa.array([counts[k][w] for w in some], pa.int64()) for k in (1, 0))], ["phrase", "bad", "good"])

    return rows.select("text", "label").mapInArrow(each, "phrase string, bad long, good long").groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a logistic regression with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) / 1000 * np.eye(len(w)), x.T @ (y - p) - ridge * len(x) / 1000 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The cut on z with the highest F1, between two values of z."""
    order = np.argsort(-z, kind="stable")
    z, hits = z[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    last = np.append(z[1:] != z[:-1], True)
    k = int(np.where(last, f1, -1).argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k])


def sample_labels(labels: DataFrame, most: int = 40_000) -> DataFrame:
    """doc_id and label of at most `most` labelled rows, those whose hashed id is smallest, one per id."""
    one = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 40_000, least: int = 5, odds: float = 1.5, strength: float = 30.0, shortest: int = 4, threshold: float = 0.7, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learns from the texts of docs (doc_id, text) that labels (doc_id, label of 0 or 1) has.

    A bounded sample of `sample` labelled rows is used, so the ids are broadcast and texts not shuffled.
    It gives the lexicon, which it bounds too: all beginnings that are seen `least` times in toxic texts, with log
    odds of `odds` and a likelihood ratio of `strength` or more; whole words of lower odds under them come along as
    exceptions, and all pairs of a word of the lexicon and its neighbour that `least` places in clean texts hold,
    and clean texts rather than toxic ones. The same sample fits the curve. Labels that are null or other, and rows without text, teach nothing; an id
    with both labels counts as 1, and an id with several texts teaches one of them, by its hash. With no rows: an empty lexicon, under which all texts score alike.
    """
    chosen = F.broadcast(sample_labels(labels, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    one = F.min(F.struct(text_hash(F.col("text")).alias("h"), "text")).alias("one")  # an id may repeat, the sample must not grow
    taken = Cut(rows.groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.text"))
    lexicon = _fit(taken.df, least, odds, strength, shortest, threshold, exceptions)
    taken.drop()
    return lexicon


def _fit(rows: DataFrame, least: int, odds: float, strength: float, shortest: int, threshold: float, exceptions: tuple[str, ...]) -> Lexicon:
    words = _word_counts(rows)
    parts = words.select("bad", "good", F.explode(F.concat(F.transform(F.sequence(F.lit(shortest), F.greatest(F.lit(shortest), F.least(F.length("word"), F.lit(LONGEST)))), lambda n: F.substring("word", F.lit(1), n)), F.array(F.concat(F.substring("word", 1, 4 * LONGEST), F.lit("|"))))).alias("part"))
    parts = parts.where(F.length("part") >= shortest).groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad_all, good_all = (float(x or 0) for x in words.agg(F.sum("bad"), F.sum("good")).first())
    if not bad_all or not good_all:
        return Lexicon({}, exceptions, shortest)
    share = bad_all / (bad_all + good_all)
    n = F.col("bad") + F.col("good")
    log_odds = F.log((F.col("bad") + 0.5) / bad_all) - F.log((F.col("good") + 0.5) / good_all)
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = 2 * (term(F.col("bad"), n * share) + term(F.col("good"), n * (1 - share)))
    scored = parts.where(f"bad >= {least}").select("part", log_odds.alias("w"), ratio.alias("g"))
    found = {r.part: r.w for r in scored.where((F.col("w") >= odds) & (F.col("g") >= strength)).orderBy(F.desc("g"), "part").collect()}
    clean = parts.where("part like '%|' and good >= 20").select("part", log_odds.alias("w")).where(F.col("w") < odds)
    heads = rows.sparkSession.createDataFrame([(x,) for x in found if not x.endswith("|")] or [("",)], "head string")
    under = clean.withColumn("head", F.explode(F.transform(F.sequence(F.lit(shortest), F.greatest(F.lit(shortest), F.least(F.length("part") - 1, F.lit(LONGEST)))), lambda n: F.substring("part", F.lit(1), n))))
    found |= {r.part: r.w for r in under.join(F.broadcast(heads), "head").select("part", "w").distinct().orderBy("w", "part").collect()}
    lexicon = Lexicon(found, exceptions, shortest)
    pairs = _pairs(rows, lexicon).where(F.col("good") >= least).where((F.col("good") + 0.5) / good_all > (F.col("bad") + 0.5) / bad_all)
    learned = [r.phrase for r in pairs.orderBy(F.desc("good"), "phrase").collect()]
    lexicon = Lexicon(found, tuple(dict.fromkeys([*exceptions, *learned])), shortest)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [lexicon.features(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in (zip(*x) if x else ([], [], []))), b.column(1)], ["a", "b", "c", "label"])

    got = rows.select("text", "label").mapInArrow(each, "a double, b double, c double, label int").toPandas().to_numpy(float)
    x, y = got[:, :3], got[:, 3]
    if len(set(y)) < 2:
        return lexicon
    w = _logistic(x, y)
    w[0] += math.log(threshold / (1 - threshold)) - _best_cut(w[0] + x @ w[1:], y)
    lexicon.curve = tuple(float(v) for v in w)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted: one row per row of docs; null and empty texts get the score of no hits.

    Repeated rows and null ids are kept as they are; other columns are not read.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [lexicon.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold."""
    at = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):  # small pieces go back, so that few copies are held
                part = b.slice(i, 1000)
                yield part.filter(pa.array([lexicon.score(t.as_py()) < threshold for t in part.column(at)], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
