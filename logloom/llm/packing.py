"""Cost-balanced packing of tokenised documents into training sequences.

Documents are packed within the partition that reads them, a window of tokens at a time, so nothing is
shuffled and memory is bounded by a window and one document. A window fills as many full sequences as it
has tokens for. Each document costs linear * n + quadratic * n^2 (attention within the document); in
descending order each goes to the sequence of the lowest cost that has room for all of it. What fits nowhere
waits; once smaller documents have filled what they can, it is cut to fill the rest, and what is left, less
than a sequence, goes to the next window. Only the last window of a partition has sequences that are not
full: powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
END = 1
WINDOW = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Encoded chunks that a worker remembers; it starts anew beyond that. Changes speed, never ids.
REMEMBERED, CHUNK_CHARS = 400_000, 48
#: A word of Latin letters, then signs that the tokenizer keeps apart from it.
WORD_AND_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: Byte-level vocabularies name the two bytes of such letters so: bytes from 161 on but 173 by their own character, others by the next free one.
BYTE_NAMES = {c: chr(195) + (chr(b) if (b := 128 + c % 64) > 160 and b != 173 else chr(256 + (33 + 1 + b - 128 if b < 161 else 67))) for c in range(192, 256)}


class Encoder:
    """Token ids of whole texts, as unsigned 16 or 32 bits.

    White space separates tokens in the tokenizers this is for and leaves no token, so a text's ids are
    those of its pieces between spaces and line ends, one after another; pieces are remembered. A piece
    that is a word of Latin letters, with or without signs after it, is merged by the tokenizer's model
    alone: of its earlier steps only lower-casing and the naming of bytes concern such a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4")
        self.chunks, self.words, self.signs = Remembered(self.chunk), Remembered(self.word), Remembered(self.whole)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def word(self, word: str) -> bytes:
        return np.array([t.id for t in self.merge(word.translate(BYTE_NAMES))], self.kind).tobytes()

    def chunk(self, chunk: str) -> bytes:
        if m := WORD_AND_SIGNS(chunk):
            word, signs = m.groups()
            return self.words[word.lower()] + (self.signs[signs] if signs else b"")
        return self.whole(chunk) if chunk else b""

    def text(self, text: str | None) -> np.ndarray:
        for known in (self.chunks, self.words, self.signs):
            if len(known) > REMEMBERED:
                known.clear()
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, (text or "").replace("\n", " ").split(" "))), self.kind)


class Remembered(dict):
    """Short keys' values are kept, others are made each time."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= CHUNK_CHARS:
            self[key] = value
        return value


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def capacities(total: int, length: int = LENGTH) -> list[int]:
    """Sequence sizes that add up to `total`: full ones, then falling powers of two."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


Piece = tuple[int, int, int, int, int]


def fill(todo: list[tuple[int, int, int]], capacity: list[int], linear: float, quadratic: float) -> tuple[list[Piece], list[tuple[int, int, int]]]:
    """Puts (length, document, start) into sequences of these capacities: pieces (document, start, length,
    sequence, offset), and what has no room any more."""
    room = np.array(capacity, np.int64)
    cost, used = np.zeros(len(room)), np.zeros(len(room), np.int64)
    pieces: list[Piece] = []

    def put(doc: int, start: int, n: int, at: int) -> None:
        pieces.append((doc, start, n, at, int(used[at])))
        used[at] += n
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n

    waiting, left = [], []
    for n, doc, start in sorted(todo, key=lambda x: (-x[0], x[1])):
        at = int(np.where(room >= n, cost, np.inf).argmin()) if len(room) else 0
        if len(room) and room[at] >= n:
            put(doc, start, n, at)
        else:
            waiting.append((n, doc, start))
    for n, doc, start in waiting:
        while n and room.any():
            at = int(room.argmax())
            part = min(n, int(room[at]))
            put(doc, start, part, at)
            n, start = n - part, start + part
        if n:
            left.append((n, doc, start))
    return pieces, left


def pack(sizes: list[int], length: int = LENGTH, linear: float = 1.0, quadratic: float = 1 / 1024, starts: list[int] | None = None, last: bool = True) -> tuple[list[Piece], list[tuple[int, int, int]]]:
    """Pieces of documents of these sizes, from `starts` on, and what is left. Full sequences, and if these are
    the last documents the powers of two of the rest, so that nothing is left."""
    starts = starts or [0] * len(sizes)
    total = sum(sizes) - sum(starts)
    pieces, rest = [], []
    for doc, (n, start) in enumerate(zip(sizes, starts)):
        while n - start >= length:
            pieces.append((doc, start, length, len(pieces), 0))
            start += length
        if n > start:
            rest.append((n - start, doc, start))
    whole = len(pieces)
    capacity = capacities(total - whole * length, length) if last else [length] * (total // length - whole)
    more, left = fill(rest, capacity, linear, quadratic)
    return pieces + [(doc, start, n, at + whole, offset) for doc, start, n, at, offset in more], left


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, window: int = WINDOW, linear: float = 1.0, quadratic: float = 1 / 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one token, the end. A null doc_id stays null, repeated rows are packed each;
    other columns are not read. No rows give no pieces. sequence_id is unique over all partitions.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        ids, held, starts, tokens = [], [], [], 0

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal ids, held, starts, tokens, made
            of = [len(x) for x in held]
            pieces, left = pack(of, length, linear, quadratic, starts, last)
            doc, start, n, at, offset = np.array(pieces, np.int64).reshape(-1, 5).T
            crc = [zlib.crc32(held[d][s : s + k].astype("<u4").tobytes()) for d, s, k in zip(doc, start, n)]
            rows = [pa.array([ids[d] for d in doc], pa.int64()), start, n, pa.array(crc, pa.int64()), np.array(of, np.int64)[doc], at + base + made, offset]
            made += int(at.max(initial=-1)) + 1
            ids, held, starts, tokens = [ids[d] for _, d, _ in left], [held[d] for _, d, _ in left], [s for _, _, s in left], sum(k for k, _, _ in left)
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in rows], SCHEMA.replace(" long", "").split(", "))

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                x = encoder(tokenizer).text(text.as_py())
                ids.append(doc_id.as_py())
                held.append(np.append(x, x.dtype.type(END)))
                starts.append(0)
                tokens += len(held[-1])
                if tokens >= window:
                    yield packed(False)
        if held:
            yield packed(True)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, SCHEMA)
