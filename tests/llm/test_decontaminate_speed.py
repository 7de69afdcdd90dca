"""Words and sketch of decontamination: the same as by their plain definitions, and words at less cost."""

import time
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from helpers import AWKWARD

from logloom.llm import decontaminate


def plain(text):
    return [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in decontaminate.WORD.findall((text or "").lower())]


def test_words_are_those_of_the_pattern():
    many = "".join(map(chr, range(0x20, 0x3200))) + "\ud800a"
    texts = [*(t for _, t in AWKWARD), "snake_case a b café naïve—“x” ² é", "漢字kanaカナ 12一", "ไทย İstanbul", many, many[:4000]]
    for text in [None, *texts, *texts]:
        assert decontaminate.words_of(text).tolist() == plain(text)


def test_words_cost_less_than_by_the_pattern():
    text = "The quick brown fox, it is said, jumps over 12 lazy dogs. " * 2000 + "Grüße — et à bientôt! " * 2000

    def best(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f(text)
            took.append(time.process_time() - began)
        return min(took)

    by_pattern = lambda t: np.fromiter(map(zlib.crc32, " ".join(decontaminate.WORD.findall(t.lower())).encode().split(b" ")), np.uint32)
    assert best(decontaminate.words_of) < 0.75 * best(by_pattern)


def test_sketch_is_the_product(monkeypatch):
    monkeypatch.setattr(decontaminate, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng, columns = np.random.default_rng(3), 16
    docs = [rng.zipf(1.3, n).astype(np.uint64).astype(np.uint32) for n in (5000, 1, 64, 0, 130, 9000)]
    idf = rng.uniform(0.2, 9, decontaminate.TERMS).astype(np.float32)
    rows = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in docs], pa.binary())], ["words"])
    found = np.zeros((decontaminate.BLOCKS, decontaminate.TERMS // decontaminate.BLOCKS * columns))
    for b in decontaminate._sketch(idf, columns)(iter([rows])):
        for block, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            found[block] = np.frombuffer(data, "<f4")
    w = np.zeros((decontaminate.TERMS, columns))
    column, sign = decontaminate.random_directions(columns)
    w[np.arange(decontaminate.TERMS), column] = sign
    z = np.zeros_like(w)
    for x in docs:
        for i in range(0, len(x), decontaminate.PASSAGE):
            a = np.bincount(x[i : i + decontaminate.PASSAGE] & (decontaminate.TERMS - 1), minlength=decontaminate.TERMS) * idf.astype(float)
            norm = np.sqrt((idf[x[i : i + decontaminate.PASSAGE] & (decontaminate.TERMS - 1)].astype(float) ** 2).sum())
            z += np.outer(a / norm, (a / norm) @ w)
    assert np.abs(found.reshape(z.shape) - z).max() < 1e-5 * np.abs(z).max()
