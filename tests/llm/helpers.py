"""Brute-force counterparts and awkward rows for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, rep string, fp string, words string"


def documents(spark, rows):
    """Documents from (doc_id, text) with other columns, some of whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "x", "y", "z", "w") for i, t in rows], DOCS)


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "light", "garden", "window", "quiet", "yellow", "market", "paper", "engine", "ladder"]
    return " ".join(rnd.choice(words) + rnd.choice(["", "s", "ed", "ing", "er"]) for _ in range(n))


AWKWARD = [(9001, None), (9002, ""), (9003, "   \n\t "), (9004, "é漢字 \U0001f600 Ünï"), (None, "a row without an id, " + prose(99, 30)), (9005, "x" * 50_000), (9006, prose(7, 30_000))]


def groups(ids, linked) -> dict:
    """Smallest reachable id of each id, under a symmetric predicate on pairs."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(ids)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if find(i) != find(j) and linked(i, j):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}
