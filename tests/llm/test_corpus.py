"""Phrases, the audit of filters and language-model scores, against brute force."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from helpers import AWKWARD, DOCS, documents, prose

from logloom.llm import audit, ngrams, phrases, suffix_tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least, covered, top, longest=4):
    """What phrases.mine gives for rows (lang, text)."""
    counts = {}
    for lang, text in rows:
        at = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            at.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = {}
    for lang, at in counts.items():
        n = sum(c for g, c in at.items() if len(g) == 1)
        often = {g: a for g, a in at.items() if a >= least}
        found = []
        for g, a in often.items():
            if len(g) == 1 or any(len(x) > len(g) and 100 * c >= covered * a and any(x[i : i + len(g)] == g for i in range(len(x))) for x, c in often.items()):
                continue
            score, k = min((2_000_000 * a // (at[g[:k]] + at[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), at[g[:k]], at[g[k:]], n))
        out |= {(lang, i): (p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:top], 1)}
    return out


def texts(seed):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "red", "fox", "ÉÀ", "été", "a-b", "x" * 40, "\x85n", "zoo", "\xa0", "\x1f"]
    rows = [(rnd.choice(["en", "fr", None]), rnd.choice([" ", "\t", "  "]).join(rnd.choice(words) + rnd.choice([""] * 6 + [".", ", ", "\n", "?\r", "!"]) for _ in range(rnd.randint(0, 60)))) for _ in range(120)]
    return rows + [("en", "new york city hall is new york city hall in new york. " * 7), ("en", None), (None, ""), ("fr", " \t . "), ("xx", None)]


def phrase_rows(spark, rows):
    return spark.createDataFrame([(i % 7, t, g, None, 0, "x", "y", "z", "w") for i, (g, t) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("bits", [15, 20])
def test_phrases_against_brute_force(spark, monkeypatch, bits):
    """Whatever the number of buckets, and however the texts are cut into chunks."""
    monkeypatch.setattr(phrases, "SALTS", (3, 2))
    rows = texts(1)
    found = phrases.mine(phrase_rows(spark, rows).repartition(3), least=5, top=40, bits=bits).collect()
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found} == mined(rows, 5, 80, 40) and len(found) > 60


def test_phrases_inside_longer_ones_go(spark):
    rows = [("en", "one two three four. " * 8 + "one two. " * 2 + "three four. " + "b c. " * 5), ("en", "z one two three")]
    found = phrases.mine(phrase_rows(spark, rows), least=5, bits=15).collect()
    assert [(r.phrase, r.a, r.score) for r in found] == [("b c", 5, 1_000_000), ("one two three four", 8, 800_000)]
    assert phrases.mine(phrase_rows(spark, []), bits=15).collect() == []


def test_counts_past_64_bits(spark):
    """A score is exact where 2000000 a is more than a long."""
    from pyspark.sql import functions as F

    a = 5 * 10**17
    score = spark.range(1).select(F.lit(a).alias("a"), F.lit(a).alias("l"), F.lit(a + 7).alias("r")).select(phrases.score().alias("s")).first().s
    assert score == 2_000_000 * a // (2 * a + 7)


def test_buckets_of_tasks_add_up(spark, monkeypatch):
    """An n-gram that is frequent only in all tasks together is found, whatever buckets are counted up to."""
    rows = spark.createDataFrame([("g", "a b c")] * 300 + [("g", f"a b d{i}") for i in range(9)], "group string, text string").repartition(7)
    split = lambda t: (t.split(), None)
    for full, least in ((65_535, 255), (65_535, 300), (65_535, lambda n: n // 4), (20, lambda n: 300)):
        monkeypatch.setattr(ngrams, "FULL", full)
        tables = ngrams.frequent(rows, split, 3, least, bits=16)
        assert [{(r.phrase, r["count"]) for r in t.df.collect()} for t in tables[1:]] == [{("a b", 309), ("b c", 300)}, {("a b c", 300)}]
    tables = ngrams.frequent(rows.where("text = 'a b c'"), split, 3, 255, bits=16)
    assert [{(r.phrase, r["count"]) for r in t.df.collect()} for t in tables] == [{("a", 300), ("b", 300), ("c", 300)}, {("a b", 300), ("b c", 300)}, {("a b c", 300)}]


def test_hashes_of_phrases_are_those_of_texts():
    chunk = ngrams.Chunk([("g", "a bé c a bé".encode()), ("h", b""), ("h", b"a b")], lambda t: (t.split(), None))
    assert np.array_equal(chunk.hashes(2)[chunk.whole(2)], ngrams.phrase_hashes(["g"] * 4 + ["h"], ["a bé", "bé c", "c a", "a bé", "a b"]))
    assert sorted(chunk.counted(np.flatnonzero(chunk.whole(2)), 2)) == [("g", "a bé".encode(), 2), ("g", "bé c".encode(), 1), ("g", b"c a", 1), ("h", b"a b", 1)]


def failing(text: str) -> str:
    words = re.findall("[^\x20\x09-\x0d]+", text)
    marks = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text))]
    return "".join(x for x, m in zip("ABCD", marks) if m)


def audited(docs, labels):
    """What audit.audit gives, by walking through the documents in every order."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails = [(part or "", failing(text or "") + "E" * (i is not None and i > least[text or ""]), i) for i, text, part in docs]
    out = {}
    for part in {p for p, _, _ in fails}:
        mine = [(f, i) for p, f, i in fails if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                earlier = sum(x in f for f, _ in mine) - len(gone)
                left = [d for d in left if x not in d[0]]
                out[part, "".join(order), step] = [len(left), len(gone), earlier, sum(f == x for f, _ in mine), sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)]
        for x in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == x)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == x:
                    v.append(total)
    return out


def test_audit_against_brute_force(spark):
    rnd = random.Random(4)
    pool = [prose(k, n) for k, n in enumerate((3, 90, 120, 160, 200))] + ["A B C " * 50, "AB #1 " + prose(8, 130), "|", "", None, "word\x0bword\x85word " * 60, "ÀÉ ÀÉ"]
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(pool), rnd.choice(["en", "fr", None])) for _ in range(160)] + [(i, t, "zz") for i, t in AWKWARD]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(i, t, g, None, 0, "x", "y", "z", "w") for i, t, g in docs], DOCS).repartition(5)
    found = audit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in found} == audited(docs, labels)
    assert len(found) == 4 * 600


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(documents(spark, []), labels).collect() == []
    one = audit.audit(documents(spark, [(1, None)]), labels).collect()
    assert len(one) == 600 and {(r.removed, r.shapley) for r in one if r.filter_order[r.step - 1] == "A"} == {(1, 120)}


class PlainTree:
    """A suffix tree in dictionaries, which predicts one token after another."""

    def __init__(self, texts, depth, least, least_context, discount):
        self.counts, self.depth = Counter(), depth
        for t in texts:
            w = self.tokens(t)
            self.counts.update(tuple(w[i : i + k]) for k in range(1, depth + 2) for i in range(len(w) - k + 1))
        self.words = {g[0]: c for g, c in self.counts.items() if len(g) == 1}
        self.n, self.total = sum(self.words.values()), sum(self.words.values()) + len(self.words) + 1
        self.least, self.discount = least, discount
        self.followed = {}
        for g, c in self.counts.items():
            if len(g) > 1 and c >= least:
                self.followed.setdefault(g[:-1], {})[g[-1]] = c
        self.states = {s for s in self.followed if self.counts[s] >= least_context and self.differs(s)}
        self.states |= {s[k:] for s in self.states for k in range(1, len(s))}

    @staticmethod
    def tokens(text):
        return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]

    def p(self, s, w, states=None):
        """The probability of w after s; where states are given, of the longest suffix that is one."""
        while s and (s not in self.followed if states is None else s not in states):
            s = s[1:]
        if not s:
            return (self.words.get(w, 0) + 1) / self.total
        next_, c = self.followed[s], self.counts[s]
        escape = 1 - sum(x - self.discount for x in next_.values()) / c
        return max(0, next_.get(w, 0) - self.discount) / c + escape * self.p(s[1:], w, states)

    def differs(self, s):
        next_, c = self.followed[s], self.counts[s]
        q = {w: self.p(s[1:], w) for w in next_}
        kept = sum(next_.values())
        kl = sum(x / c * math.log(x / c / q[w]) for w, x in next_.items())
        if kept < c:
            kl += (c - kept) / c * math.log((c - kept) / c / (1 - sum(q.values())))
        return 2 * c * kl > len(next_) + 3 * math.sqrt(2 * len(next_))

    def score(self, text):
        w = self.tokens(text)
        known = [x for x in w if x in self.words]
        base = sum(math.log10((self.words.get(x, 0) + 1) / self.total) for x in w)
        return len(w), len(known), self.n, base, sum(math.log10(self.p(tuple(w[max(0, i - self.depth) : i]), x, self.states)) for i, x in enumerate(w))


def language(seed, n):
    """Words of which some determine what follows."""
    rnd, out = random.Random(seed), []
    for _ in range(n):
        last, before = (out[-1] if out else ""), (out[-2] if len(out) > 1 else "")
        likely = {"new": "york", "york": "city" if before == "new" else "minster", "of": "the"}.get(last)
        out.append(likely if likely and rnd.random() < 0.8 else rnd.choice(["new", "york", "of", "the", "Éa", "x\xa0y", "city", "fox", f"w{rnd.randint(0, 300)}"]))
    return " ".join(out)


@pytest.mark.parametrize(("depth", "share"), [(1, 1 << 20), (2, 1 << 20), (2, 40), (3, 1)])
def test_scores_against_a_plain_tree(spark, monkeypatch, depth, share):
    """Wherever weights are: all with the tasks, some, none."""
    monkeypatch.setattr(suffix_tree, "SHARE", share)
    monkeypatch.setattr(suffix_tree, "KNOWN_BITS", 16)
    train = [(k, language(k, 80)) for k in range(60)] + [(70, None), (71, ""), (72, "NEW York")]
    asked = [(100, language(100, 90)), (101, "york minster new york minster unseen words"), (101, "new"), *AWKWARD]
    tree = suffix_tree.fit(documents(spark, train).repartition(4), depth=depth, fewest=4, context=5, bits=16)
    plain = PlainTree([t for _, t in train], depth, 4, 20, 0.5)
    assert {tuple(r.context.split(" ")) for s in tree.states for r in s.df.collect()} == plain.states and max(map(len, plain.states)) == depth
    rows = train + asked
    found = suffix_tree.score(documents(spark, rows).repartition(3), tree).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found)
    assert got == sorted((str(i), *(s := plain.score(t))[:3], round(s[3], 6), round(s[4], 6)) for i, t in rows)
    better = [r.score > r.base_score for r in found if r.doc_id == 100]
    assert better == [True]


def test_predictions_add_up_to_one():
    plain = PlainTree([language(k, 80) for k in range(40)], 2, 4, 20, 0.5)
    for s in [(), ("new",), ("new", "york"), ("zzz", "of")]:
        assert abs(sum(plain.p(s, w, plain.states) for w in [*plain.words, "unseen"]) - 1) < 1e-9


def test_a_tree_of_nothing(spark):
    tree = suffix_tree.fit(documents(spark, []), bits=16)
    (row,) = suffix_tree.score(documents(spark, [(1, "a b")]), tree).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0, 0)
    assert suffix_tree.score(documents(spark, []), suffix_tree.fit(documents(spark, [(1, "a b")]), bits=16)).collect() == []


def test_rare_next_words_are_counted(spark):
    """A next word that a context had once is its own, whatever share of the corpus that is."""
    train = [(k, language(k, 80)) for k in range(40)] + [(70, "new york rare once"), (71, "of the rarer")]
    tree = suffix_tree.fit(documents(spark, train).repartition(3), least_share=2.0**-9, bits=16)
    rare = suffix_tree.fit(documents(spark, train).repartition(3), least_share=2.0**-9, fewest=7, bits=16)
    assert {len(r.context.split(" ")) for s in tree.states for r in s.df.collect()} == {1, 2}
    asked = documents(spark, [(1, "the rarer"), (2, "york rare")])
    all_, cut = ({r.doc_id: r.score for r in suffix_tree.score(asked, t).collect()} for t in (tree, rare))
    assert all_[1] > cut[1] + 0.3 and all_[2] > cut[2] + 0.3


def test_a_tree_of_many_pieces(spark, monkeypatch):
    """Texts in many pieces and a frequent context's n-grams in several places give the plain tree's scores, and what
    the tree keeps of an n-gram is a few bytes."""
    monkeypatch.setattr(suffix_tree, "PIECE", 2000)
    monkeypatch.setattr(suffix_tree, "PART", 30)
    train = [(k, language(k, 80)) for k in range(60)] + [(61, "New  York\x0bcity\x1f")]
    tree = suffix_tree.fit(documents(spark, train).repartition(2), fewest=2, context=5)
    plain = PlainTree([t for _, t in train], 2, 2, 10, 0.5)
    assert max(int(level.places.max()) for level in tree.levels) > 3
    found = suffix_tree.score(documents(spark, train).repartition(3), tree).collect()
    assert sorted((r.doc_id, round(r.score, 6)) for r in found) == [(i, round(plain.score(t)[4], 6)) for i, t in train]
    whole = suffix_tree.fit(documents(spark, train).repartition(2), fewest=2, context=5)
    kept = [suffix_tree.unpack(r["keys"]) for g in whole.grams for r in g.df.collect()]
    assert sum(map(len, kept)) == sum(c >= 2 and len(g) > 1 and (g[:-1] in plain.followed and plain.counts[g[:-1]] >= 10) for g, c in plain.counts.items())
    assert len(suffix_tree.pack(np.sort(np.concatenate(kept)))) < 8 * sum(map(len, kept))
