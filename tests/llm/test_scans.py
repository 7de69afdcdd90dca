"""Licenses, personal data, toxicity, languages, decontamination and HTML."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.llm import decontaminate, html, language, licenses, pii, toxicity


def test_licenses(spark):
    mit = "Some code. Released under the MIT License. " + prose(1, 20)
    rows = [
        (1, mit), (2, "Licensed under the Apache License, Version 2.0."), (3, "CC-BY-NC and cc by nc; under the mit  license"), (4, prose(2, 50)), (5, "under the mit"),
        (6, "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and associated documentation files"), (7, mit + " " + mit),
        (8, "This work is licensed under the GNU General Public License, version 3."), (8, "This work is licensed under the GNU General Public License, version 3."), *AWKWARD,
    ]
    got = {}
    found = licenses.scan(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        got[r.doc_id] = r
    word = re.compile(licenses.WORD)
    for i, t in rows:
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        places = [(p, label) for label, phrase in licenses.PHRASES for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places}))), i
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[6].labels == "mit" and got[6].n_base == 0 and 0.7 <= got[6].score < 1
    assert got[8].labels == "gpl-3" and got[4].labels == got[5].labels == "" and got[4].score == 0
    assert got[7].n_base == 2 and len([s for s in got[7].spans if s.label == "mit" and s.end - s.start == 5]) == 2
    assert licenses.scan(documents(spark, [])).count() == 0
    plan = licenses.scan(documents(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_licenses_of_whole_texts_and_repeats(spark):
    """A verbatim notice is found whatever stands beside it; of whole license texts, changed ones too."""
    whole = max((t for label, t in licenses.NOTICES if label == "mit"), key=len)
    changed = whole.replace("the software is furnished", "said work is given").replace("substantial portions", "large parts")
    rows = [(1, "licensed under cc by 4 0 by 4 0 by 4 0 x"), (2, f"{prose(1, 9)} {whole} {prose(2, 30)}"), (3, f"{prose(3, 40)} {changed} {prose(4, 9)}"), (4, " ".join(whole.split()[::-1])), (None, rows_of := "under the mit license"), (None, rows_of)]
    found = licenses.scan(documents(spark, rows)).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == 6 and [got[i].labels for i in (1, 2, 3, 4)] == ["cc-by", "mit", "mit", ""] and got[None].n_base == 1
    longest = lambda r: max(s.end - s.start for s in r.spans)
    assert longest(got[2]) == len(whole.split()) and 0.9 * len(whole.split()) < longest(got[3]) <= len(whole.split()) + 3


def test_repeated_fragments_are_no_notice(spark):
    """A notice's place counts once however often the text has it; votes are of the notice's own words."""
    rng = random.Random(6)
    short = [(label, t.split()) for label, t in licenses.NOTICES if len(t.split()) < 20]
    rows = [(1, "under cc by under cc by under cc by"), (2, "the gnu general the gnu general the gnu general public public license version"), (3, "licensed under cc by 4 0")]
    for i in range(10, 120):
        label, w = rng.choice(short)
        a = rng.randrange(len(w) - 2)
        rows.append((i, " ".join((w[a : a + rng.randint(3, 5)] + ["x"] * rng.randrange(3)) * rng.randint(2, 5) + w[: rng.randrange(len(w) + 1)])))
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert [found[i].labels for i in (1, 2, 3)] == ["", "", "cc-by"]
    for i, text in rows:
        words = text.split()
        for at in found[i].spans:
            span = words[at.start : at.end]
            held = {tuple(span[k : k + 3]) for k in range(len(span) - 2)}
            covers = [len({p for p in range(len(w) - 2) if tuple(w[p : p + 3]) in held}) / (len(w) - 2) for label, w in [(x, t.split()) for x, t in licenses.NOTICES + licenses.PHRASES] if label == at.label]
            assert max(covers) >= at.cover >= 0.7 and at.cover <= 1, (text, at)


def test_hashes_are_spark_s(spark):
    rows = [("a", "bé", "c"), ("", "x" * 50, "zz zz")]
    got = spark.createDataFrame(rows, "a string, b string, c string").select(F.xxhash64("a", "b", "c").alias("h")).collect()
    assert [r.h for r in got] == [licenses.gram_hash(r) for r in rows]


def test_languages_are_sampled_as_they_are_read(spark):
    """Of large languages a share, by the texts; of small ones all; and no join or shuffle of the texts."""
    rows = spark.createDataFrame([(f"text {i} {prose(i, 3)}", "large" if i % 10 else "small") for i in range(4000)] + [(f"rest {i}", "large") for i in range(2000)], "text string, lang string")
    plan = language.sampled(rows, 800, 10_000)
    counts = {r.lang: r.n for r in plan.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert counts["small"] == 400 and 650 < counts["large"] < 950
    assert "Join" not in (text := plan._jdf.queryExecution().executedPlan().toString()) and "Exchange" not in text
    few = {r.lang: r.n for r in language.sampled(rows, 800, 400).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert 130 < few["small"] < 270 and 130 < few["large"] < 270


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(d)]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text("a1.@+- ()9%_é\n4", max_size=40))
def test_base_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii(spark):
    rnd = random.Random(1)

    def card():
        while True:
            d = "".join(rnd.choice("0123456789") for _ in range(16))
            if pii.luhn(d):
                return d

    rows = [(i, f"{prose(i, 20)} {rnd.choice(['mail', 'write'])} a.b{i}@mail{i % 9}.example.com then {card()} and 10.0.{i % 250}.7 call +1 (201) 555-{1000 + i} {prose(i, 5)}") for i in range(80)]
    one = card()
    broken = one[:-1] + str((int(one[-1]) + 1) % 10)
    rows += [(200, f"{prose(4, 9)} mail a.b@mail1.example.com then {broken} and 10.0.3.7 call +1 (201) 555-1000"), (201, prose(3, 40)), (202, "1" * 20_000 + "@" * 200 + "." * 200), (203, "0" * 5000 + ".1.1.1 and " + "9" * 5000 + ".1.1.1"), *AWKWARD]
    docs = documents(spark, rows)
    field = pii.fit(docs)
    found = pii.find(docs, field)
    by = {r.doc_id: r for r in pii.digest(found).collect()}
    assert len(by) == len(rows)
    for i, t in rows:
        base = plain_spans(t or "") if i != 203 else [(0, 1, 5006)]
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert by[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
        assert [by[i][f"n_{k}"] for k in pii.KINDS[: pii.BASE]] == [sum(b[1] == n for b in base) for n in range(4)]
        assert set(filter(None, text.split(","))) <= set(by[i].spans.split(","))
    start = rows[80][1].index(broken)
    assert f":{start}:{start + 16}" not in by[200].spans  # of the form and in the place of valid ones, but it can't be one
    assert by[201].spans == ""
    empty = documents(spark, [])
    assert pii.find(empty, pii.fit(empty)).count() == 0


def test_hidden_personal_data(spark):
    """Forms that no pattern matches are found from their form, context and repeats; other numbers are left alone."""
    rnd = random.Random(12)
    pick = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    rows, added, other = [], {}, set()
    for i in range(150):  # what the patterns find
        rows.append((i, f"{prose(i, 15)} name{i}@mail{i % 9}.example.com {prose(i + 500, 6)} +1 (2{pick(2)}) 555-{pick(4)} {prose(i, 4)} {rnd.randrange(1, 250)}.7.{i}.9 {prose(i, 9)} token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" {prose(i, 5)}"))
    for i in range(40):  # what they don't
        forms = [("email", f"who{i}[at]mail{i % 9}.example.com"), ("email", f"who{i} (at) mail{i % 9} (dot) example (dot) com"), ("phone", f"(2{pick(2)}) 555-{pick(4)}"), ("phone", f"2{pick(2)}-555-{pick(4)}"), ("ip", f"{rnd.randrange(1, 250)}[.]8[.]{i}[.]77"), ("secret", hashlib.sha1(f"k{i}".encode()).hexdigest())]
        kind, form = forms[i % 6]
        text = f"{prose(900 + i, 12)} {'secret: ' if kind == 'secret' else ''}{form} "
        rows.append((1000 + i, text + prose(i, 8)))
        added[1000 + i] = f"{kind}:{text.index(form)}:{text.index(form) + len(form)}"
        rows.append((2000 + i, f"{prose(70 + i, 9)} {pick(16)} {prose(i, 5)} {pick(8)} version 3.{i} {prose(i, 7)}"))
    one = hashlib.sha1(b"again").hexdigest()
    rows.append((3000, f"{prose(5, 9)} token = \"{one}\" {prose(6, 400)} {one} {prose(7, 10)}"))
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in pii.find(docs, pii.fit(docs)).collect()}
    shown = {i: [f"{x.kind}:{x.start}:{x.end}" for x in r.spans if not x.base] for i, r in found.items()}
    hit = [i for i, want in added.items() if want in shown[i]]
    assert len(hit) >= 0.9 * len(added), [(added[i], shown[i]) for i in added if i not in hit]
    wrong = [(i, x) for i, xs in shown.items() for x in xs if x != added.get(i) and i >= 1000 and i != 3000]
    valid = {i for i, t in rows if 2000 <= i < 3000 and plain_spans(t)}
    assert not [w for w in wrong if w[0] not in valid]
    assert len(shown[3000]) == 2 and {x.split(":")[0] for x in shown[3000]} == {"secret"}


def test_repeats_decide(spark):
    """A bare number that repeats a phone announced elsewhere is found, by the edges alone; the same form that
    repeats nothing, and long numbers that fail the card's check, are left alone."""
    rnd = random.Random(31)
    pick = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    rows, repeats = [], {}
    for i in range(120):
        number = f"2{pick(2)}555{pick(4)}"
        text = f"{prose(i, 9)} phone +1 ({number[:3]}) {number[3:6]}-{number[6:]} {prose(i, 200)} "
        rows.append((i, text + f"{number} {prose(i, 7)} {pick(10)} {prose(i, 5)} {pick(10)} {prose(i + 1, 6)} {pick(10)} {prose(i, 9)} {pick(16)} {prose(i, 3)}"))
        repeats[i] = (len(text), len(text) + 10)
    docs = documents(spark, rows)
    field = pii.fit(docs)
    alone = pii.Field(field.node, np.zeros_like(field.edge))
    hits = {}
    for name, f in (("edges", field), ("alone", alone)):
        added = {(r.doc_id, x.start, x.end) for r in pii.find(docs, f).collect() for x in r.spans if not x.base}
        right = {(i, *at) for i, at in repeats.items()}
        hits[name] = (len(added & right), len(added - right))
    assert hits["edges"][0] >= 0.95 * len(repeats) and hits["edges"][1] <= 2 and hits["alone"][0] <= 0.1 * len(repeats), hits
    card = next(n for n in iter(lambda: pick(16), "") if not pii.luhn(n))
    g = pii.graph(f"card {card} and {card}", [])
    kinds = field.label([g])[0]
    assert all(p[pii.KINDS.index("card")] < 1e-6 for p, n in zip(kinds, g.nodes) if n[0] >= 0)


def exact_marginals(field, g):
    """By enumeration; right for graphs without loops, which message passing must equal."""
    n, k = len(g.nodes), pii.NONE + 1
    total = np.zeros((n, k))
    pot = (np.array([x[2] for x in g.nodes])[:, None] >> np.arange(pii.SIGNS) & 1) @ field.node
    for code in range(k**n):
        y = [code // k**i % k for i in range(n)]
        if any(x[3] >= 0 and x[3] != y[i] for i, x in enumerate(g.nodes)):
            continue
        p = math.exp(sum(pot[i, y[i]] for i in range(n) if g.nodes[i][3] < 0) + sum(field.edge[t, y[a], y[b]] for a, b, t in g.edges))
        for i in range(n):
            total[i, y[i]] += p
    return total / total.sum(axis=1, keepdims=True)


def test_message_passing_on_a_tree():
    rnd = np.random.default_rng(1)
    field = pii.Field(rnd.standard_normal((pii.SIGNS, pii.NONE + 1)), rnd.standard_normal((3, pii.NONE + 1, pii.NONE + 1)))
    g = pii.Graph([(0, 1, 5, -1), (2, 3, 9, 2), (4, 5, 129, -1), (6, 7, 3, -1)], [(1, 0, 0), (2, 0, 1), (3, 2, 2)])
    assert np.allclose(field.label([g], rounds=60)[0], exact_marginals(field, g), atol=1e-5)


def test_toxicity(spark):
    rnd = random.Random(2)
    bad = ["vilewort", "grubnard", "snotfang"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = prose(i, 60).split()
        for _ in range(3 if toxic else 0):
            words.insert(rnd.randrange(60), rnd.choice(bad) + rnd.choice(["", "s", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    labels += [(601, None, "x"), (None, 1, "x"), (3, 0, "again")]
    tests = [(1000, prose(5, 30) + " v1lewort and gru8nards"), (1001, prose(5, 30) + " vilеwоrt snotfang"), (1002, prose(6, 30)), (1003, "SNOTFANG vilewort"), *AWKWARD]  # some letters are Cyrillic
    lexicon = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, label int, text string"))
    found = toxicity.score(documents(spark, rows + tests), lexicon).collect()
    assert len(found) == len(rows) + len(tests)
    got = {r.doc_id: r for r in found}
    assert [got[i].predicted for i in range(600)] == [int(i % 5 == 0) for i in range(600)]
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003)] == [1, 1, 0, 1]
    assert got[9001].score == got[9002].score < 0.7 and got[9006].predicted == 0
    assert {r.doc_id for r in toxicity.keep_clean(documents(spark, rows + tests), lexicon).collect()} == {i for i, r in got.items() if not r.predicted}
    spared = toxicity.Lexicon({"trash": 5.0, "loser": 5.0}, toxicity.EXCEPTIONS)
    assert spared.features("put it in the trash can")[2] == 0 and spared.features("you trash, loser")[2] > 0
    nothing = toxicity.fit(documents(spark, rows), spark.createDataFrame([], "doc_id long, label int"))
    assert nothing.weights == {} and toxicity.score(documents(spark, []), nothing).count() == 0


def test_repeated_ids_teach_once(spark):
    rows = [(i % 40, f"{prose(i, 20)} {'vilewort' if i % 40 % 4 == 0 else ''}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, label int")
    seen = []
    fit = toxicity._fit
    try:
        toxicity._fit = lambda taken, *rest: seen.append(taken.count()) or fit(taken, *rest)
        toxicity.fit(documents(spark, rows), labels)
    finally:
        toxicity._fit = fit
    assert seen == [40]


def plain_features(lexicon, text):
    """Word by word, without an automaton."""
    folded = toxicity.fold(text)
    spared = {i for p in lexicon.exceptions for m in re.finditer(rf"(?<![^\W\d_]){re.escape(p)}(?![^\W\d_])", folded) for i in range(*m.span())}
    total = hits = 0
    for m in re.finditer(r"[^\W\d_]+", folded):
        best = max((e for e in lexicon.weights if (m[0] == e[:-1] if e.endswith("|") else m[0].startswith(e))), key=lambda e: (len(e.rstrip("|")), e.endswith("|")), default=None)
        if best and m.start() not in spared and lexicon.weights[best] > 0:
            total, hits = total + lexicon.weights[best], hits + 1
    return math.log1p(total), math.log1p(100 * total / max(1, len(folded.split()))), math.log1p(hits)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["trash", "trashy", "can", "cannot", "you", "$tupid", "stupid!", "stup1d", "стuрid", "loser", "losers", "lose", "0ld", "as$", "x.", ","]), max_size=12), st.sampled_from([" ", "  ", "\n"]))
def test_scores_against_plain_matching(words, between):
    lexicon = toxicity.Lexicon({"tras": 3.0, "trash|": 2.0, "stup": 4.0, "lose": 1.5, "lose|": -1.0, "losers|": 0.5}, ("trash can", "you loser"))
    text = between.join(words)
    assert np.allclose(lexicon.features(text), plain_features(lexicon, text))


def test_edges_of_words():
    lexicon = toxicity.Lexicon({"trash": 5.0, "stupid": 5.0}, toxicity.EXCEPTIONS)
    assert lexicon.features("you are trash cannot you see")[2] > 0 and lexicon.features("the trash can.")[2] == lexicon.features("the trash\ncan")[2] == 0
    assert lexicon.features("$tupid")[2] == lexicon.features("5tupid!")[2] == lexicon.features("stupid")[2] > 0
    assert toxicity.fold("Wow! At 10$ it is 50% off: 3.5") == "wow! at 10$ it is 50% off: 3.5"


def test_exceptions_are_learned(spark):
    rows = [(i, f"{prose(i, 30)} {'vilewort you vilewort' if i % 5 == 0 else 'a vilewort garden' if i % 5 < 3 else ''} {prose(900 + i, 20)}") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, label int")
    lexicon = toxicity.fit(documents(spark, rows), labels, odds=0.5, strength=5.0)
    assert "vilewort garden" in lexicon.exceptions and "you vilewort" not in lexicon.exceptions
    got = {r.doc_id: r.predicted for r in toxicity.score(documents(spark, rows), lexicon).collect()}
    assert got == {i: int(i % 5 == 0) for i, _ in rows}


def code_length(counts: dict, text: bytes) -> float:
    """PPM without any tables: counts by context and byte."""
    bits, padded = 0.0, b"\n\n\n" + text
    for i in range(len(text)):
        before, c = padded[i : i + 3], padded[i + 3]
        for k in (3, 2, 1, 0):
            seen = counts.get(before[3 - k :], Counter())
            total, kinds = sum(seen.values()), len(seen)
            if seen[c]:
                bits -= math.log2(seen[c] / (total + kinds))
                break
            if total:
                bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_language(spark):
    texts = {"aa": [prose(i, 40) for i in range(12)], "bb": [prose(i, 40)[::-1].upper() for i in range(12)], "cc": ["éà üö " * 9 + prose(i, 3) for i in range(6)]}
    rows = [(t, x) for x, ts in texts.items() for t in ts] + [(None, "aa"), ("", "bb"), ("ignored", None)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    counts = {}
    for x, ts in texts.items():
        at = counts[x] = {}
        for t in ts:
            padded = b"\n\n\n" + t.encode()
            for i in range(len(t.encode())):
                for k in range(4):
                    at.setdefault(padded[i + 3 - k : i + 3], Counter())[padded[i + 3]] += 1
    probe = [prose(77, 20), "zzz qqq", "UNSEEN éé", "", "x", prose(5, 3)[::-1].upper()]
    want = [[code_length(counts[x], t.encode()) for x in model.languages] for t in probe]
    assert np.allclose(model.code_lengths([t.encode() for t in probe]), want, rtol=1e-5, atol=1e-3)
    docs = [(1, prose(50, 20)), (2, prose(51, 20)[::-1].upper()), (3, "12345 !?"), *AWKWARD]
    found = language.identify(documents(spark, docs), model).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(docs) and (got[1].lang_pred, got[2].lang_pred) == ("aa", "bb")
    assert [got[i].lang_pred for i in (3, 9001, 9002, 9003)] == ["und"] * 4 and got[3].score == 0
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language.identify(documents(spark, docs), nothing).collect()} == {"und"}


def test_blocks_of_long_texts(monkeypatch):
    keys, counts = np.unique(language.grams([b"abcabcabd" * 3])[0], return_counts=True)
    model = language.Model(["x"], keys, counts[:, None].astype(float))
    texts = [b"abd" * 50, b"", b"q", b"abc" * 400]
    want = model.code_lengths(texts)
    monkeypatch.setattr(language, "BLOCK", 16)
    assert np.allclose(model.code_lengths(texts), want)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=20), st.lists(st.integers(0, 5), max_size=20))
def test_lcs(a, b):
    assert decontaminate.lcs(np.array(a), np.array(b)) == plain_lcs(a, b)


def test_decontamination(spark):
    def item(seed, n):
        rnd = random.Random(seed)
        syllables = ["ka", "lo", "mi", "ne", "ru", "so", "ti", "va", "po", "du"]
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n)]
        return " ".join(words[: n - 6]) + ". " + " ".join(words[n - 6 :]) + "."

    items = [(i, item(i, n)) for i, n in enumerate([12, 20, 31, 40, 55, 90] * 3)] + [(90, "too short"), (91, None), (3, item(3, 40))]
    rnd = random.Random(9)
    rows, want = [], set()
    for i in range(150):
        text = [item(1000 + i * 7 + k, rnd.randint(20, 80)) for k in range(3)]
        if i % 4 == 0:
            k = rnd.randrange(18)
            words = items[k][1].split()
            if i % 8 == 0 and len(words) >= 31:
                words[rnd.randrange(len(words) // 2)] = "paraphrased"
            text.insert(rnd.randrange(4), " ".join(words).upper() if i % 12 == 0 else " ".join(words))
            want.add((i, k))
        rows.append((i, " ".join(text)))
    rows += [(0, rows[0][1]), *AWKWARD]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = decontaminate.contaminated(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert decontaminate.contaminated(documents(spark, []), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, rows[:9]), bench.limit(0)).count() == 0


def swapped(words, share, rnd, spared):
    """The words with a share of those before the last `spared` changed to words that no item has."""
    words = list(words)
    for k in rnd.sample(range(len(words) - spared), math.ceil(share * len(words) - 1e-9)):
        words[k] = f"zq{rnd.randrange(10**9)}"
    return words


@pytest.mark.parametrize("share", [0.2, 0.28, 0.35])
def test_paraphrased_items(spark, share):
    rnd = random.Random(int(share * 100))
    items = [(i, f"{prose(500 + i, n - 4)} x{i}a. Its end{i} is x{i}b.") for i, n in enumerate([9, 12, 15, 20, 31, 47, 64, 120] * 2)]
    rows = []
    for i, t in items:
        w = swapped(re.findall(r"\w+", t), share, rnd, 4)
        for k, gaps in enumerate((0, 1)):
            some = list(w)
            if gaps:
                some.insert(len(some) // 3, "added")
            rows.append((2 * i + k, f"{prose(900 + i, 37 + i)} {' '.join(some)} {prose(950 + i, 40)}"))
    rows += [(1000 + i, prose(3000 + i, 150)) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, rows), bench).collect()}
    assert {(d, i) for d, i in got if d < 1000 and d // 2 == i} == {(d, d // 2) for d in range(32)}


def test_short_items_and_unspaced_scripts(spark):
    items = [(1, "Who wrote the blue ladder?"), (2, "Name six rivers"), (3, "zyzzyva"), (4, "\u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u5417"), (5, "\u6771\u4eac\u306f\u3069\u3053\u3067\u3059\u304b\u3002\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u3002"), (6, "\u5927\u962a"), (7, "...")]
    inside = "\u6211\u4eec\u8bf4"
    rows = [(k, f"{prose(k, 12)}{inside if k >= 4 else ' '}{t}{inside if k >= 4 else ' '}{prose(50 + k, 9)}") for k, t in items[:6]]
    rows += [(10, prose(4, 9) + " who wrote the green blue ladder"), (11, "rivers six name"), (12, items[0][1]), (13, prose(5, 200)), (14, "the blue ladder who wrote")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, k) for k in range(1, 7)} | {(12, 1)}


def word_lists(rnd, n, start):
    """Rare words of syllables, none of which another list has."""
    syllables = ["ka", "lo", "mi", "ne", "ru", "so", "ti", "va", "po", "du"]
    return ["".join(rnd.choice(syllables) for _ in range(2)) + f"{start + i}" for i in range(n)]


CHANGES = {
    "every 6th word replaced": lambda w, new: [new() if i % 6 == 5 else x for i, x in enumerate(w)],
    "every 5th word replaced": lambda w, new: [new() if i % 5 == 4 else x for i, x in enumerate(w)],
    "every 4th word replaced": lambda w, new: [new() if i % 4 == 3 else x for i, x in enumerate(w)],
    "every 3rd word replaced": lambda w, new: [new() if i % 3 == 2 else x for i, x in enumerate(w)],
    "a word after every 5th": lambda w, new: [y for i, x in enumerate(w) for y in ([x, new()] if i % 5 == 4 else [x])],
    "a word after every 3rd": lambda w, new: [y for i, x in enumerate(w) for y in ([x, new()] if i % 3 == 2 else [x])],
    "every 6th word left out": lambda w, new: [x for i, x in enumerate(w) if i % 6 != 5],
}


def test_recall_against_all_pairs(spark):
    """Every document against every item at every place by a plain LCS: what the rule accepts is found, and no more."""
    rnd = random.Random(77)
    common = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "un", "el")]
    pool = word_lists(rnd, 1500, 0)
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(pool) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([15, 18, 22, 26, 30, 34, 40, 46, 52, 60] * 2)]
    rows, planted = [], {}
    for i, w in items:
        for name, change in CHANGES.items():
            planted[len(rows)] = (i, name)
            rows.append(text(rnd.randrange(20, 90)) + change(w, lambda: rnd.choice(pool)) + text(rnd.randrange(5, 60)))
    rows += [text(rnd.randrange(20, 200)) for _ in range(60)]
    bench = spark.createDataFrame([(i, " ".join(w[:-6]) + ". " + " ".join(w[-6:]) + ".") for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark, [(d, " ".join(w)) for d, w in enumerate(rows)]), bench).collect()}
    want = set()
    for i, w in items:
        item = decontaminate.Item(i, bench.where(f"item_id = {i}").first().text, 0.6)
        for d, x in enumerate(rows):
            if sum(min(x.count(y), w.count(y)) for y in set(w)) < item.need:
                continue
            words = decontaminate.words_of(" ".join(x))
            for at in range(len(x)):
                region = words[max(0, at - item.slack) : at + len(w) + item.slack]
                share = plain_lcs(w, x[max(0, at - item.slack) : at + len(w) + item.slack]) / len(w)
                if share >= 0.8 or share >= 0.6 and len(item.answer & set(region.tolist())) >= len(item.answer) / 2:
                    want.add((d, i))
                    break
    assert got <= want
    found = Counter(planted[d][1] for d, i in got if planted.get(d, (None,))[0] == i)
    held = Counter(planted[d][1] for d, i in want if planted.get(d, (None,))[0] == i)
    assert {n: found[n] / held[n] for n in held if found[n] < 0.9 * held[n]} == {}
    assert len(got & want) >= 0.95 * len(want)


def test_long_documents_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 256)
    rnd = random.Random(4)
    pool = word_lists(rnd, 3000, 0)
    items = [(i, [rnd.choice(pool) for _ in range(n)]) for i, n in enumerate([8, 20, 33, 300, 1200])]
    doc = [rnd.choice(pool) for _ in range(1000)]
    for _, w in items:
        doc += w + [rnd.choice(pool) for _ in range(700)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = decontaminate.contaminated(documents(spark, [(1, " ".join(doc)), (2, prose(3, 5000))]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, i) for i, _ in items} and all(r.lcs == 1 for r in got)


PAGES = [
    ("<p>One<p>Two <b>bold<br>next</b>", "One\n\nTwo bold\nnext"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apple<td>3</table>", "Name   Qty\nApple  3"),
    ("a<div style='display: none'>no</div><div hidden>no</div><p aria-hidden=true>no</p>b", "ab"),
    ("<title>t</title><script>var t='</p>';</script><style>p{}</style>text", "text"),
    ("<pre> a\n   b</pre>", " a\n   b"),
    ("x &amp; y &lt;z&gt; &copy &#65;", "x & y <z> © A"),
    ("</i></p>tail<!-- gone --> <a href='x>y'>link</a>", "tail link"),
    ("<blockquote>q</blockquote>", "> q"),
    ("<dl><dt>T<dd>D</dl>", "T\n    D"),
    ("1 < 2 and a<b", "1 < 2 and a"),
    ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"),
    ("", ""),
    ("<p", ""),
    ("<div>" * 3000 + "deep", "deep"),
    ("<html><head><title>T</title><p>text", "text"),
    ("<head>\n<meta charset=utf-8>\n<style>p{}</style>plain words", "plain words"),
    ("<head><title>T</title></head><body>a<math><mi>x</mi></math> <svg><title>t</title><text>label</text></svg>", "ax label"),
    ("a<dialog>no</dialog><dialog open>yes</dialog>", "a\nyes"),
    ("a<xmp><b> &amp;</xmp>b", "a\n\n<b> &amp;\n\nb"),
    ("<table><tr><td>A<td><img alt='pic'></table>", "A  pic"),
    ("<pre>x <img alt=pic> y</pre>", "x pic y"),
    ("<head><br>seen", "seen"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>a<td>" + "x" * 70 + "<td>b<tr><td>aaa<td>y<td>c</table>", "a    " + "x" * 70 + "  b\naaa  y" + " " * 61 + "c"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>one<td>two<td>3</table>", "wide      z\none  two  3"),
    ("<table><tr><td><p>one</p><td><div>two</div></table>", "one  two"),
    ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a\n\nb  c\n\nd"),
    ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
    ("<style>.x, #y { display: none } p.z{visibility:hidden} @media print { .w { display: none } }</style><p class='a x'>no<p id=y>no<p class=z>no<div class=z>yes</div><i class=w>also</i>", "yes\nalso"),
    ("<style>.x{display:none} div.x{display:block}</style><div class=x>yes</div><p class=x>no<p class=x style='display:inline'>too", "yes\n\ntoo"),
    ("<form><input value=name><input type=hidden value=no><input type=submit value=Send><input placeholder=hint></form>", "name Send hint"),
    ("<object data=x>instead</object>", "instead"),
    ("<ol><li>a<li value=7>b<li hidden>no<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<div><table><tr><td>a</div>b<td>c</table>", "ab  c"),
    ("<pre>a<div>b</div>c</pre>", "a\nb\nc"),
    ("<style>.a .b{display:none} .a #c p{visibility:hidden} div i{display:none}</style><p class=b>yes</p><div class=a><p>x<span class=b>no</span><section id=c><p>no</p>y</section><i>no</i></div><i>z</i>", "yes\n\nx\n\ny\nz"),
    ("<style>.a .b{display:none} .a .b.c{display:block}</style><div class=a><div class=b>no</div><div class='b c'>yes</div></div>", "yes"),
    ("<style>@media screen{.c{display:none}} @media all, print {.d{display:none}} @media screen and (max-width:9px){.e{display:none}} @media print{.e{display:none}}</style><i class=c>no</i><i class=d>no</i><i class=e>yes</i>", "yes"),
    ("<details>no<summary>S</summary><p>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<table>loose<tr><td>a<td>b<tr><td>ccc<td>d</table>", "loose\na    b\nccc  d"),
    ("<table><tr><td>key<td><p>one<p>two<tr><td>k<td>three<tr><td><p>x<p>y<td></table>", "key  one\n\n     two\nk    three\nx\n\ny"),
    ("<table><tr><td><p>a<p>b<td>c</table>", "a\n\nb\n\nc"),
    ("<table><tr><td>a<td><table><tr><td>b<td>c<tr><td>ddd<td>e</table><tr><td>ff<td>g</table>", "a   b    c\n    ddd  e\nff  g"),
]


@pytest.mark.parametrize(("markup", "text"), PAGES, ids=range(len(PAGES)))
def test_render(markup, text):
    assert html.render(markup) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<li>", "</ul>", "<div", ">", "w1 ", "w2 ", "<!--", "-->", "<pre>", "</pre>", "&amp;", "<script>", "</script>"]), max_size=25))
def test_render_never_fails(parts):
    html.render("".join(parts))


def test_visible_words_are_all_there():
    words = [f"word{i}" for i in range(60)]
    tags = ["<p>", "<div>", "<li>", "<td>", "<b>", "</b>", "</div>", "<tr>", "<table>", "</table>", "<ul>", "</ul>"]
    rnd = random.Random(8)
    for _ in range(50):
        page = "".join(f"{rnd.choice(tags)}{w} " for w in words)
        assert html.render(page).split() and [w for w in re.findall(r"word[0-9]+", html.render(page))] == words


def test_all_that_is_visible_is_shown_in_order():
    """Random trees, whose visible words are known from how they are made."""
    rnd = random.Random(31)

    def tree(depth: int, seen: bool, out: list) -> str:
        parts = []
        for _ in range(rnd.randint(1, 4)):
            kind = rnd.random()
            if kind < 0.4 or depth > 6:
                out.append((f"w{len(out)}x", seen))
                parts.append(f" w{len(out) - 1}x ")
            elif kind < 0.5:
                inner = tree(depth + 1, False, out)
                parts.append(rnd.choice(["<div hidden>{}</div>", "<span style='display:none'>{}</span>", "<div class='q gone'>{}</div>", "<span aria-hidden=true>{}</span>"]).format(inner.replace("visibility:visible", "")))
            elif kind < 0.55 and seen:
                parts.append(f"<div style='visibility:hidden'>{tree(9, False, out)}<b style='visibility:visible'>{tree(depth + 1, True, out)}</b></div>")
            else:
                around = rnd.choice(["<div>{}</div>", "<b>{}</b>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<dl><dd>{}</dd></dl>", "<label>{}</label>", "<svg>{}</svg>", "<object>{}</object>", "<table><tr><td>{}</td><td></td></tr></table>"])
                parts.append(around.format(tree(depth + 1, seen, out)))
        return "".join(parts)

    for _ in range(150):
        words: list = []
        page = "<style>.gone { display: none }</style>" + tree(0, True, words)
        assert re.findall(r"w[0-9]+x", html.render(page)) == [w for w, seen in words if seen]


@pytest.mark.parametrize("page", [
    "<ol>" + "<li>x" * 100_000 + "</ol>", "<p><button>" + "<div>" * 50_000 + "x", "<ul><li>" * 20_000 + "x", "<table><tr><td>" * 20_000 + "x", "<table>" + "<tr><td rowspan=3>a<td colspan=900>b" * 20_000,
    "<div class=x>" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<style>" + "@{" * 50_000 + "</style>x", "<blockquote>" * 20_000 + "x", "<select>" + "<option>y" * 50_000, "<" * 100_000, "<a b='" * 20_000,
])
def test_long_pages_take_linear_time(page):
    began = time.process_time()
    html.render(page)
    assert time.process_time() - began < 8


def test_extract(spark):
    rows = [(1, "<p>a</p>", "u"), (1, "<p>a</p>", "u"), (2, None, None), (3, "", ""), (None, "<b>x</b>", "u")]
    got = html.extract(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, url string, text string"))
    assert Counter((r.page_id, r.text) for r in got.collect()) == Counter([(1, "a"), (1, "a"), (2, ""), (3, ""), (None, "x")])
    assert got.limit(0).count() == 0


def test_heads_of_words():
    assert toxicity.beginnings("abcdef", 4) == ["abcd", "abcde", "abcdef", "abcdef|"]
