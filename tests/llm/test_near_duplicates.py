"""Lines, vectors and SimHash against brute force, with small limits so that hot groups are split."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, documents, groups, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.llm import embeddings, lines, simhash
from logloom.llm.components import components


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", max_size=12), st.integers(0, 4))
def test_banded_distance(a, b, k):
    assert lines.within(a, b, k) == (distance(a, b) <= k)


def test_probes_meet_every_near_pair():
    """Of any two strings within k edits, a probe of the longer meets a segment of the shorter."""
    rnd = random.Random(4)
    for k in (1, 2, 3):
        for _ in range(400):
            a = "".join(rnd.choice("abcd") for _ in range(rnd.randint(12, 25)))
            b = list(a)
            for _ in range(rnd.randint(0, k)):
                at = rnd.randrange(len(b))
                b[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x"])
            b = "".join(b)
            if distance(a, b) > k:
                continue
            long, short = (a, b) if len(a) >= len(b) else (b, a)
            size, longer = divmod(len(short), k + 1)
            starts = [size * i + max(0, i - (k + 1 - longer)) for i in range(k + 1)] + [len(short)]
            assert any(less == len(long) - len(short) and starts[i] + shift >= 0 and long[starts[i] + shift :][: starts[i + 1] - starts[i]] == short[starts[i] : starts[i + 1]] for less, i, shift in lines.probes(k))


def test_finer_signatures_meet_every_near_pair():
    rnd = random.Random(9)
    met = 0
    for k in (1, 2, 3):
        for _ in range(500):
            a = "".join(rnd.choice("abc") for _ in range(rnd.randint(12, 30)))
            b = list(a)
            for _ in range(rnd.randint(0, k)):
                at = rnd.randrange(len(b))
                b[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x"])
            b = "".join(b)
            if distance(a, b) > k:
                continue
            long, short = (a, b) if len(a) >= len(b) else (b, a)

            def shares(less, i, shift):
                start, size = lines._parts(len(short), k + 1)[i]
                if start + shift < 0 or long[start + shift : start + shift + size] != short[start : start + size]:
                    return False
                looked_up = {w for of, w in lines.finer(short, 0, i, 0, k) if of}
                return bool(looked_up & {w for _, w in lines.finer(long, less, i, shift, k)})

            assert any(shares(*x) for x in lines.probes(k) if x[0] == len(long) - len(short))
            met += 1
    assert met > 1000


@pytest.mark.parametrize("pairs_up_to", [48, 2])
def test_lines_against_brute_force(spark, monkeypatch, pairs_up_to):
    monkeypatch.setattr(lines, "PAIRS_UP_TO", pairs_up_to)
    monkeypatch.setattr(lines, "TILE", 4)
    rnd = random.Random(1)
    base = [prose(i, 9) for i in range(8)]

    def edited(t, n):
        t = list(t)
        for _ in range(n):
            t[rnd.randrange(len(t))] = rnd.choice("qz")
        return "".join(t)

    rows = [(i, "\n".join(edited(rnd.choice(base), rnd.choice([0, 1, 2, 3])) if rnd.random() < 0.7 else prose(100 + i * 10 + k, 10) for k in range(4)) + "\nshort\nshort") for i in range(40)]
    rows += [rows[3], *AWKWARD]
    got = {(r.doc_id, r.text): r for r in lines.dedup(documents(spark, rows), edits=2, least_chars=40).collect()}
    kept_lines = [(i, k, x.strip(" ").lower()) for i, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0])) for k, x in enumerate(t.split("\n")) if len(x.strip(" ")) >= 40]
    texts = sorted({x for _, _, x in kept_lines})
    classes = groups(range(len(texts)), lambda a, b: abs(len(texts[a]) - len(texts[b])) <= 2 and len(texts[a]) < 1000 and distance(texts[a], texts[b]) <= 2)
    of, seen, gone = {t: classes[i] for i, t in enumerate(texts)}, set(), {}
    for i, k, x in kept_lines:
        if of[x] in seen:
            gone.setdefault(i, []).append(k)
        seen.add(of[x])
    assert gone
    want = {}
    for i, t in rows:
        cut = set(gone.get(i, []))
        want[i, t if t is None or not cut else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)] = sorted(cut)
    assert {k: r.gone or [] for k, r in got.items()} == want
    assert sum(1 for _ in got) == len(set(want)) and got[9001, None].n_lines == 0 and got[9002, ""].n_lines == 1
    assert all(r.n_removed == len(r.gone or []) and r.h == "x" for r in got.values())


def test_short_lines(spark):
    rows = [
        (1, "All rights reserved.\n}\n\n\t\r\nonly here\nshare this page"), (2, " all rights reserved. \n}\n\n\t\r\nfirst\nshare that page"), (3, "all rights reserved!\n}\nfirst\nonly hers\nShare this page"),
    ]
    got = {r.doc_id: r.gone or [] for r in lines.dedup(documents(spark, rows), edits=2, least_chars=1).collect()}
    assert got == {1: [], 2: [0, 1, 5], 3: [0, 1, 2, 4]}  # a short line goes only if it is the same; blank ones stay


def test_lines_of_no_documents(spark):
    assert lines.dedup(documents(spark, []), edits=2).count() == 0


@pytest.mark.parametrize("pairs_up_to", [64, 2])
def test_simhash_against_brute_force(spark, monkeypatch, pairs_up_to):
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", pairs_up_to)
    monkeypatch.setattr(simhash, "TILE", 3)
    rnd = random.Random(2)
    rows = []
    for i in range(60):
        words = prose(i % 9, 120).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((i + 5, " ".join(words)))
    rows += [(500, rows[0][1]), (500, rows[0][1]), *AWKWARD]
    got = simhash.classes(documents(spark, rows), words=3, radius=3).collect()
    assert len(got) == len(rows)
    prints = {i: simhash.fingerprint(t) for i, t in rows if i is not None}
    want = groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert prints[9001] == prints[9002] == prints[9003] == 0 and want[9003] == 9001
    assert len(set(want.values())) < len(want)
    assert simhash.classes(documents(spark, [])).count() == 0


def test_fingerprints_are_of_xxh64_shingles(spark):
    text = "The Quick\tbrown fox\njumps THE quick brown"
    words = text.lower().split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [r.h & 0xFFFFFFFFFFFFFFFF for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Äb") != simhash.fingerprint("äb")  # only A-Z are lower-cased


def test_links_in_tiles_count_all_bits(spark, monkeypatch):
    """Fingerprints that differ in their highest bit among others, in buckets of every size."""
    rnd = random.Random(13)
    base = [rnd.getrandbits(64) for _ in range(5)]
    prints = list(dict.fromkeys(b ^ sum(1 << k for k in {63, *rnd.sample(range(63), rnd.randint(0, 3))} if k < 63 or rnd.random() < 0.7) for b in base for _ in range(30)))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    want = groups(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for pairs_up_to in (0, 2, 64):
        links, _ = simhash.near_links(spark.createDataFrame(rows, "rep long, fp long"), ["fp"], 3, ["fp"], 3, pairs_up_to)
        found = {r.node: r.component for r in components(links).df.collect()}
        assert {i: found.get(i, i) for i in range(len(prints))} == want


def test_entries_of_a_small_file_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    """A task makes so many entries at most, give or take, however few files the prints lie in, and links stay the same."""
    monkeypatch.setattr(simhash, "ENTRIES", 2000, raising=False)
    rnd = random.Random(17)
    prints = [rnd.getrandbits(64) for _ in range(1000)]
    prints += [p ^ 1 << rnd.randrange(64) for p in prints[:50]]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    spark.createDataFrame(rows, "rep long, fp long").coalesce(1).write.parquet(str(tmp_path / "prints"))
    spark.sparkContext.setJobGroup("entries", "entries")
    try:
        links, sizes = simhash.near_links(spark.read.parquet(str(tmp_path / "prints")), ["fp"], 3, ["fp"], 3, 64)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = spark.sparkContext.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("entries") for s in told.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) >= len(rows) * 15 // 2000
    assert {(r.u, r.v) for r in links.collect()} >= {(i, 1000 + i) for i in range(50)}


def test_masks_cover_every_pair_in_the_radius():
    rnd = random.Random(3)
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            diff = sum(1 << b for b in rnd.sample(range(64), radius))
            assert any(not m & diff for m in masks)


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(200, i) for i in range(201, 260)] + [(7, None), (8, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).df.collect()}
    real = {frozenset(p) for p in pairs if None not in p and p[0] != p[1]}
    want = groups(sorted({x for p in real for x in p}), lambda a, b: frozenset((a, b)) in real)
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).df.count() == 0


@pytest.mark.parametrize("hot", [200_000, 1])
def test_vectors_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(embeddings, "HOT", hot)
    monkeypatch.setattr(embeddings, "TILE", 5)
    rnd = np.random.default_rng(6)
    rows = []
    centres = rnd.standard_normal((6, 20))
    for i in range(120):
        v = centres[i % 6] + rnd.standard_normal(20) * (0.03 if i % 2 else 0.17)
        rows.append((i + 10, [float(x) for x in v.astype(np.float32)], int(i % 12 // 4)))
    rows += [(900, rows[0][1], rows[0][2]), (901, [2 * x for x in rows[0][1]], rows[0][2]), (902, rows[0][1], None), (903, None, 1), (904, [], 1), (905, [0.0] * 20, 1)]
    rows += [(906, [float("nan")] + [1.0] * 19, 1), (907, [None] + [1.0] * 19, 1), (908, [1.0, 2.0, 3.0], 1), (909, [1.0, 2.0, 3.01], 1), (None, rows[0][1], rows[0][2]), (910, [float("inf")] * 20, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, cell int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, cosine=0.98).collect()}
    assert len(got) == len(rows)

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = {i: (np.array(v, float) / np.linalg.norm(np.array(v, float)), y) for i, v, y in rows if i is not None and y is not None and usable(v)}
    near = lambda a, b: unit[a][1] == unit[b][1] and len(unit[a][0]) == len(unit[b][0]) and unit[a][0] @ unit[b][0] >= 0.98
    want = groups(sorted(unit), near)
    for i in got:
        assert got[i].n_links == (sum(near(i, j) for j in unit if j != i) if i in unit else 0), i
        assert got[i].component_id == want.get(i, i)
    assert sum(r.n_links for r in got.values()) > 100 and got[908].n_links == 1
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_vectors_with_repeated_ids_and_extreme_lengths(spark):
    rows = [(1, [1.0, 0.0, 0.0], 7), (1, [0.0, 1.0, 0.0], 7), (2, [1.0, 0.01, 0.0], 7), (3, [1e200, 1e198, 0.0], 8), (4, [1e-200, 1e-202, 0.0], 8), (5, [0.0, 1e300, 0.0], 8), (6, [-1e-300, 0.0, 0.0], 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(df, cosine=0.98).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3), (5, 0, 5), (6, 0, 6)]


def test_lines_of_rows_that_share_an_id_or_have_none(spark):
    same = "this line is in several rows of the corpus"
    rows = [(0, same), (5, same), (5, "a different line that no other row has at all"), (None, same), (None, "one more line that is found nowhere else, so it stays"), (None, None)]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in lines.dedup(documents(spark, rows), edits=2).collect()), key=str)
    assert got == sorted([(0, same, 0), (5, "", 1), (5, rows[2][1], 0), (None, "", 1), (None, rows[4][1], 0), (None, None, 0)], key=str)
    wide = documents(spark, rows).withColumnsRenamed({"h": "gone", "rep": "n_lines"})
    assert sum(r.n_lines for r in lines.dedup(wide, edits=2).collect()) == 5


def test_lines_with_a_hot_segment(spark, monkeypatch):
    """Many lines share their beginning and end: near ones are still found, and only those."""
    monkeypatch.setattr(lines, "PAIRS_UP_TO", 3)
    rnd = random.Random(6)
    some = ["the same beginning of a line " + "".join(rnd.choice("abcd") for _ in range(rnd.choice([14, 15]))) + " and the end of all lines" for _ in range(60)]
    some += [x[: (at := rnd.randrange(20, 50))] + rnd.choice(["", "z"]) + x[at + rnd.randint(0, 1) :] for x in some[:40]]
    rows = list(enumerate(dict.fromkeys(some)))
    got = {r.doc_id: r.n_removed for r in lines.dedup(documents(spark, rows), edits=2).collect()}
    want = groups(range(len(rows)), lambda a, b: distance(rows[a][1], rows[b][1]) <= 2)
    assert got == {i: int(want[i] != i) for i, _ in rows} and sum(got.values()) > 20


@pytest.mark.parametrize("pairs_up_to", [64, 2])
def test_near_copies_by_shared_shingles(spark, monkeypatch, pairs_up_to):
    """Changed copies go from a similarity of five-word shingles of 0.8 on, and none that has no partner of that."""
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", pairs_up_to)
    monkeypatch.setattr(simhash, "TILE", 3)
    rnd = random.Random(21)
    pool = [f"w{i}" for i in range(4000)]
    base = {i: [rnd.choice(pool) for _ in range(rnd.randint(120, 400))] for i in range(40)}

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    rows, similar = [(i, " ".join(w)) for i, w in base.items()], {}
    for i, w in base.items():
        for k, share in enumerate((0.005, 0.01, 0.015, 0.02, 0.06, 0.1)):
            new = list(w)
            for at in rnd.sample(range(len(w)), max(1, round(share * len(w)))):
                new[at] = rnd.choice(pool)
            a, b = shingles(w), shingles(new)
            similar[1000 + 10 * i + k] = len(a & b) / len(a | b)
            rows.append((1000 + 10 * i + k, " ".join(new)))
    kept = {r.doc_id for r in simhash.first_of_each(documents(spark, rows)).collect()}
    assert set(base) <= kept
    near = [d for d, x in similar.items() if x >= 0.8]
    assert len(near) > 80 and sum(d not in kept for d in near) >= 0.95 * len(near)
    sets = {d: shingles(t.split()) for d, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    assert all(any(alike(d, e) for e in sets if e != d) for d in set(sets) - kept)


def test_nearest_links_join_at_every_bound():
    rng = np.random.default_rng(3)
    for n, m in ((2, 1), (40, 300), (300, 9000)):
        u, v, d = rng.integers(0, n, m), rng.integers(n, 2 * n, m), rng.integers(0, 12, m)
        kept = simhash.nearest(u, v, d)
        assert len(kept[0]) < 2 * n
        for bound in range(12):
            parts = []
            for a, b, c in ((u, v, d), kept):
                x, y = simhash.spanning(a[c <= bound], b[c <= bound]) if (c <= bound).any() else ([], [])
                parts.append(groups(range(2 * n), lambda i, j, e=set(zip(map(int, map(lambda z: z.as_py(), x)), map(lambda z: z.as_py(), y))): (i, j) in e or (j, i) in e) if n < 50 else len(x))
            assert parts[0] == parts[1]


def test_copies_whose_sketch_is_between_go_by_their_shingles(spark, monkeypatch):
    """The sketch takes texts for candidates, their shingles decide: wherever the bound is, as brute force does."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 25):
        new = list(base)
        for at in range(0, 150, 150 // (i // 3 + 1)):
            new[at] = rnd.choice(words)
        rows.append((i, " ".join(new)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(146)} for i, t in rows}
    for similarity in (0.8, 0.9):
        root = groups(sets, lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity)  # noqa: B023
        kept = {r.doc_id for r in simhash.first_of_each(documents(spark, rows), similarity=similarity, margin=0.2, radius=6).collect()}
        assert kept >= set(root.values()) and len(kept) <= len(set(root.values())) + 1


def test_one_row_of_each_component_stays(spark):
    long = prose(3, 80)
    rows = [(7, long), (7, prose(8, 80)), (9, long), (None, long), (None, prose(12, 60)), (None, prose(12, 60)), (4, prose(20, 50)), (4, prose(20, 50)), (11, None), (12, "")]
    got = sorted(((r.doc_id, r.text) for r in simhash.first_of_each(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(7, long), (7, rows[1][1]), (None, rows[4][1]), (4, rows[6][1]), (11, None)], key=str)


def test_signatures_that_nothing_shares_are_not_moved(spark, monkeypatch):
    """Of many entries those of few signatures are joined: a bitmap rules out nearly all others where they are."""
    entries = spark.range(20_000).select(F.xxhash64("id").alias("sig"), F.col("id").alias("h"), F.lit(True).alias("indexed"))
    met = spark.range(5).select(F.xxhash64("id").alias("sig"), F.lit(2).alias("size"))
    passed, flagged = [], lines.with_flag

    def with_flag(df, key, keys, name, bits):
        out = flagged(df, key, keys, name, bits)
        passed.append(out.where(name).count())
        return out

    monkeypatch.setattr(lines, "with_flag", with_flag)
    assert sorted(r.h for r in lines._of(entries, met).collect()) == [0, 1, 2, 3, 4]
    assert len(passed) == 1 and 5 <= passed[0] < 50


def test_only_texts_that_hold_a_sought_line_are_moved(spark, monkeypatch):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a line of its own, number "), F.col("id").cast("string")).alias("text"))
    wanted = lines.split_lines(docs, 1).where("line like '% 7' or line like '% 1999'").select("h", F.col("place").alias("first"))
    passed, flagged = [], lines.with_flag

    def with_flag(df, key, keys, name, bits):
        out = flagged(df, key, keys, name, bits)
        passed.append(out.where(name).count())
        return out

    monkeypatch.setattr(lines, "with_flag", with_flag)
    assert sorted(r.line for r in lines._texts(docs, wanted, 1).df.collect()) == ["a line of its own, number 1999", "a line of its own, number 7"]
    assert len(passed) == 1 and 2 <= passed[0] < 20


def test_the_first_pass_over_lines_is_compiled(spark, monkeypatch):
    """The JVM interprets methods beyond 8000 bytes, many times slower."""
    written = []

    class Told(lines.Cut):
        def __init__(self, df, batch=None):
            written.append(df)
            super().__init__(df, batch)

    monkeypatch.setattr(lines, "Cut", Told)
    lines.line_classes(documents(spark, [(1, "one line of some length\nanother"), (2, None)]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = written[0].select("*")
        plan = spark._sc._jvm.PythonSQLUtils.explainString(again._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x.split(";")[0]) for x in plan.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000
