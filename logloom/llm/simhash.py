"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints within `radius` bits are found without misses: a covering family of 2^(radius+1) - 1 bit
masks is built by giving each bit position a vector of radius+1 bits; mask t keeps the positions whose
vector has an odd product with t. Two fingerprints that differ in at most `radius` positions agree on
all kept positions of at least one mask, because fewer than radius+1 vectors always leave a non-zero t
that is orthogonal to all of them.

Near copies by the words that they share need more than one fingerprint, as one of them says little about
similarity: documents are sought by several, each under a covering family, and checked by a longer sketch.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, by_run, runs, self_tiles, text_hash
from .components import components
from .ngrams import bitmap_of

SEED = 42
BITS = 64
PAIRS_UP_TO = 64  # buckets of at most so many fingerprints are joined as pairs, larger ones in tiles
TILE = 2048
ENTRIES = 1 << 20  # of buckets that a task makes: nearly all differ, so it holds all of them while it counts them
TEXTS = 1000  # that are handed to Python at once
WANTED_BITS = 27  # of the bitmap that says which texts' shingles are needed: 16 MB


def majority(h: np.ndarray) -> np.ndarray:
    """For each column of hashes: bit i is set if it is set in over half of the rows."""
    ones = np.zeros(BITS * h.shape[1], np.int64)
    for i in range(0, len(h), 8192):
        part = np.ascontiguousarray(h[i : i + 8192]).view(np.uint8).reshape(-1, 8 * h.shape[1])
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)


def shingle_hashes(w: list[bytes], words: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; of all words if there are fewer."""
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned: bit i is set if it is set in over half of the XXH64 hashes of the word shingles."""
    w = words_of(text)
    return int(majority(shingle_hashes(w, words)[:, None])[0]) if w else 0


def derived(h: np.ndarray, n: int) -> np.ndarray:
    """n further hashes of each hash, by multiplying and folding."""
    x = h[:, None] ^ (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Fingerprints of word pairs that near copies are sought by, and words of the sketch that they are checked by.
SOUGHT, CHECKED = [f"f{k}" for k in range(4)], [f"s{k}" for k in range(8)]


def sketches(text: str | None, words: int = 5) -> np.ndarray:
    """SOUGHT, each a SimHash of word pairs under hashes of its own, and CHECKED, a SimHash of 512 bits of the set
    of word shingles: of two texts as many bits differ as the angle between their sets is of a half turn."""
    w = words_of(text)
    if not w:
        return np.zeros(len(SOUGHT) + len(CHECKED), np.uint64)
    pairs, shingles = shingle_hashes(w, 2), np.unique(shingle_hashes(w, words))
    return np.concatenate([majority(derived(pairs, len(SOUGHT))), majority(derived(shingles, len(CHECKED)))])


def differing(similarity: float) -> int:
    """How many bits of the sketch differ at most, as expected, between sets of this Jaccard similarity."""
    return round(BITS * len(CHECKED) * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def covering_masks(radius: int, seed: int = 11) -> list[int]:
    """2^(radius+1) - 1 masks over 64 bits, signed as Spark's long has them."""
    rnd = random.Random(seed)
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]  # none is zero, all as frequent
    rnd.shuffle(vectors)
    masks = [sum((bin(v & t).count("1") & 1) << i for i, v in enumerate(vectors)) for t in range(1, 2 ** (radius + 1))]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _hashed(docs: DataFrame, columns: list[str], of) -> DataFrame:
    """doc_id, text_hash and `of` a text's numbers in these columns: one row per row of docs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([of(t.as_py()) for t in b.column(2)], np.uint64).reshape(b.num_rows, len(columns)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], ["doc_id", "text_hash", *columns])

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")), F.col("text").cast("string"))
    return rows.mapInArrow(each, "doc_id long, text_hash long" + "".join(f", {c} long" for c in columns))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_hash, fp (long): one row per row of docs. Null and empty texts: fp 0."""
    return _hashed(docs, ["fp"], lambda t: fingerprint(t, words))


def _tile_links(check: list[str], most: int, apart: bool = False):
    """Links in a tile pair that join what the near pairs join; apart: the nearest ones that do."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["t", "m", "tile_i", "tile_j"]):
            rep, own = (rows.column(k).to_numpy() for k in ("rep", "own_tile"))
            bits = [rows.column(k).to_numpy().view(np.uint64) for k in check]  # of signed numbers the magnitude would be counted
            i, j = rows.column("tile_i")[0].as_py(), rows.column("tile_j")[0].as_py()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            links = []
            for k in range(0, len(left), 512):
                x = left[k : k + 512]
                far = sum(np.bitwise_count(c[x][:, None] ^ c[right][None, :]).astype(np.int16) for c in bits)
                hit = far <= most
                if i == j:
                    hit &= rep[x][:, None] < rep[right][None, :]
                r, c = np.nonzero(hit)
                if len(r):
                    links.append(nearest(rep[x[r]], rep[right[c]], far[r, c]) if apart else [z.to_numpy() for z in spanning(rep[x[r]], rep[right[c]])])
            if links:
                joined = [np.concatenate(z) for z in zip(*links)]
                yield pa.RecordBatch.from_arrays([pa.array(z) for z in nearest(*joined)[:2]] if apart else spanning(*joined), ["u", "v"])

    return each


def spanning(u: np.ndarray, v: np.ndarray) -> list[pa.Array]:
    """A spanning forest of the links (u, v): as many rows as nodes at most, the same components."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    out = label != np.arange(len(nodes))
    return [pa.array(nodes[out]), pa.array(nodes[label[out]])]


def nearest(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """A spanning forest of the links (u, v) that takes those of small d first: whatever bound is set to d, the links
    of the forest within it join what all links within it join."""
    order = np.lexsort((v, u, d))
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)][order], ends[len(u) :][order]
    root = np.arange(len(nodes))
    kept: list[int] = []
    for at in range(0, len(order), 4096):
        some = at + np.flatnonzero(root[a[at : at + 4096]] != root[b[at : at + 4096]])
        if not len(some):
            continue
        tree = root.tolist()
        for k in some.tolist():
            x, y = int(a[k]), int(b[k])
            while tree[x] != x:
                tree[x] = x = tree[tree[x]]
            while tree[y] != y:
                tree[y] = y = tree[tree[y]]
            if x != y:
                tree[y] = x
                kept.append(k)
        root = np.array(tree)
        while (root[root] != root).any():
            root = root[root]
    taken = order[kept]
    return [u[taken], v[taken], d[taken].astype(np.int16)]


def near_links(prints: DataFrame, hashes: list[str], radius: int, check: list[str], most: int, pairs_up_to: int, apart: bool = False) -> tuple[DataFrame, Cut]:
    """u, v: links between representatives that give the same components as all pairs that are within `radius`
    in one of the hashes and differ in `most` bits of `check` at most; and a table to be dropped.

    prints: rep (a long, once each), and these columns. Buckets of the covering tables with `pairs_up_to`
    members at most are joined as pairs; larger ones are compared in tiles and leave a spanning forest, so
    rows stay linear in the members however large a bucket is. With many tables a large group lies in many
    small buckets, whose pairs would together be all pairs of the group; then no bucket is to be joined so.
    apart: the links of a bucket are the nearest ones that join its near pairs.
    """
    kept = [F.col(h).bitwiseAND(F.lit(m)) for h in hashes for m in covering_masks(radius)]
    dealt = prints.select("rep", *hashes).repartition(prints.count() * len(kept) // ENTRIES + 1, "rep")  # a small table's file makes many entries
    entries = dealt.select("rep", F.posexplode(F.array(*kept)).alias("t", "m"))
    sizes = Cut(entries.groupBy("t", "m").agg(F.count("*").cast("int").alias("n")).where("n > 1"))
    large = self_tiles(entries, sizes.df.where(F.col("n") > pairs_up_to), ["t", "m"], "rep", TILE).join(prints.select("rep", *check), "rep")
    links = by_run(large, ["t", "m", "tile_i", "tile_j"]).mapInArrow(_tile_links(check, most, apart), "u long, v long")
    if pairs_up_to:
        few = entries.join(sizes.df.where(F.col("n") <= pairs_up_to).drop("n"), ["t", "m"])
        pairs = few.join(few.select("t", "m", F.col("rep").alias("rep2")), ["t", "m"]).where("rep < rep2").select(F.col("rep").alias("u"), F.col("rep2").alias("v")).distinct()
        left, right = (prints.select(F.col("rep").alias(end), *[F.col(c).alias(end + c) for c in check]) for end in "uv")
        far = reduce(add, [F.bit_count(F.col("u" + c).bitwiseXOR(F.col("v" + c))) for c in check])
        links = pairs.join(left, "u").join(right, "v").where(far <= most).select("u", "v").unionByName(links)
    return links.distinct(), sizes


def _numbered(prints: DataFrame, keys: list[str]) -> Cut:
    """Each different print with the hash of one of its texts and a number, rep, that is fixed by being written."""
    return Cut(prints.groupBy(*keys).agg(F.min("text_hash").alias("text_hash")).withColumn("rep", F.monotonically_increasing_id()))


def _named(distinct: Cut, links: DataFrame, keys: list[str]) -> Cut:
    """The different prints, with a number for each component."""
    found = components(links)
    named = Cut(distinct.df.join(found.df.withColumnRenamed("node", "rep"), "rep", "left").select(*keys, F.coalesce("component", "rep").alias("component")))
    found.drop()
    return named


def classes(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links of at most `radius` bits reach.

    One row per row of docs, whatever other columns it has. Null and empty texts share the fingerprint 0
    and are linked like any other. A null doc_id is never a component's name; rows with one belong to the
    component of their fingerprint (null if no document with an id is in it). Repeated rows stay repeated.
    """
    prints = Cut(fingerprints(docs, words))
    distinct = _numbered(prints.df, ["fp"])
    links, sizes = near_links(distinct.df, ["fp"], radius, ["fp"], radius, PAIRS_UP_TO)
    named = _named(distinct, links, ["fp"])
    distinct.drop()
    sizes.drop()
    least = prints.df.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named.df, "fp")
    names = least.groupBy("component").agg(F.min("least").alias("component_id"))
    known = Cut(named.df.join(names, "component").select("fp", "component_id"))
    named.drop()
    return prints.df.join(known.df, "fp").select("doc_id", "fp", "component_id")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """text_hash, shingles: the different shingle hashes of the texts in `wanted` (text_hash), each once. A bitmap of
    a fixed size leaves out most others as the texts are read."""
    may = bitmap_of(wanted.select(F.col("text_hash").alias("h")), WANTED_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(may)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = b.column(0).to_numpy()
            some = np.flatnonzero(shared.value.holds(hashes.view(np.uint64)))
            for at in range(0, len(some), 64):
                part = some[at : at + 64]
                of = [words_of(b.column(1)[i].as_py()) for i in part.tolist()]
                sets = [np.unique(shingle_hashes(w, words)).tobytes() if w else b"" for w in of]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[part]), pa.array(sets, pa.binary())], ["text_hash", "shingles"])

    rows = docs.select(text_hash(F.col("text")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(each, "text_hash long, shingles binary")
    return found.join(wanted, "text_hash", "left_semi").groupBy("text_hash").agg(F.first("shingles").alias("shingles"))


def jaccard(x: bytes, y: bytes) -> float:
    """Of two sorted sets of hashes."""
    a, b = (np.frombuffer(z, np.uint64) for z in (x, y))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verified(docs: DataFrame, links: DataFrame, distinct: DataFrame, words: int, similarity: float) -> tuple[DataFrame, list[Cut]]:
    """The links (u, v) between texts whose shingle sets are as similar, and the tables to be dropped."""
    texts = distinct.select("rep", "text_hash")
    ends = Cut(links.join(texts.withColumnsRenamed({"rep": "u", "text_hash": "hu"}), "u").join(texts.withColumnsRenamed({"rep": "v", "text_hash": "hv"}), "v"))
    sets = Cut(_sets(docs, ends.df.select(F.explode(F.array("hu", "hv")).alias("text_hash")).distinct(), words), batch=TEXTS)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [jaccard(x.as_py(), y.as_py()) >= similarity for x, y in zip(b.column(2), b.column(3))]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    of = lambda end: sets.df.select(F.col("text_hash").alias("h" + end), F.col("shingles").alias("s" + end))
    return ends.df.join(of("u"), "hu").join(of("v"), "hv").select("u", "v", "su", "sv").mapInArrow(each, "u long, v long"), [ends, sets]


def first_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8, margin: float = 0.1, radius: int = 5) -> DataFrame:
    """The rows of docs, with all columns, that stay if of each component one does: that of the smallest id, of
    those that share it that of the smallest text hash, and of rows equal in both that of the smallest hash of all
    columns. Ids that are null come last, so a component of such rows keeps one of them too. Null and empty texts
    are alike.

    Two documents are linked if their sets of word shingles have this Jaccard similarity, so none goes without a
    partner that is as similar. Candidates differ in `radius` bits at most in one of four fingerprints of their word
    pairs, and by a sketch of 512 bits of their shingles they are as similar, less a margin of twice its standard
    error or more. In each bucket the nearest candidates that join all of them are verified by the shingles.
    """
    keys = SOUGHT + CHECKED
    prints = Cut(_hashed(docs, keys, lambda t: sketches(t, words)), batch=TEXTS)
    distinct = _numbered(prints.df, keys)
    links, sizes = near_links(distinct.df, SOUGHT, radius, CHECKED, differing(similarity - margin), 0, apart=True)
    candidates = Cut(links)
    verified, done = _verified(docs, candidates.df, distinct.df, words, similarity)
    named = _named(distinct, verified, keys)
    for t in (distinct, sizes, candidates, *done):
        t.drop()
    rows = prints.df.groupBy("doc_id", "text_hash", *keys).agg(F.count("*").alias("n")).join(named.df, keys)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias("first")
    kept = Cut(rows.groupBy("component").agg(first).select("first.doc_id", "first.text_hash", "first.n"))
    prints.drop()
    named.drop()
    same = lambda k: docs.doc_id.cast("long").eqNullSafe(k.doc_id) & (text_hash(docs.text) == k.text_hash)
    lone, repeated = (kept.df.where(c) for c in ("n = 1", "n > 1"))
    again = docs.join(repeated, same(repeated), "left_semi")
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    again = again.groupBy(F.col("doc_id").alias("_id"), text_hash(F.col("text")).alias("_hash")).agg(one).select("row.*")
    return docs.join(lone, same(lone), "left_semi").unionByName(again)
