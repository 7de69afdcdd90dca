"""Near-duplicate lines by a segment-partition edit join.

Two lines within `edits` edits share one of edits + 1 segments of the shorter one: it is cut into that
many even parts, and edits can spoil all but one of them. So each line is indexed by its own parts, with
its length, and probes the parts that a line of its length or up to `edits` less could have, at the
offsets that the length difference leaves open (the same substring on both sides of which no more edits
can lie than there are other parts). Candidates are verified by a banded bit-parallel edit distance.

Only hashes are shuffled to find candidates. A signature of two lines is a pair, few lines are joined as
pairs. More lines share a hot segment: what stands beside it is cut into parts in turn, for the edits that
are left, so that only lines that share the segment and a part beside it meet. Where that leaves many lines
too, they are compared in tiles that leave a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut, by_run, released, runs, text_hash, with_flag
from .components import components

SEGMENT_CHARS = 4  # the edit join takes lines with so many characters a segment; shorter ones are compared whole
PAIRS_UP_TO = 48
TILE, TILE_CHARS = 512, 4_000_000
CHANGED_BITS = 27  # of the bitmap that says which texts may lose a line: 16 MB
MET_BITS = 27  # of those that say which signatures several lines share, and which rows hold a line that is sought


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is at most k: a band of 2k + 1 diagonals in the bits of an integer."""
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > k:
        return False
    lo, hi = 0, len(b)  # the common beginning, by halving
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, len(b)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] == b[len(b) - mid :] else (lo, mid - 1)
    a, b = a[: len(a) - lo], b[: len(b) - lo]
    if not b:
        return len(a) <= k
    full = (1 << 2 * k + 1) - 1
    top = 1 << 2 * k
    plus, minus, score = ((1 << k + 1) - 1) << k, 0, k  # column differences in the band; the score at its lower edge
    edge = top >> 1
    for j, c in enumerate(b):
        window = a[max(0, j - k) : j + k + 1]
        equal, bit = 0, 1 << max(0, k - j)
        for x in window:
            if x == c:
                equal |= bit
            bit <<= 1
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        right = (minus | ~(diagonal | plus)) & full
        left = diagonal & plus
        if j + k < len(a):  # the lower edge goes down a diagonal
            score += not diagonal & top
        else:  # it has met the last row and goes along it
            score += bool(right & edge) - bool(left & edge)
            edge >>= 1
        if score - (len(b) - 1 - j) > 2 * k:
            return False
        below = diagonal >> 1
        plus, minus = (left | ~(below | right)) & full, below & right
    return score <= k


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment from 0, shift of its place): all that a line must look up."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            lo, hi = max(-i, less - (edits - i)), min(i, less + (edits - i))
            out += [(less, i, shift) for shift in range(lo, hi + 1)]
    return out


def _signature(line: Column, length: Column, less: int, i: int, shift: int, edits: int) -> Column:
    """Hash of the other line's length, the segment's number and the substring at its place moved by shift."""
    other = length - less
    size = F.floor(other / (edits + 1)).cast("int")
    longer = other % (edits + 1)  # the last parts are one longer
    start = size * i + F.greatest(F.lit(0), F.lit(i) - (edits + 1 - longer))
    part = size + (F.lit(i) >= edits + 1 - longer).cast("int")
    return F.xxhash64(other, F.lit(i), F.substring(line, start + shift + 1, part))


def _entries(line: Column, length: Column, edits: int) -> list[tuple[tuple[int, int, int], Column]]:
    """Every probe with its signature; probes without shift of the line's own length are what others look up. length:
    a column, as each signature has it several times."""
    return [(x, _signature(line, length, *x, edits)) for x in probes(edits)]


def _parts(length: int, n: int) -> list[tuple[int, int]]:
    """Start and length of n even parts, the last ones longer by one."""
    size, longer = divmod(length, n)
    return [(size * i + max(0, i - (n - longer)), size + (i >= n - longer)) for i in range(n)]


def finer(line: str, less: int, i: int, shift: int, edits: int) -> list[tuple[bool, tuple]]:
    """What a line and another one that shares the i-th segment must also share, one of it at least: parts of
    what stands beside the segment, for the edits that may be there, each with whether others look it up."""
    start, size = _parts(len(line) - less, edits + 1)[i]
    at = start + shift
    side, rest, apart = (line[at + size :], edits - i, less - shift) if i < edits else (line[:at], i, shift)
    out = []
    if len(side) >= apart:
        for p, (start, size) in enumerate(_parts(len(side) - apart, rest + 1)):
            for s in range(max(-p, apart - (rest - p)), min(p, apart + (rest - p)) + 1):
                if start + s >= 0:
                    out.append((less == shift == s == 0, (len(side) - apart, p, side[start + s : start + s + size])))
    return out


def _finer(edits: int):
    """h, sig, indexed and length: of lines with a hot signature, the probe of which is the k-th."""
    looks = probes(edits)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for h, line, k, hot in zip(*(b.column(c).to_pylist() for c in ("h", "line", "k", "hot_sig"))):
                for indexed, what in finer(line, *looks[k], edits):
                    sig = xxhash.xxh64_intdigest(repr((hot, what)).encode("utf-8", "surrogatepass"))
                    rows.append((h, sig - (1 << 64) if sig >> 63 else sig, indexed, len(line)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_(), pa.int32()))], ["h", "sig", "indexed", "length"])

    return each


#: Where a row stands among all: by id, then by a part of the text's hash; rows without an id come last.
ROW = "cast(coalesce(cast(doc_id as long), 9223372036854775807) as decimal(19,0)) * 67108864 + pmod(text_hash, 67108864)"


def split_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """row and text_hash of the text, line_no, place (their order in one number), line and two hashes of it, h
    and g, of all lines long enough and not blank."""
    rows = docs.where("text is not null").select(text_hash(F.col("text")).alias("text_hash"), F.col("doc_id"), F.col("text").cast("string").alias("text"))
    lines = rows.select(F.expr(ROW).cast("decimal(28,0)").alias("row"), "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.lower(F.trim("line"))).where(F.length("line") >= least_chars).where(F.col("line").rlike(r"(?U)\S"))
    place = F.col("row") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no")
    return lines.select("row", "text_hash", "line_no", place.cast("decimal(38,0)").alias("place"), "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def _verify(edits: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [within(x.as_py(), y.as_py(), edits) for x, y in zip(b.column(2), b.column(3))]
            yield b.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return each


def _bags(texts: list[str]) -> np.ndarray:
    """How often each of 32 classes of characters occurs; one edit changes two counts by one at most."""
    return np.stack([np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) & 31, minlength=32) for t in texts]).astype(np.int32)


def _tile_links(edits: int):
    """Within a pair of tiles: links that join what the near pairs join."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["sig", "tile_i", "tile_j"]):
            h, own = rows.column("h").to_numpy(), rows.column("own_tile").to_numpy()
            index = rows.column("indexed").to_numpy(zero_copy_only=False)
            texts = rows.column("line").to_pylist()
            bags, lengths = _bags(texts), np.array([len(t) for t in texts])
            i, j = rows.column("tile_i")[0].as_py(), rows.column("tile_j")[0].as_py()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            root = list(range(len(h)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            out = []
            for x in left.tolist():
                near = right[right > x] if i == j else right
                near = near[(np.abs(lengths[near] - lengths[x]) <= edits) & (index[near] | index[x])]
                near = near[np.abs(bags[near] - bags[x]).sum(axis=1) <= 2 * edits]
                for y in near.tolist():
                    a, b = find(x), find(y)
                    if a != b and within(texts[x], texts[y], edits):
                        root[b] = a
                        out.append((x, y))
            if out:
                u, v = np.array(out).T
                yield pa.RecordBatch.from_arrays([pa.array(h[u]), pa.array(h[v])], ["u", "v"])

    return each


def _texts(docs: DataFrame, wanted: DataFrame, least_chars: int) -> Cut:
    """h, line: of the hashes in `wanted` (h, first), read in the first row that has them; no other text is moved."""
    lists = Cut(wanted.groupBy(F.floor(F.col("first") / (1 << 31)).cast("decimal(28,0)").alias("row")).agg(F.collect_set("h").alias("hs")))
    rows = docs.where("text is not null").select(text_hash(F.col("text")).alias("text_hash"), F.col("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select(F.expr(ROW).cast("decimal(28,0)").alias("row"), "text")
    rows = with_flag(rows, F.xxhash64("row"), lists.df.select(F.xxhash64("row").alias("row")), "_may_hold", MET_BITS).where("_may_hold").drop("_may_hold")
    held = rows.join(lists.df, "row")
    lines = held.select("hs", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.lower(F.trim("line"))).where(F.length("line") >= least_chars)
    lines = lines.withColumn("h", F.xxhash64("line"))
    texts = Cut(lines.where(F.array_contains("hs", F.col("h"))).select("h", "line").dropDuplicates(["h"]))
    lists.drop()
    return texts


def _pairs(members: DataFrame) -> DataFrame:
    """u < v: of each sig, one member that is looked up (indexed) with each other one."""
    pairs = members.where("indexed").select("sig", F.col("h").alias("a")).join(members.select("sig", F.col("h").alias("b")), "sig").where("a <> b")
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))


def _met(entries: DataFrame) -> DataFrame:
    """sig, size: of signatures that several lines share and one is looked up by."""
    return entries.groupBy("sig").agg(F.count("*").cast("int").alias("size"), F.max("indexed").alias("any")).where("size > 1 and any").select("sig", "size")


def _of(entries: DataFrame, met: DataFrame) -> DataFrame:
    """The entries whose signature is in `met`, with its size. Few are: a bitmap of a fixed size rules out nearly all
    others where they are, so that they aren't shuffled a second time, at any size of `met`."""
    return with_flag(entries, F.col("sig"), met.select("sig"), "_may_meet", MET_BITS).where("_may_meet").drop("_may_meet").join(met, "sig")


def _hot_links(hot: DataFrame, texts: DataFrame, edits: int) -> tuple[DataFrame, DataFrame, list[Cut]]:
    """Of hot signatures' lines (sig, h): candidate pairs u, v by finer signatures, links found in tiles where
    those are hot again, and the tables to be dropped."""
    labelled = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), sig.alias("hot_sig")) for k, (_, sig) in enumerate(_entries(F.col("line"), F.length("line"), edits))])).alias("e")
    lines = hot.select("h").distinct().join(texts, "h").select("h", "line", labelled).select("h", "line", "e.*")
    lines = lines.join(hot.select(F.col("sig").alias("hot_sig")).distinct(), "hot_sig")
    beside = lines.mapInArrow(_finer(edits), "h long, sig long, indexed boolean, length int")
    beside = Cut(beside.groupBy("sig", "h").agg(F.max("indexed").alias("indexed"), F.first("length").alias("length")))
    met = Cut(_met(beside.df))
    cold = beside.df.join(met.df.where(F.col("size") <= PAIRS_UP_TO).select("sig"), "sig")
    tiles = F.ceil(F.greatest(F.col("size") / TILE, F.col("chars") / TILE_CHARS)).cast("int")
    hotter = beside.df.groupBy("sig").agg(F.count("*").alias("size"), F.sum("length").alias("chars"), F.max("indexed").alias("any")).where((F.col("size") > PAIRS_UP_TO) & F.col("any"))
    still = beside.df.join(hotter.drop("any"), "sig")
    dealt = still.withColumn("own_tile", F.pmod(F.xxhash64(F.lit(3), "h"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.select("sig", F.least("own_tile", "other").alias("tile_i"), F.greatest("own_tile", "other").alias("tile_j"), "own_tile", "h", "indexed").join(texts, "h")
    return _pairs(cold), by_run(dealt, ["sig", "tile_i", "tile_j"]).mapInArrow(_tile_links(edits), "u long, v long"), [beside, met]


def line_classes(docs: DataFrame, edits: int = 2, least_chars: int = 1) -> tuple[Cut, Cut]:
    """All distinct lines (h, n, first) and node, component of those with near ones (as h); the caller drops
    both. Different lines of one hash, as the second hash tells, are left out, so that none is taken for another."""
    lines = split_lines(docs, least_chars).withColumn("length", F.length("line"))
    edit_chars = max(least_chars, SEGMENT_CHARS * (edits + 1))
    length = F.col("length")
    looks = _entries(F.col("line"), length, edits)
    # of shorter lines they are not used: with a condition for each, the method that Spark generates is beyond the 8000 bytes
    # that the JVM compiles. Lines of one h and g are the same, so the largest is theirs, and takes one buffer, a first two
    signs = [sig.alias(f"s{k}") for k, (_, sig) in enumerate(looks)]
    kept = [F.max(f"s{k}").alias(f"s{k}") for k in range(len(looks))]
    distinct = lines.select("h", "g", "place", "length", *signs).groupBy("h").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.min("g").alias("g"), F.max("g").alias("g2"), F.max("length").alias("length"), *kept)
    table = Cut(distinct.where("g = g2").drop("g", "g2"))
    looked_up = reduce(or_, [F.col("sig") == F.col(f"s{k}") for k, (x, _) in enumerate(looks) if x[0] == x[2] == 0])
    signatures = F.explode(F.array_distinct(F.array(*[f"s{k}" for k in range(len(looks))]))).alias("sig")
    entries = table.df.where(F.col("length") >= edit_chars).select("*", signatures).select("sig", "h", "length", looked_up.alias("indexed"))
    groups = Cut(_met(entries))
    released(docs.sparkSession)
    more = Cut(_of(entries, groups.df).select("sig", "h", "indexed", "size"))
    few, hot = more.df.where(F.col("size") <= PAIRS_UP_TO), more.df.where(F.col("size") > PAIRS_UP_TO)
    pairs = Cut(_pairs(few).distinct())
    named = pairs.df.select(F.explode(F.array("u", "v")).alias("h")).unionByName(hot.select("h")).distinct()
    texts = _texts(docs, named.join(table.df.select("h", "first"), "h"), edit_chars)
    finer, tiled, written = _hot_links(hot, texts.df, edits)
    left, right = texts.df.select(F.col("h").alias("u"), F.col("line").alias("x")), texts.df.select(F.col("h").alias("v"), F.col("line").alias("y"))
    links = pairs.df.unionByName(finer).distinct().join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(_verify(edits), "u long, v long")
    classes = components(links.unionByName(tiled))
    for done in (groups, more, pairs, texts, *written):
        done.drop()
    return table, classes


def removals(docs: DataFrame, edits: int = 2, least_chars: int = 1) -> Cut:
    """row, text_hash, gone: the line numbers (from 0) of lines that repeat an earlier one, exactly or nearly."""
    table, found = line_classes(docs, edits, least_chars)
    named = table.df.select("h", "n", "first").join(found.df.withColumnRenamed("node", "h"), "h", "left")
    lone = named.where("component is null and n > 1").select("h", "first")
    linked = named.where("component is not null")
    firsts = linked.groupBy("component").agg(F.min("first").alias("first"))
    again = Cut(lone.unionByName(linked.drop("first").join(firsts, "component").select("h", "first")))
    table.drop()
    found.drop()
    repeats = split_lines(docs, least_chars).select("h", "place", "row", "text_hash", "line_no").join(again.df, "h").where("place <> first")
    gone = Cut(repeats.groupBy("row", "text_hash").agg(F.array_sort(F.collect_set("line_no")).alias("gone")))
    again.drop()
    return gone


def dedup(docs: DataFrame, edits: int = 2, least_chars: int = 1) -> DataFrame:
    """All rows and columns of docs with repeated lines taken out of text, and n_lines, n_removed, gone.

    A line counts from `least_chars` characters on, trimmed and in lower case; shorter and blank ones always
    stay. Exact repeats go at any length; edits are allowed from SEGMENT_CHARS characters a segment on. Lines
    within `edits` edits of one another, and what is reached by such steps, form a class; the one in the
    smallest doc_id, first in it, stays. Null texts stay null with no lines; empty texts, and texts whose
    lines all go, are empty. Rows that share a doc_id but differ in text are rows of their own, in the order
    of their texts' hashes; rows without an id come after all others; rows equal in id and text lose the same
    lines. Columns of docs named as the three new ones are replaced.
    """
    docs = docs.drop("n_lines", "n_removed", "gone")
    gone = removals(docs, edits, least_chars).df.withColumnsRenamed({"row": "_gone_row", "text_hash": "_gone_hash"})
    released(docs.sparkSession)
    at = F.expr(ROW.replace("text_hash", "xxhash64(coalesce(cast(text as string), ''))")).cast("decimal(28,0)")
    # texts that lose nothing stay where they are: a bitmap of a fixed size tells most of them at any size of docs
    marked = with_flag(docs, text_hash(docs.text), gone.select("_gone_hash"), "_may_change", CHANGED_BITS)
    rows = marked.where("_may_change").join(gone, (at == gone._gone_row) & (text_hash(docs.text) == gone._gone_hash), "left").drop("_gone_row", "_gone_hash", "_may_change")
    rows = rows.unionByName(marked.where("not _may_change").drop("_may_change").withColumn("gone", F.lit(None).cast("array<int>")))
    lines = F.split(F.col("text").cast("string"), "\n")
    kept = F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains(F.col("gone"), i), F.lit(False)))
    text = F.when(F.col("gone").isNull(), F.col("text").cast("string")).otherwise(F.array_join(kept, "\n"))
    rows = rows.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    return rows.withColumn("text", text).withColumn("n_removed", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
