"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with a cosine of c or more lie within a squared distance of 2 - 2c. A rotation keeps that, so
after cutting the rotated vectors into blocks, a near pair is near in at least one block: within the
block's share of the budget, in proportion to its size. Each block is a range join in few dimensions on a
grid: a vector lives in one cell and looks into those cells after it that a ball of the block's radius
touches, so that of two vectors in different cells one looks up the other. Pairs that pass a block are
verified on the whole vectors in double precision, and counted in the first block that they pass, so that
each pair counts once without collecting pairs.

Equal vectors are one member with a weight and a number of its own. In cells where many pairs meet, the
vectors themselves are brought together once, verified on the spot, and leave counts and a spanning forest;
cells of more than TILE members are dealt into tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Cut, by_run, runs
from .components import components
from .simhash import spanning

BLOCK_SIZE, GRID = 8, 4
TILE = 8192
HOT = 40_000  # pairs of a cell beyond which it is verified on the spot


def rotation(d: int, seed: int = 23) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def blocks_of(d: int) -> list[tuple[int, int]]:
    return [(a, min(d, a + BLOCK_SIZE)) for a in range(0, d, BLOCK_SIZE)]


def _units(flat: np.ndarray, d: int) -> np.ndarray:
    x = flat.reshape(-1, d).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square is lost or infinite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _budgets(d: int, cosine: float) -> np.ndarray:
    """Squared radius of each block, a little widened for rounding; a pair at the limit still passes one."""
    return np.array([(2 - 2 * cosine) * (b - a) / d for a, b in blocks_of(d)]) * (1 + 1e-9) + 1e-12


def _touched(x: np.ndarray, width: float, radius2: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of all grid cells within the radius of each row; the cell is its integer coordinates."""
    home = np.floor(x / width).astype(np.int64)
    rows, cells, left = np.arange(len(x)), np.zeros((len(x), 0), np.int64), np.full(len(x), radius2)
    reach = int(np.ceil(np.sqrt(radius2) / width))
    for k in range(x.shape[1]):
        parts = []
        for step in range(-reach, reach + 1):
            cell = home[rows, k] + step
            gap = np.maximum(0.0, np.maximum(cell * width - x[rows, k], x[rows, k] - (cell + 1) * width))
            rest = left - gap * gap
            ok = rest >= 0
            parts.append((rows[ok], np.column_stack([cells[ok], cell[ok]]), rest[ok]))
        rows, cells, left = (np.concatenate(p) for p in zip(*parts))
    return rows, cells


def _codes(cells: np.ndarray) -> np.ndarray:
    code = np.zeros(len(cells), np.int64)
    for k in range(cells.shape[1]):
        code = code * 4093 + (cells[:, k] + 2046)
    return code


#: The radius of a search in single precision is a little wider, never narrower.
WIDER = 1 + 1e-5, 1e-6


def _entries(cosine: float):
    """Home and look-up rows of every vector: dim, block, cell, home, rep and the block's coordinates."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                dims, labels, reps = part.column(2).to_numpy(), part.column(1).to_numpy(), part.column(0).to_numpy()
                for d in np.unique(dims):
                    mine = np.flatnonzero(dims == d)
                    flat = part.column(3).take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False)
                    x, budget = _units(flat, int(d)) @ rotation(int(d)), _budgets(int(d), cosine)
                    for k, (a, b) in enumerate(blocks_of(int(d))):
                        y = x[:, a:b]
                        g, width = y[:, : min(GRID, b - a)], 2 * np.sqrt(budget[k])
                        rows, cells = _touched(g, width, budget[k] * WIDER[0] + WIDER[1])
                        code, own = _codes(cells), _codes(np.floor(g / width).astype(np.int64))[rows]
                        rows, code, own = (c[code >= own] for c in (rows, code, own))
                        at_home, n = code == own, len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(labels[mine][rows]), pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, k, np.int32)), pa.array(code), pa.array(at_home), pa.array(reps[mine][rows]),
                                pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * (b - a)), n, [None, pa.py_buffer(np.ascontiguousarray(y[rows], np.float32))]).cast(pa.binary()),
                            ],
                            ["label", "d", "block", "cell", "home", "rep", "y"],
                        )

    return each


ENTRY = "label int, d int, block int, cell long, home boolean, rep long, y binary"
KEYS = ["label", "d", "block", "cell", "tile_i", "tile_j"]


def _candidates(cosine: float):
    """Pairs of a cell, one of them at home there, that are within the block's radius."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, KEYS[:4]):
            d, k = rows.column("d")[0].as_py(), rows.column("block")[0].as_py()
            home, rep = rows.column("home").to_numpy(zero_copy_only=False), rows.column("rep").to_numpy()
            if home.all() and len(home) < 2 or not home.any():
                continue
            y = np.frombuffer(b"".join(rows.column("y").to_pylist()), np.float32).reshape(len(rep), -1).astype(np.float64)
            here, n2, budget = np.flatnonzero(home), (y * y).sum(axis=1), _budgets(d, cosine)[k] * WIDER[0] + WIDER[1]
            for a in range(0, len(rep), 1024):
                x = np.arange(a, min(len(rep), a + 1024))
                near = n2[x][:, None] + n2[here] - 2 * y[x] @ y[here].T <= budget
                i, j = np.nonzero(near & (~home[x][:, None] | (rep[x][:, None] < rep[here])))
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(rep[x[i]]), pa.array(rep[here[j]]), pa.array(np.full(len(i), k, np.int32))], ["u", "v", "block"])

    return each


def _first_block(x: np.ndarray, y: np.ndarray, d: int, cosine: float) -> np.ndarray:
    """For rows of rotated vectors: the first block whose distance is within its budget."""
    diff, budget = (x - y) ** 2, _budgets(d, cosine)
    ok = np.stack([diff[:, a:b].sum(axis=1) <= budget[k] for k, (a, b) in enumerate(blocks_of(d))])
    return np.where(ok.any(axis=0), ok.argmax(axis=0), -1)


def _verified(x: np.ndarray, y: np.ndarray, d: int, k: int | np.ndarray, cosine: float) -> np.ndarray:
    turn = rotation(d)
    return ((x * y).sum(axis=1) >= cosine) & (_first_block(x @ turn, y @ turn, d, cosine) == k)


def _verify(cosine: float):
    """u, v of candidates (u, v, block, d, x, y) that hold and belong to this block."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, blocks = b.column(3).to_numpy(), b.column(2).to_numpy()
            good = np.zeros(b.num_rows, bool)
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                for a in range(0, len(mine), 4096):
                    some = mine[a : a + 4096]
                    x, y = (_units(b.column(c).take(pa.array(some)).flatten().to_numpy(zero_copy_only=False), int(d)) for c in (4, 5))
                    good[some] = _verified(x, y, int(d), blocks[some], cosine)
            yield b.select([0, 1]).filter(pa.array(good))

    return each


def _tiles(cosine: float):
    """In a pair of tiles (members' tile against homes' tile): how many links each member has in this block
    and no earlier one, and a spanning forest of them. kind 0: rep and a count; kind 1: a link."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, KEYS):
            d, k = rows.column("d")[0].as_py(), rows.column("block")[0].as_py()
            rep, weight = rows.column("rep").to_numpy(), rows.column("weight").to_numpy()
            home, prober, own = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("as_home", "as_prober", "home"))
            x = _units(rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), d)
            here, links = np.flatnonzero(home), []
            count = np.zeros(len(rep), np.int64)
            for a in range(0, len(rep), 256):
                some = np.flatnonzero(prober[a : a + 256]) + a
                i, j = np.nonzero((x[some] @ x[here].T >= cosine - 1e-9) & (~own[some][:, None] | (rep[some][:, None] < rep[here])))
                for c in range(0, len(i), 16384):
                    p, q = some[i[c : c + 16384]], here[j[c : c + 16384]]
                    ok = _verified(x[p], x[q], d, k, cosine)
                    p, q = p[ok], q[ok]
                    np.add.at(count, p, weight[q])
                    np.add.at(count, q, weight[p])
                    if len(p):
                        links.append(spanning(rep[p], rep[q]))
            some = np.flatnonzero(count)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(some), np.int32)), pa.array(rep[some]), pa.array(count[some])], ["kind", "u", "v"])
            if links:
                u, v = spanning(*(np.concatenate([z[c].to_numpy() for z in links]) for c in (0, 1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(u), np.int32)), u, v], ["kind", "u", "v"])

    return each


def _hot_rows(hot: DataFrame) -> DataFrame:
    """Where each entry of a hot cell is compared: once, or in cells beyond TILE in all pairs of tiles of
    entries and members at home."""
    a, b = F.ceil(F.col("n") / TILE).cast("int"), F.ceil(F.col("homes") / TILE).cast("int")
    same = ["label", "d", "block", "cell", "rep", "home"]
    one, none = F.lit(0).alias("tile_i"), F.lit(0).alias("tile_j")
    whole = hot.where(F.col("n") <= TILE).select(*same, one, none, F.col("home").alias("as_home"), F.lit(True).alias("as_prober"))
    large = hot.where(F.col("n") > TILE).withColumn("i", F.pmod(F.xxhash64(F.lit(9), "rep"), a).cast("int")).withColumn("j", F.pmod(F.xxhash64(F.lit(9), "rep"), b).cast("int"))
    probers = large.select(*same, F.col("i").alias("tile_i"), F.explode(F.sequence(F.lit(0), b - 1)).alias("tile_j"), F.lit(False).alias("as_home"), F.lit(True).alias("as_prober"))
    homes = large.where("home").select(*same, F.explode(F.sequence(F.lit(0), a - 1)).alias("tile_i"), F.col("j").alias("tile_j"), F.lit(True).alias("as_home"), F.lit(False).alias("as_prober"))
    return whole.unionByName(probers).unionByName(homes)


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors (vec_id, embedding, label).

    Rows with the same label and as many components are compared. A null label, and a vector that is null,
    empty, zero or holds a null or non-finite component, links with nothing. Equal vectors count one by
    one. Rows that repeat a vec_id count as vectors of their own with that id; a null vec_id links with
    nothing. Other columns are not read.
    """
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    good = rows.where(usable)
    members = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    members = Cut(members.withColumn("rep", F.monotonically_increasing_id()))  # fixed by being written
    reps = members.df.withColumn("d", F.size("embedding"))
    entries = Cut(reps.select("rep", "label", "d", "embedding").mapInArrow(_entries(cosine), ENTRY))
    cells = entries.df.groupBy("label", "d", "block", "cell").agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).where("homes > 0 and n > 1")
    cells = Cut(cells)
    cold = entries.df.join(cells.df.where(F.col("n") * F.col("homes") <= HOT).drop("n", "homes"), KEYS[:4])
    found = by_run(cold, KEYS[:4]).mapInArrow(_candidates(cosine), "u long, v long, block int")
    left = reps.select(F.col("rep").alias("u"), "d", F.col("embedding").alias("x"))
    right = reps.select(F.col("rep").alias("v"), F.col("embedding").alias("y"))
    pairs = found.join(left, "u").join(right, "v").select("u", "v", "block", "d", "x", "y").mapInArrow(_verify(cosine), "u long, v long")
    hot = _hot_rows(entries.df.drop("y").join(cells.df.where(F.col("n") * F.col("homes") > HOT), KEYS[:4]))
    tiles = Cut(by_run(hot.join(reps.select("rep", "weight", "embedding"), "rep"), KEYS).mapInArrow(_tiles(cosine), "kind int, u long, v long"))
    links = Cut(pairs)
    entries.drop()
    cells.drop()
    weight = reps.select(F.col("rep").alias("other"), "weight")
    ends = links.df.unionByName(links.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
    counts = ends.join(weight, F.col("v") == F.col("other")).select("u", "weight").unionByName(tiles.df.where("kind = 0").select("u", F.col("v").alias("weight")))
    counts = counts.groupBy(F.col("u").alias("rep")).agg(F.sum("weight").alias("links"))
    classes = components(links.df.unionByName(tiles.df.where("kind = 1").select("u", "v")))
    known = members.df.join(counts, "rep", "left").join(classes.df.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    known = Cut(known.select("label", "embedding", "component", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    for done in (members, tiles, links, classes):
        done.drop()
    names = known.df.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.df.join(names, "component").select("label", "embedding", "n_links", "component_id")
    joined = good.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def sql(cosine: float = 0.98) -> str:
    """The same rows in DuckDB's SQL, by comparing all pairs; for small tables with unique ids."""
    return f"""
with recursive e as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and list_bool_and([x is not null and isfinite(x) for x in embedding])
      and list_inner_product(embedding::double[], embedding::double[]) > 0),
l as materialized (
    select a.vec_id as u, b.vec_id as v from e a join e b on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
    where list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= {cosine}),
reach(node, root) as (select vec_id, vec_id from e union select l.v, reach.root from reach join l on l.u = reach.node where reach.root < l.v)
select x.vec_id, coalesce(n.links, 0)::bigint as n_links, coalesce(m.root, x.vec_id) as component_id, coalesce(m.root, x.vec_id) = x.vec_id as kept
from embeddings x left join (select u, count(*) as links from l group by 1) n on n.u = x.vec_id
left join (select node, min(root) as root from reach group by 1) m on m.node = x.vec_id"""
