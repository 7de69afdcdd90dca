"""Helpers that several operators share: cutting lineage, sorted runs, block tiles."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where none is set and Spark runs in one process."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    at = sc._jsc.sc().getCheckpointDir()
    if not at.isDefined():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        at = sc._jsc.sc().getCheckpointDir()
    return at.get().rstrip("/")


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Cut:
    """A DataFrame written to the shared folder: its lineage ends there. batch: rows that are handed to Python at
    once while it is written, where they hold whole texts; the buffers of each batch stay with the executor."""

    def __init__(self, df: DataFrame, batch: int | None = None):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/cut-{uuid.uuid4().hex}"
        before = self.spark.conf.get(ROWS_PER_BATCH)
        try:
            if batch:
                self.spark.conf.set(ROWS_PER_BATCH, str(batch))
            df.write.parquet(self.path)
        finally:
            self.spark.conf.set(ROWS_PER_BATCH, before)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Deletes the files; only once nothing reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    return Cut(df).df


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of DataFrames that nothing refers to any more, rather than some time later."""
    gc.collect()
    spark._jvm.System.gc()


def with_flag(df: DataFrame, key: Column, keys: DataFrame, name: str, bits: int) -> DataFrame:
    """df with a truth value that is true wherever the key, a hash, is one of `keys`, and rarely elsewhere: by a bitmap
    of 2 ** bits bits that is broadcast in rows of 4 KB, so no row of df moves."""
    at = lambda h: F.shiftrightunsigned(h, 64 - bits)
    column = F.col(keys.columns[0])
    held = keys.groupBy(F.shiftright(at(column), 15).alias("_flag_block")).agg(F.bitmap_construct_agg(at(column).bitwiseAND(F.lit(32767))).alias("_flag_bits"))
    out = df.withColumn("_flag_at", at(key)).withColumn("_flag_block", F.shiftright("_flag_at", 15)).join(F.broadcast(held), "_flag_block", "left")
    bit = F.expr("shiftright(cast(conv(hex(substring(_flag_bits, cast((_flag_at & 32767) div 8 + 1 as int), 1)), 16, 10) as int), cast(_flag_at & 7 as int)) & 1 = 1")
    return out.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_flag_at", "_flag_block", "_flag_bits")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def text_hash(text: Column) -> Column:
    """A number that tells texts apart, with which rows are known that share an id or have none; null counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that share `keys`; the input is sorted by them. One run is held at a time."""
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.table(batch)
        new = np.zeros(rows.num_rows, bool)
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if last is not None and first != last:
            yield pa.concat_tables(held)
            held = []
        at = [0, *np.flatnonzero(new), rows.num_rows]
        for a, b in zip(at, at[1:]):
            if a and held:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.concat_tables(held)


def self_tiles(members: DataFrame, sizes: DataFrame, keys: list[str], item: str, tile: int) -> DataFrame:
    """Deals the members of large groups into pairs of tiles, so that every pair of members of a group
    meets in exactly one (keys, tile_i, tile_j) group of about 2 * `tile` rows. `sizes`: keys and n.
    Adds own_tile; tile_i <= tile_j."""
    n = F.ceil(F.col("n") / tile).cast("int")
    dealt = members.join(sizes, keys).withColumn("own_tile", F.pmod(F.xxhash64(F.lit(7), item), n).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1))).drop("n")
    return dealt.withColumn("tile_i", F.least("own_tile", "other")).withColumn("tile_j", F.greatest("own_tile", "other")).drop("other")


def by_run(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share `keys` side by side in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)
