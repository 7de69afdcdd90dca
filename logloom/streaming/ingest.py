"""One stream of log rows, three tables: the rows, their five-minute counts and their postings.

Each micro-batch is one batch of all tables under its own number, so a batch that is run again after a failure
leaves the same rows. Counts are partial and are added up when read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..model import Model, day_of, nanoseconds
from ..operators.fulltext import lists_of_rows, merge_lists, occurrences_of, postings_of
from ..operators.histograms import build_rollup, merge_rollup
from ..sources.batches import Batches
from ..sources.catalog import stored_lists, stored_rollup, stored_rows


def parse(lines: DataFrame, schema: T.StructType, value: str = "value", wire: dict[str, T.DataType] | None = None) -> DataFrame:
    """JSON lines as columns; a line that isn't valid is kept in _rejected with all columns null. wire: the types
    of fields that come otherwise than they are stored; they are cast, but for text ids, which `transform` hashes."""
    wire = wire or {}
    wide = T.StructType([*(T.StructField(f.name, wire.get(f.name, f.dataType)) for f in schema.fields), T.StructField("_rejected", T.StringType())])
    made = F.from_json(F.col(value).cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rejected"})
    return lines.select(made.alias("_row"), F.col(value).cast("string").alias("_line")).select("_row.*", "_line").withColumn("_rejected", F.when(F.col("_rejected").isNotNull() | F.coalesce(F.trim("_line") == "", F.lit(True)), F.col("_line"))).drop("_line").withColumns({n: F.col(n).cast(schema[n].dataType) for n, t in wire.items() if not isinstance(t, T.StringType)})


def transform(rows: DataFrame, model: Model, hash_id: str | None = None) -> DataFrame:
    """Rows as they are stored: the day of the event, and a text id as its hash."""
    out = rows.withColumn("day", day_of(nanoseconds(model.timestamp)))
    return out.withColumn(hash_id, F.xxhash64(hash_id)) if hash_id else out


def write_batch(batch: DataFrame, number: int, model: Model, out: str, hash_id: str | None = None, stream: str = "") -> bool:
    """The three tables' parts of one batch, and the lines that could not be read: all of them or none. A batch
    that is there already is left alone (False); numbers count within a stream."""
    batch.persist()
    try:
        good, tables = batch, {}
        if "_rejected" in batch.columns:
            tables["rejected"] = (batch.where("_rejected is not null").select("_rejected"), None, {})
            good = batch.where("_rejected is null").drop("_rejected")
        good = good.where(F.col(model.timestamp.name).isNotNull())
        tables |= {"rows": stored_rows(transform(good, model, hash_id), model, "day"), "rollup": stored_rollup(build_rollup(good, model.timestamp))}
        if model.full_text:
            tables["lists"] = stored_lists(lists_of_rows(good, model))
        return Batches(batch.sparkSession, out).write(f"{stream}{number:012d}", tables)
    finally:
        batch.unpersist()


def ingest(stream: DataFrame, model: Model, out: str, checkpoint: str, hash_id: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Starts the ingest; with available_now it ends when what is there has been read."""

    def write(df: DataFrame, n: int) -> None:
        of = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")  # the checkpoint's, the same after a restart
        write_batch(df, n, model, out, hash_id, f"{of}-" if of else "")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def read(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table that the ingest has written (rows, rollup, postings, occurrences, lists, rejected); partial counts
    added up, a time's postings once, as occurrences once for each row that holds the word."""
    df = Batches(spark, out).read("lists" if table in ("postings", "occurrences") else table)
    if df is None:
        raise ValueError(f"nothing is written yet: {table}")
    made = {"rollup": merge_rollup, "postings": postings_of, "occurrences": occurrences_of}.get(table)
    return made(df) if made else df


def compact(spark: SparkSession, out: str, model: Model) -> bool:
    """Merges what batches have left into one by day. Batches may go on meanwhile, and so may readers."""
    return Batches(spark, out).merge({
        "rows": lambda d: stored_rows(d.hint("rebalance", "day"), model, "day"), "rollup": lambda d: stored_rollup(merge_rollup(d)),
        "lists": lambda d: stored_lists(merge_lists(d)), "rejected": lambda d: (d, None, {}),
    })


def kafka_options(servers: str, topic: str, group: str | None = None, starting: str = "earliest", per_batch: int | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source. group: the consumer group that brokers see; per_batch: most records of one batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def lines_of(records: DataFrame, delimiter: str | None = None) -> DataFrame:
    """value: a record's text, or each of its lines where records hold several; empty ones at its end count not."""
    text = F.col("value").cast("string")
    if delimiter is None:
        return records.select(text.alias("value"))
    ended = F.when(text.endswith(delimiter), F.substring(text, F.lit(1), F.length(text) - len(delimiter))).otherwise(text)
    return records.select(F.explode(F.split(ended, r"\Q" + delimiter + r"\E")).alias("value"))


def kafka(spark: SparkSession, servers: str, topic: str, delimiter: str | None = None, **options) -> DataFrame:
    """Lines of a Kafka topic as `value`; needs Spark's Kafka connector on the class path."""
    return lines_of(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load(), delimiter)
