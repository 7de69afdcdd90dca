"""The store of saved settings: a change log of flat rows with snapshots, read by collapsing it."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Model
from ..operators.collapse import current
from ..plans.request import Plan
from .batches import Commits, files_of

# Of each type of document, its fields as documents nest them, and the columns that hold them.
SEARCH_SOURCE = {"kibanaSavedObjectMeta.searchSourceJSON": "searchSourceJSON"}
TITLED = {"description": "description", "hits": "hits", "title": "title", "version": "version"}
FIELDS = {
    "config": {"buildNum": "buildNum", "defaultIndex": "defaultIndex"},
    "dashboard": {
        **TITLED, **SEARCH_SOURCE, "optionsJSON": "optionsJSON", "panelsJSON": "panelsJSON", "refreshInterval.display": "refreshInterval_display",
        "refreshInterval.pause": "refreshInterval_pause", "refreshInterval.section": "refreshInterval_section", "refreshInterval.value": "refreshInterval_value",
        "timeFrom": "timeFrom", "timeRestore": "timeRestore", "timeTo": "timeTo", "uiStateJSON": "uiStateJSON",
    },
    "index-pattern": {
        "fieldFormatMap": "fieldFormatMap", "fields": "fields", "intervalName": "intervalName", "notExpandable": "notExpandable",
        "sourceFilters": "sourceFilters", "timeFieldName": "timeFieldName", "title": "title",
    },
    "search": {**TITLED, **SEARCH_SOURCE, "columns": "columns", "sort": "sort"},
    "server": {"uuid": "uuid"},
    "timelion-sheet": {
        **TITLED, **SEARCH_SOURCE, "timelion_chart_height": "timelion_chart_height", "timelion_columns": "timelion_columns", "timelion_interval": "timelion_interval",
        "timelion_other_interval": "timelion_other_interval", "timelion_rows": "timelion_rows", "timelion_sheet": "timelion_sheet",
    },
    "url": {"accessCount": "accessCount", "accessDate": "accessDate", "createDate": "createDate", "url": "url"},
    "visualization": {"description": "description", **SEARCH_SOURCE, "savedSearchId": "savedSearchId", "title": "title", "uiStateJSON": "uiStateJSON", "version": "version", "visState": "visState"},
}
NUMBERS = {"hits", "version", "buildNum", "refreshInterval_section", "refreshInterval_value", "timelion_chart_height", "timelion_columns", "timelion_rows", "accessCount"}
TRUTHS = {"refreshInterval_pause", "timeRestore", "notExpandable"}
LISTS = {"columns", "sort"}


def _kind(column: str) -> T.DataType:
    if column in NUMBERS:
        return T.LongType()
    if column in TRUTHS:
        return T.BooleanType()
    return T.ArrayType(T.StringType()) if column in LISTS else T.StringType()


COLUMNS = sorted({c for fields in FIELDS.values() for c in fields.values()})
SCHEMA = T.StructType(
    [T.StructField("_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("updated_at", T.TimestampType()), T.StructField("seq", T.LongType()), T.StructField("sign", T.IntegerType())]
    + [T.StructField(c, _kind(c)) for c in COLUMNS]
)


def flatten(kind: str, doc: dict) -> dict:
    """The columns that a document of this type fills; what its type doesn't have is left out."""
    if kind not in FIELDS:
        raise ValueError(f"no such type of document: {kind}")
    out = {}
    for path, column in FIELDS[kind].items():
        value: object = doc
        for part in path.split("."):
            value = value.get(part) if isinstance(value, dict) else None
        if value is not None:
            out[column] = [str(v) for v in value] if column in LISTS else bool(value) if column in TRUTHS else int(value) if column in NUMBERS else str(value)
    return out


def nest(row: dict) -> dict:
    """The document that a row holds."""
    out: dict = {}
    for path, column in FIELDS.get(row["type"], {}).items():
        if row.get(column) is not None:
            at, (*above, last) = out, path.split(".")
            for part in above:
                at = at.setdefault(part, {})
            at[last] = row[column]
    return out


class Settings:
    """Documents under a folder, as a log of numbered changes and, every so often, a snapshot of what is current.

    A change is made of what a version of the log holds, and is the next version or nothing: if another writer has
    been first it is made anew. Readers take the last snapshot and what follows it, so a read and a change cost at
    most `every` small files and one snapshot, however long the store has been in use. What the snapshot before the
    last one replaced is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        self.commits = Commits(spark, f"{self.path}/_commits")

    def versions(self) -> list[int]:
        return [int(n) for n in self.commits.names()]

    def _kept(self, upto: int) -> tuple[list[str], int]:
        """The folders that hold a version of the log, and the number of the snapshot that they begin with."""
        folders: list[str] = []
        while upto > 0:
            here = self.commits.read(f"{upto:012d}")
            folders.append(f"{self.path}/{here['folder']}")
            if here["snapshot"]:
                break
            upto -= 1
        return folders, upto

    def log(self, version: int | None = None) -> DataFrame:
        """The rows of the log as they were at a version, or are now."""
        folders, _ = self._kept(max(self.versions(), default=0) if version is None else version)
        return self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)

    def read(self) -> DataFrame:
        """The current documents, one row each."""
        return current(self.log(), "_id")

    def _change(self, made: Callable[[DataFrame, int], DataFrame], large: bool = False) -> int:
        """Adds a change; made: its rows, of the current documents and the version that the change will be; large:
        they are written by several tasks."""
        while True:
            version = max(self.versions(), default=0) + 1
            rows = made(current(self.log(version - 1), "_id"), version)
            if self._add(rows, version, False, large):
                if version % self.every == 0:
                    self._snapshot()
                return version

    def _add(self, rows: DataFrame, version: int, snapshot: bool, large: bool = False) -> bool:
        folder = f"{'snapshot' if snapshot else 'change'}-{version:012d}-{uuid.uuid4().hex}"
        rows = rows.select(*SCHEMA.names)
        (rows if snapshot or large else rows.coalesce(1)).write.parquet(f"{self.path}/{folder}")
        if self.commits.add(f"{version:012d}", {"folder": folder, "snapshot": snapshot}):
            return True
        self._delete(folder)
        return False

    def _snapshot(self) -> None:
        """The current documents as the next version; left to a later change if another writer is first."""
        version = max(self.versions()) + 1
        _, last = self._kept(version - 1)
        if self._add(current(self.log(version - 1), "_id").withColumn("sign", F.lit(1)), version, True) and last:
            for n in self.versions():
                if n < last:  # before the snapshot that was the last one until now, which readers may still be at
                    self._delete(self.commits.read(f"{n:012d}")["folder"])
                    self._delete(f"_commits/{n:012d}")

    def _delete(self, name: str) -> None:
        files, path = files_of(self.spark, f"{self.path}/{name}")
        files.delete(path, True)

    def put(self, kind: str, id: str | None, doc: dict, now_ns: int | None = None) -> dict:
        """Stores a document in place of the one with its id. An update's {"doc": ...} replaces as well."""
        now = now_ns or time.time_ns()
        id = id or f"{kind}_{now}"
        empty = {c: [] for c in FIELDS.get(kind, {}).values() if c in LISTS}
        row = {"_id": id, "type": kind, "sign": 1, **empty, **flatten(kind, doc.get("doc", doc) if set(doc) == {"doc"} else doc)}
        new = self.spark.createDataFrame([tuple(row.get(c) for c in SCHEMA.names)], SCHEMA).withColumn("updated_at", F.timestamp_micros(F.lit(now // 1000)))

        def made(docs: DataFrame, version: int) -> DataFrame:
            old = docs.where(F.col("_id") == id).withColumn("sign", F.lit(-1)).select(*SCHEMA.names)
            return old.unionByName(new.withColumn("seq", F.lit(version).cast("long")))

        return {"_index": ".kibana", "_type": kind, "_id": id, "_version": self._change(made), "result": "updated"}

    def load(self, rows: DataFrame, now_ns: int | None = None) -> int:
        """Stores many documents (_id, type, doc as JSON) as one change, each in place of the one with its id. Of an
        id that is given several times the document that sorts last is stored; those of no known type are left out."""
        updated = F.timestamp_micros(F.lit((now_ns or time.time_ns()) // 1000))
        rows = rows.where(F.col("type").isin(*FIELDS) & F.col("_id").isNotNull()).groupBy("_id").agg(F.max(F.struct("type", "doc")).alias("d")).select("_id", "d.*")
        columns = []
        for column in COLUMNS:
            kind = _kind(column)
            of = [F.when(F.col("type") == k, F.get_json_object("doc", "$." + path)) for k, fields in FIELDS.items() for path, c in fields.items() if c == column]
            text = F.coalesce(*of)
            if column in LISTS:
                has = F.col("type").isin(*[k for k, fields in FIELDS.items() if column in fields.values()])
                columns.append(F.coalesce(F.from_json(text, kind), F.when(has, F.array().cast(kind))).alias(column))
            else:
                columns.append((text if isinstance(kind, T.StringType) else text.try_cast(kind)).alias(column))
        new = rows.select("_id", "type", updated.alias("updated_at"), F.lit(1).alias("sign"), *columns)

        def made(docs: DataFrame, version: int) -> DataFrame:
            old = docs.join(new.select("_id"), "_id", "left_semi").withColumn("sign", F.lit(-1)).select(*SCHEMA.names)
            return old.unionByName(new.withColumn("seq", F.lit(version).cast("long")))

        return self._change(made, large=True)

    def delete_by_query(self, body: dict) -> None:
        """Cancels the documents that the body's query selects."""
        if not body.get("query"):
            raise ValueError("a query is needed")
        self._change(lambda docs, _: Plan(docs, Model.of(docs, id="_id")).rows(body["query"])[0].withColumn("sign", F.lit(-1)))

    def mget(self, ids: list[str]) -> dict:
        """The documents with the ids, as a list of hits in the order in which they were asked."""
        rows = {r["_id"]: r.asDict() for r in self.read().where(F.col("_id").isin(list(ids))).collect()}  # one for each id
        return {"docs": [{"_index": ".kibana", "_version": 1, "_id": i, "_type": rows[i]["type"], "_score": 1, "found": True, "_source": nest(rows[i])} for i in dict.fromkeys(ids) if i in rows]}
