"""A catalog of models and their tables, found by name or by prefix; and tables kept under a folder."""

from __future__ import annotations

import uuid
import warnings
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import DAY, Model, day_of, nanoseconds
from ..operators import fulltext
from ..operators.histograms import build_rollup, merge_rollup
from .batches import Batches, Commits, files_of, listed

INDEX_PREFIX = "index_"


def index_name(table: str) -> str:
    """The name of a table's index."""
    return INDEX_PREFIX + table


class UnknownTable(LookupError):
    pass


class Catalog:
    """Named tables, each with its model and, where they are stored, its word lists and rollup."""

    def __init__(self, prefix: str = "logs_"):
        self.prefix = prefix
        self.tables: dict[str, tuple[DataFrame, Model]] = {}
        self.stored: dict[tuple[str, str], DataFrame] = {}

    def add(self, name: str, df: DataFrame, model: Model, lists: DataFrame | None = None, rollup: DataFrame | None = None) -> None:
        self.tables[name] = (df, model)
        for kind, extra in (("lists", lists), ("rollup", rollup)):
            if extra is not None:
                self.stored[name, kind] = extra

    def exists(self, name: str) -> bool:
        return name in self.tables

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)
        for kind in ("lists", "rollup"):
            self.stored.pop((name, kind), None)

    def names(self, index: str) -> list[str]:
        """The tables that an index pattern reads: those whose name begins with it; 'x*' begins at the
        first searchable table of that prefix."""
        name = index.lstrip(".") if index.startswith(".") else index
        if name.endswith("*"):
            found = sorted(t for t in self.tables if t.startswith(self.prefix) and t.startswith(name.rstrip("*")))
            if not found:
                raise UnknownTable(index)
            if left := [t for t in found if not t.startswith(found[0])]:
                warnings.warn(f"{index} begins at {found[0]}; it doesn't read {', '.join(left)}", stacklevel=2)
            name = found[0]
        found = sorted(t for t in self.tables if t.startswith(name))
        if not found:
            raise UnknownTable(index)
        return found

    def model(self, index: str) -> Model:
        return self.tables[self.names(index)[0]][1]

    def read(self, index: str) -> DataFrame:
        """All tables of the pattern, with their name in _table; columns that one lacks are null in it. If the first
        table has its rows by day, the others get the column as well, as conditions on it hold for all."""
        parts = [self.tables[n][0].withColumn("_table", F.lit(n)) for n in self.names(index)]
        at = self.model(index).timestamp
        if at is not None and at.by_day:
            parts = [p if DAY in p.columns or at.name not in p.columns else p.withColumn(DAY, day_of(nanoseconds(replace(at, type=p.schema[at.name].dataType)))) for p in parts]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def indexes(self, index: str) -> list[fulltext.Index]:
        """What text clauses are looked up in: stored lists where there are, else the rows."""
        return [fulltext.Lists(self.stored[n, "lists"]) if (n, "lists") in self.stored else fulltext.Rows(*self.tables[n]) for n in self.names(index)]

    def rollup(self, index: str) -> DataFrame | None:
        """The stored rollups, or None unless every table has one."""
        parts = [self.stored.get((n, "rollup")) for n in self.names(index)]
        return None if any(p is None for p in parts) else reduce(DataFrame.unionByName, parts)


def looked_up_by(column: str, **more: str) -> dict[str, str]:
    """File options with which a look-up of one value skips the row groups that don't have it (Bloom filters)."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true", **more}


def stored_rows(rows: DataFrame, model: Model, day: str = DAY) -> tuple[DataFrame, str, dict]:
    """Rows as a batch writes them: in folders by day, sorted by time within files, ids with Bloom filters."""
    return rows.sortWithinPartitions(day, model.timestamp.name), day, looked_up_by(model.id.name) if model.id else {}


def stored_lists(lists: DataFrame) -> tuple[DataFrame, str, dict]:
    """Lists by day, words of a column side by side in files; they come in ranges of spans, so few files have a day."""
    return lists.sortWithinPartitions("day", "column", "word_hash", "span"), "day", looked_up_by("word_hash")


def stored_rollup(counts: DataFrame) -> tuple[DataFrame, str, dict]:
    return counts.hint("rebalance", "day"), "day", {}


class Store:
    """Tables of logs under a folder: rows, word lists and rollup by day, and what their columns mean.

    Each append is a batch of all three, which is seen whole or not at all; counts of the same five minutes are
    added up when read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _roles(self, name: str) -> Commits:
        return Commits(self.spark, f"{self.path}/{name}/_model")

    def batches(self, name: str) -> Batches:
        return Batches(self.spark, f"{self.path}/{name}")

    def names(self) -> list[str]:
        return [n for n in listed(self.spark, self.path) if self._roles(n).names()]

    def exists(self, name: str) -> bool:
        return bool(self._roles(name).names())

    def drop(self, name: str) -> None:
        files, path = files_of(self.spark, f"{self.path}/{name}")
        files.delete(path, True)

    def create(self, name: str, df: DataFrame, model: Model, batch: str = "first") -> None:
        """A new table with these rows; the model's timestamp decides their day."""
        roles = {"id": model.id.name if model.id else None, "timestamp": model.timestamp.name, "full_text": [f.name for f in model.full_text]}
        if not self._roles(name).add("roles", roles):
            raise ValueError(f"there is a table {name}")
        self.append(name, df, model, batch)

    def append(self, name: str, df: DataFrame, model: Model, batch: str | None = None) -> bool:
        """Adds rows. An append that failed is repeated under its batch's name; if it had succeeded nothing is
        added, and the answer is False."""
        tables = {"rows": stored_rows(df.withColumn(DAY, day_of(nanoseconds(model.timestamp))), model), "rollup": stored_rollup(build_rollup(df, model.timestamp))}
        if model.full_text:
            tables[index_name("lists")] = stored_lists(fulltext.lists_of_rows(df, model))
        return self.batches(name).write(batch or uuid.uuid4().hex, tables)

    def compact(self, name: str) -> bool:
        """Merges the table's batches; what was read before goes on reading."""
        model = self.catalog("").tables[name][1]
        return self.batches(name).merge({"rows": lambda d: stored_rows(d.hint("rebalance", DAY), model), "rollup": lambda d: stored_rollup(merge_rollup(d)), index_name("lists"): lambda d: stored_lists(fulltext.merge_lists(d))})

    def clear(self, name: str, older_than: float = 86_400.0) -> list[str]:
        """Deletes what compaction replaced so many seconds ago or earlier."""
        return self.batches(name).clear(older_than)

    def catalog(self, prefix: str = "logs_") -> Catalog:
        """All tables as they are now."""
        found = Catalog(prefix)
        for name in self.names():
            batches = self.batches(name)
            live = batches.live()
            rows, rollup, lists = (batches.read(t, live) for t in ("rows", "rollup", index_name("lists")))
            if rows is not None:
                roles = self._roles(name).read("roles")
                found.add(name, rows, Model.of(rows, id=roles["id"], timestamp=roles["timestamp"], full_text=tuple(roles["full_text"])), lists=lists, rollup=merge_rollup(rollup))
        return found
