"""The search API: search, msearch, mget and field capabilities over a catalog of tables."""

from __future__ import annotations

import datetime
import time
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import interval_ns
from .model import Model, in_time, nanoseconds
from .operators import hits, histograms
from .operators.histograms import MS
from .plans.request import Histogram, Plan, Request, time_range_only
from .sources.catalog import Catalog, UnknownTable


def docvalue(model: Model, name: str):
    """A field as a hit's `fields` show it: days and times as text, others as they are."""
    f = model.fields[name]
    if f.timestamp:
        ns = nanoseconds(f)
        whole = F.date_format(F.timestamp_seconds(F.call_function("div", ns, F.lit(10**9))), "yyyy-MM-dd HH:mm:ss")
        return F.concat(whole, F.lit("."), F.lpad(F.pmod(ns, F.lit(10**9)).cast("string"), 9, "0"))
    if isinstance(f.type, T.DateType):
        return F.date_format(name, "yyyy-MM-dd")
    return F.col(name)


def _plain(value: object) -> object:
    """A value as JSON has it."""
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return float(value) if isinstance(value, Decimal) else value


def sort_values(values: list) -> list:
    """The values that a hit was sorted by, all of the first one's kind, as far as they can be."""
    first = next((v for v in values if v is not None), None)
    kind = str if isinstance(first, str) else float if isinstance(first, float) else int if isinstance(first, int) and not isinstance(first, bool) else None
    if kind is None:
        return values
    try:
        return [v if v is None else kind(v) for v in values]
    except ValueError:
        return values


MOST_WANTED = 1 << 17  # rows beyond which a page isn't sought among the newest ones any more


class TooManyBuckets(ValueError):
    pass


class Engine:
    """Answers request bodies. Only the page of hits and a stated number of buckets come to the driver."""

    def __init__(self, catalog: Catalog, most_buckets: int = 65_536):
        self.catalog, self.most_buckets = catalog, most_buckets

    def plan(self, index: str) -> Plan:
        return Plan(self.catalog.read(index), self.catalog.model(index), self.catalog.indexes(index))

    def _stored_histogram(self, index: str, query: dict | None, spec: Histogram) -> DataFrame | None:
        """A histogram from the stored rollup, where that gives the same."""
        model, rollup = self.catalog.model(index), self.catalog.rollup(index)
        if rollup is None or spec.filters or not model.fields[spec.field].timestamp or not histograms.fits_rollup(spec.interval):
            return None
        bounds = time_range_only(query, model)
        return None if bounds is None else histograms.histogram_from_rollup(rollup, self.catalog.read(index), model.timestamp, spec.interval, *bounds)

    def histogram(self, index: str, body: dict, name: str) -> DataFrame:
        """One date histogram's buckets; from the stored rollup where that gives the same."""
        request = Request.of(body, self.catalog.model(index))
        found = self._stored_histogram(index, request.query, request.histograms[name])
        return self.plan(index).histogram(request, name) if found is None else found

    def hits(self, index: str, body: dict, since: int | None = None) -> DataFrame:
        """The page of rows, with _table. since: leaves out rows before these nanoseconds."""
        plan = self.plan(index)
        request = Request.of(body, plan.model)
        rows, _ = plan.rows(request.query)
        if since is not None:
            rows = rows.where(in_time(plan.model.timestamp, ">=", since))
        return self._shown(hits.top(rows, plan.model, request.sort, request.size), plan.model)

    @staticmethod
    def _shown(rows: DataFrame, model: Model) -> DataFrame:
        return rows.select(*[c for c in [*model.fields, "_table"] if c in rows.columns])

    def page(self, index: str, body: dict, extra: tuple[Column, ...] = ()) -> list[Row]:
        """The page's rows. Of one sorted by newest first, only the newest rows are read, as many as the stored
        rollup says hold it if most match; where too few do, sixteen times as many, until the page is full."""
        request, model = Request.of(body, self.catalog.model(index)), self.catalog.model(index)
        rollup = self.catalog.rollup(index)
        if rollup is not None and model.timestamp and request.sort[:1] == [(model.timestamp.name, True)]:
            high = self.plan(index).conditions(request.query)[2][1]
            want = 2 * request.size
            while want <= MOST_WANTED and (since := hits.newest_bound(rollup, high, want)) is not None:
                rows = self.hits(index, body, since).select("*", *extra).collect()
                if len(rows) == request.size:
                    return rows
                want *= 16
        return self.hits(index, body).select("*", *extra).collect()

    def _counts(self, index: str, requests: list[Request]) -> list[dict[str, list[dict]]]:
        """The aggregations of several requests, each a list of buckets: {bucket, doc_count, clauses' counts}. What
        needs the rows is counted in one scan of them, and all comes in one job."""
        plan = self.plan(index)
        asked, stored, parts = [], [], []
        for n, request in enumerate(requests):
            for name, spec in request.histograms.items():
                found = self._stored_histogram(index, request.query, spec)
                if found is None:
                    asked.append((n, name, request.query, spec, spec.clauses()))
                else:
                    stored.append((n, name))
                    parts.append(found.select(F.lit(-len(stored)).alias("asked"), F.col("key").alias("bucket"), "doc_count"))
            asked += [(n, name, request.query, None, some) for name, some in request.filters.items()]
        if asked:
            parts.append(plan.counted([a[2:] for a in asked]))
        out: list[dict[str, list[dict]]] = [{} for _ in requests]
        if not parts:
            return out
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).limit(self.most_buckets + 1).collect()
        if len(rows) > self.most_buckets:
            raise TooManyBuckets(f"there are more than {self.most_buckets} buckets")
        for n, name, _, spec, clauses in asked:
            out[n][name] = [] if spec else [{"bucket": 0, "doc_count": 0, **dict.fromkeys(clauses, 0)}]
        for n, name in stored:
            out[n][name] = []
        for r in rows:
            if r.asked < 0:
                n, name = stored[-r.asked - 1]
                out[n][name].append({"bucket": r.bucket, "doc_count": r.doc_count})
                continue
            n, name, _, spec, clauses = asked[r.asked]
            counts = {"doc_count": r.doc_count, **{c: r[f"f{i}"] for i, c in enumerate(clauses)}}
            if spec is None:
                out[n][name] = [{"bucket": 0, **counts}]
            else:
                out[n][name].append({"bucket": int(r.bucket * interval_ns(spec.interval) / MS) if r.bucket < 0 else r.bucket * interval_ns(spec.interval) // MS, **counts})
        return out

    def search(self, index: str, body: dict, matched: bool = False) -> dict:
        """The response to one body. matched: also count all matching rows."""
        return self._responses(index, [body], matched)[0]

    def _responses(self, index: str, bodies: list[dict], matched: bool = False) -> list[dict]:
        """Responses to bodies that ask one index."""
        if index == "_all":
            return [{"hits": {"total": 0}} for _ in bodies]
        began, model, tables = time.monotonic(), self.catalog.model(index), len(self.catalog.names(index))
        requests = [Request.of(body, model) for body in bodies]
        out = []
        for body, request, counts in zip(bodies, requests, self._counts(index, requests)):
            aggregations, total = {}, 0
            for name, spec in request.histograms.items():
                rows = sorted(counts[name], key=lambda r: r["bucket"])
                total = sum(r["doc_count"] for r in rows)
                aggregations[name] = {"buckets": [self._bucket(r, spec.filters) for r in rows]}
            for name, some in request.filters.items():
                aggregations[name] = {"buckets": {k: {"doc_count": counts[name][0][k]} for k in some}}
            page = []
            if request.size:
                extra = [docvalue(model, n).alias(f"_field_{n}") for n in request.docvalue_fields]
                page = [self._hit(index, r.asDict(), model, request) for r in self.page(index, body, tuple(extra))]
                total = len(page)
            one = {"timed_out": False, "took": round(1000 * (time.monotonic() - began)), "_shards": {"total": tables, "successful": tables, "failed": 0}, "hits": {"total": total, "max_score": 0, "hits": page}, "status": 200}
            plan = self.plan(index)
            rows, _ = plan.rows(request.query)
            if matched:
                one["hits"]["matched"] = rows.count()
            if aggregations:
                one["aggregations"] = aggregations
            if warnings := request.warnings + plan.warnings:
                one["_debug"] = {"warnings": "; ".join(warnings)}
            out.append(one)
        return out

    @staticmethod
    def _bucket(row: dict, filters: dict[str, dict]) -> dict:
        subs = {sub: {"buckets": {k: {"doc_count": row[f"{sub}.{k}"]} for k in some}} for sub, some in filters.items()}
        at = datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=row["bucket"])
        return {**subs, "doc_count": row["doc_count"], "key_as_string": at.strftime("%a %b %e %H:%M:%S UTC %Y"), "key": row["bucket"]}

    @staticmethod
    def _hit(index: str, row: dict, model: Model, request: Request) -> dict:
        source = {k: _plain(v) for k, v in row.items() if not k.startswith("_field_") and k != "_table"}
        out = {"_index": index, "_version": 1, "_id": str(row[model.id.name]) if model.id else "", "_type": row.get("_table", index), "_score": 1, "found": True, "_source": source}
        if request.sort:
            out["sort"] = sort_values([source.get(n) for n, _ in request.sort])
        if request.docvalue_fields:
            out["fields"] = {n: [_plain(row[f"_field_{n}"])] for n in request.docvalue_fields}
        return out

    def msearch(self, requests: list[tuple[str, dict]]) -> dict:
        """Responses to several bodies, in their order; those that ask one index share a scan."""
        found: dict[int, dict] = {}
        for index in dict.fromkeys(i for i, _ in requests):
            at = [n for n, (i, _) in enumerate(requests) if i == index]
            found |= dict(zip(at, self._responses(index, [requests[n][1] for n in at])))
        return {"responses": [found[n] for n in range(len(requests))]}

    def aggregations(self, index: str, body: dict) -> dict:
        """A response with nothing but the aggregations."""
        return {"aggregations": self.search(index, {**body, "size": 0}).get("aggregations", {})}

    def documents(self, index: str, ids: list) -> DataFrame:
        """Of each id the row of the newest time; of rows of one time always the same."""
        df, model = self.catalog.read(index), self.catalog.model(index)
        good = []
        for x in ids:
            try:
                good.append(model.id.value(x))
            except ValueError:
                continue
        rows = self._shown(df.where(F.col(model.id.name).isin(good) if good else F.lit(False)), model)
        order = F.struct(*([F.col(model.timestamp.name)] if model.timestamp else []), F.xxhash64(*rows.columns))
        one = rows.groupBy(F.col(model.id.name).alias("_one")).agg(F.max_by(F.struct(*rows.columns), order).alias("row"))
        return one.select("row.*")

    def mget(self, index: str, ids: list) -> dict:
        """The documents with the ids, in the order in which they were asked."""
        model = self.catalog.model(index)
        found = {str(r[model.id.name]): r.asDict() for r in self.documents(index, ids).collect()}
        return {"docs": [self._hit(index, found[i], model, Request()) for i in dict.fromkeys(map(str, ids)) if i in found]}

    def field_caps(self, index: str) -> dict:
        """Types of the index's fields, and whether they can be searched and aggregated."""
        try:
            model = self.catalog.model(index)
        except UnknownTable:
            reason = {"type": "index_not_found_exception", "reason": "no such index", "resource.type": "index_or_alias", "resource.id": index, "index_uuid": "_na_", "index": index}
            return {"error": {"root_cause": [reason], **reason}, "status": 404}
        caps = lambda t, s, a: {t: {"type": t, "searchable": s, "aggregatable": a}}
        meta = {"_index": caps("_index", True, True), "_type": caps("_type", True, True), "_source": caps("_source", False, False), "_id": caps("_id", True, True)}
        return {"fields": meta | {f.name: caps(f.caps, True, f.caps != "text") for f in model.fields.values()}}
