"""Search request bodies, and the DataFrame plans that they stand for."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import field_name, interval_ns
from ..model import Model, nanoseconds
from ..operators import fulltext, histograms
from ..operators import predicates as P
from . import querystring

BOUNDS = ("gt", "gte", "lt", "lte")
SECTIONS = ("must", "must_not", "filter", "should")


def section(spec: dict, name: str) -> list:
    """The clauses of a bool's section, which may be a single one."""
    value = spec.get(name) or []
    return value if isinstance(value, list) else [value]


@dataclass
class Histogram:
    field: str
    interval: str
    filters: dict[str, dict[str, dict]] = field(default_factory=dict)  # sub-aggregation: name: clause

    def clauses(self) -> dict[str, dict]:
        return {f"{sub}.{k}": c for sub, some in self.filters.items() for k, c in some.items()}


@dataclass
class Request:
    """What a body asks for. warnings: what was left out and why."""

    index: str | None = None
    size: int = 0
    sort: list[tuple[str, bool]] = field(default_factory=list)
    docvalue_fields: list[str] = field(default_factory=list)
    query: dict | None = None
    histograms: dict[str, Histogram] = field(default_factory=dict)
    filters: dict[str, dict[str, dict]] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, body: dict, model: Model | None = None) -> Request:
        if not isinstance(body, dict):
            raise ValueError("a request body is an object")
        out = cls()
        if "index" in body:
            index = body["index"]
            out.index = (index[0] if index else None) if isinstance(index, list) else index
            return out
        size = body.get("size")
        out.size = size if isinstance(size, int) and not isinstance(size, bool) and size > 0 else 0
        if model is None:
            return out
        for entry in body.get("sort") or []:
            name, how = next(iter(entry.items())) if isinstance(entry, dict) else (entry, {})
            name, how = field_name(name), how.get("order", "asc") if isinstance(how, dict) else str(how)
            if name in model.fields:
                out.sort.append((name, how.lower() == "desc"))
            else:
                out.warnings.append(f"sort: no field {name}")
        for entry in body.get("docvalue_fields") or []:
            out.docvalue_fields.append(field_name(entry["field"] if isinstance(entry, dict) else entry))
        out.query = body.get("query")
        for name, agg in (body.get("aggs") or body.get("aggregations") or {}).items():
            out._aggregation(name, agg, model)
        return out

    def _aggregation(self, name: str, agg: dict, model: Model) -> None:
        subs = agg.get("aggs") or agg.get("aggregations") or {}
        if "date_histogram" in agg:
            spec = agg["date_histogram"]
            at = field_name(spec.get("field", ""))
            if at not in model.fields:
                self.warnings.append(f"{name}: no field {at}")
                return
            interval_ns(spec.get("interval"))
            if bad := [k for k, s in subs.items() if "filters" not in s]:
                raise ValueError(f"{name}: only filters can be inside a date histogram, not {bad}")
            self.histograms[name] = Histogram(at, spec["interval"], {k: s["filters"]["filters"] for k, s in subs.items()})
        elif "filters" in agg:
            if subs:
                raise ValueError(f"{name}: nothing can be inside filters")
            self.filters[name] = agg["filters"]["filters"]
        else:
            self.warnings.append(f"{name}: unknown aggregation {sorted(agg)}")


class Plan:
    """The rows that requests' queries select from a table, with their text clauses as one join.

    Each text clause becomes a flag: whether the row's time is one at which the index has all words. Any place in
    a condition, or in a filter's count, can use it; the index is read once for all of them. A query that is one
    text clause, or has one among its must or filter clauses, is a left-semi join instead, unless the flag is used
    elsewhere too.
    """

    def __init__(self, df: DataFrame, model: Model, indexes: list[fulltext.Index] | None = None):
        """indexes: what text clauses are looked up in; if none are given, the rows themselves."""
        self.df, self.model = df, model
        self.indexes = indexes or [fulltext.Rows(df, model)]
        self.texts: list[fulltext.Text] = []
        self.warnings: list[str] = []
        self.low: int | None = None
        self.high: int | None = None

    def search(self, f, text: str) -> str:
        """The condition, in SQL, of a text on an indexed field."""
        clause = fulltext.Text.of(f, text)
        if not clause.words or self.model.timestamp is None:
            return "false"
        if clause not in self.texts:
            self.texts.append(clause)
        return f"(_text{self.texts.index(clause)} and {clause.recheck()})"

    def clause(self, body: object, top: bool = False) -> Column | None:
        """A clause's condition; None adds none. Of the top level, a range of times also bounds the index."""
        if not isinstance(body, dict) or len(body) != 1:
            self.warnings.append(f"not a clause: {body!r}")
            return None
        (kind, spec), = body.items()
        make = getattr(self, f"_{kind}", None) if kind in ("match_all", "match_phrase", "range", "exists", "terms", "term", "query_string", "bool") else None
        if make is None or not isinstance(spec, dict):
            self.warnings.append(f"unknown clause: {kind}")
            return None
        return make(spec, top)

    def _field(self, name: str, kind: str):
        f = self.model.fields.get(field_name(name))
        if f is None:
            self.warnings.append(f"{kind}: no field {name}")
        return f

    def _match_all(self, spec: dict, top: bool) -> None:
        return None

    def _match_phrase(self, spec: dict, top: bool) -> Column | None:
        clauses = []
        for name, value in spec.items():
            if f := self._field(name, "match_phrase"):
                clauses.append(P.match(f, value.get("query") if isinstance(value, dict) else value))
        return P.all_of(clauses)

    def _range(self, spec: dict, top: bool) -> Column | None:
        clauses = []
        for name, bounds in spec.items():
            f = self._field(name, "range")
            if f is None:
                continue
            given = {k: bounds[k] for k in BOUNDS if bounds.get(k) is not None}
            if any(isinstance(v, str) and v.startswith("now") or "||" in str(v) for v in given.values()):
                raise ValueError("date arithmetic isn't supported in ranges")
            clauses.append(P.between(f, **given, format=bounds.get("format")))
            if top and f.timestamp:
                for k, v in given.items():
                    ns = P.point_ns(v, bounds.get("format"))
                    if k in ("gt", "gte"):
                        self.low = max(self.low, ns) if self.low is not None else ns
                    else:
                        self.high = min(self.high, ns) if self.high is not None else ns
        return P.all_of(clauses)

    def _exists(self, spec: dict, top: bool) -> Column | None:
        f = self._field(spec.get("field", ""), "exists")
        return P.exists(f) if f else None

    def _terms(self, spec: dict, top: bool) -> Column | None:
        found = [(self._field(name, "terms"), values) for name, values in spec.items() if name not in ("boost",)]
        return P.all_of(P.terms(f, values) for f, values in found if f)

    _term = _terms

    def _query_string(self, spec: dict, top: bool) -> Column | None:
        try:
            return querystring.Line(str(spec.get("query", "")), self.model, self.search, bool(spec.get("analyze_wildcard"))).column()
        except querystring.UnknownField as e:
            self.warnings.append(f"query_string: no field {e}; the clause is left out")
            return None

    def _bool(self, spec: dict, top: bool) -> Column | None:
        parts = {k: [self.clause(c, top and k in ("must", "filter")) for c in section(spec, k)] for k in SECTIONS}
        least = spec.get("minimum_should_match") or 0
        return P.boolean(**parts, minimum_should_match=least if isinstance(least, int) and any(parts[k] for k in ("must", "must_not", "filter")) else 0)

    def conditions(self, query: dict | None, columns: dict[str, dict] | None = None) -> tuple[Column | None, dict[str, Column], tuple[int | None, int | None]]:
        """A query's condition, those of named clauses, and the bounds that the query sets to the timestamp."""
        self.low = self.high = None
        where = self.clause(query, top=True) if query else None
        bounds = self.low, self.high
        return where, {name: P.true(c) if (c := self.clause(body)) is not None else F.lit(True) for name, body in (columns or {}).items()}, bounds

    def frame(self, bounds: list[tuple[int | None, int | None]], alone: bool = False) -> DataFrame:
        """The table with the flags of all text clauses that conditions have been made of, looked up within the
        widest bounds. alone: rows without the only text may be left out."""
        if not self.texts:
            return self.df
        low, high = (None if any(b[k] is None for b in bounds) else pick(b[k] for b in bounds) for k, pick in ((0, min), (1, max)))
        names = [f"_text{i}" for i in range(len(self.texts))]
        times, ts = fulltext.matching(self.indexes, self.texts, names, low, high), nanoseconds(self.model.timestamp)
        if alone and len(names) == 1:
            return fulltext.semi(self.df.withColumn(names[0], F.lit(True)), ts, times)
        return fulltext.flagged(self.df, ts, times, names)

    def rows(self, query: dict | None, columns: dict[str, dict] | None = None) -> tuple[DataFrame, dict[str, Column]]:
        """The selected rows, and the conditions of the named clauses on them."""
        try:
            where, named, bounds = self.conditions(query, columns)
            out = self.frame([bounds], alone=not columns and only_conjunct(query))
            return (out if where is None else out.where(where)), named
        except ParseException as e:
            raise querystring.QuerySyntaxError("not a search line") from e

    def histogram(self, request: Request, name: str) -> DataFrame:
        """key, doc_count and a column for each filter, named 'sub.filter'."""
        spec = request.histograms[name]
        rows, named = self.rows(request.query, spec.clauses())
        return histograms.date_histogram(rows, self.model.fields[spec.field], spec.interval, named)

    def filter_counts(self, request: Request, name: str) -> DataFrame:
        rows, named = self.rows(request.query, request.filters[name])
        return histograms.filters(rows, named)

    def counted(self, asked: list[tuple[dict | None, Histogram | None, dict[str, dict]]]) -> DataFrame:
        """asked, bucket, doc_count, f0, f1...: the aggregations of several requests over one scan. Each is a query,
        a histogram or none (one bucket of all), and the clauses that are counted beside."""
        try:
            found = [(*self.conditions(query, clauses), spec) for query, spec, clauses in asked]
            df = self.frame([bounds for _, _, bounds, _ in found])
            wide = max(len(named) for _, named, _, _ in found)
            if all(where is not None for where, *_ in found):
                df = df.where(P.any_of(where for where, *_ in found))
        except ParseException as e:
            raise querystring.QuerySyntaxError("not a search line") from e
        entries = []
        for k, (where, named, _, spec) in enumerate(found):
            at = F.lit(0).cast("long") if spec is None else histograms.bucket(nanoseconds(self.model.fields[spec.field]), interval_ns(spec.interval))
            flags = [*named.values(), *[F.lit(False)] * (wide - len(named))]
            entry = F.struct(F.lit(k).alias("asked"), at.alias("bucket"), *[c.alias(f"f{i}") for i, c in enumerate(flags)])
            entries.append(F.when((F.lit(True) if where is None else P.true(where)) & at.isNotNull(), entry))
        rows = df.select(F.inline(F.array_compact(F.array(*entries))))
        return rows.groupBy("asked", "bucket").agg(F.count("*").alias("doc_count"), *[F.count_if(f"f{i}").alias(f"f{i}") for i in range(wide)])


def only_conjunct(query: dict | None) -> bool:
    """Whether a text clause of the query can only be a conjunct of the whole condition: it is the query, or
    in must or filter lists all the way down."""
    if not isinstance(query, dict) or len(query) != 1:
        return False
    (kind, spec), = query.items()
    if kind == "query_string":
        text = str(spec.get("query", ""))
        return len(querystring.parts(text)) == 3 and querystring.parts(text)[1] == ":"
    if kind != "bool":
        return True
    lists = {k: section(spec, k) for k in SECTIONS}
    plain = all("query_string" not in str(c) for k in ("must_not", "should") for c in lists[k])
    return plain and all(only_conjunct(c) for k in ("must", "filter") for c in lists[k])


def time_range_only(query: dict | None, model: Model) -> tuple[int | None, int | None] | None:
    """(low, high) with low <= ns < high if a query is nothing but such a range of the timestamp."""
    if not query:
        return None, None
    if "bool" in query and set(query["bool"]) <= {"must", "filter"}:
        some = [c for k in ("must", "filter") for c in section(query["bool"], k) if c != {"match_all": {}}]
        return time_range_only(some[0], model) if len(some) == 1 else (None, None) if not some else None
    if query == {"match_all": {}}:
        return None, None
    if set(query) != {"range"} or len(query["range"]) != 1:
        return None
    (name, bounds), = query["range"].items()
    f = model.fields.get(field_name(name))
    if f is None or not f.timestamp:
        return None
    point = {k: P.point_ns(bounds[k], bounds.get("format")) for k in BOUNDS if bounds.get(k) is not None}
    low = [point[k] + (k == "gt") for k in ("gt", "gte") if k in point]
    high = [point[k] + (k == "lte") for k in ("lt", "lte") if k in point]
    return max(low, default=None), min(high, default=None)
