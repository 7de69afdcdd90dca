"""Stored tables: batches of all tables or none, readers beside compaction, what a search or look-up reads; settings."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from logloom.engine import Engine
from logloom.functions.text import tokens
from logloom.model import DAY, Model, nanoseconds
from logloom.operators import fulltext, histograms
from logloom.sources import settings as settings_
from logloom.sources.batches import Batches, Commits
from logloom.sources.catalog import Catalog, Store, looked_up_by
from logloom.sources.settings import FIELDS, Settings
from logloom.streaming import ingest

START = datetime.datetime(2024, 5, 1, 22)


@pytest.fixture(scope="module")
def visits(spark):
    """600 visits in three days, two of which may share a time."""
    rows = [(i * 37 % 600, START + datetime.timedelta(seconds=280 * (i - i % 2)), ["in", "out", "back"][i % 3], f"gate {i % 4} lane_{i % 9}", "night" if i % 5 else "day shift") for i in range(600)]
    df = spark.createDataFrame(rows, "visit long, at timestamp_ntz, kind string, place string, shift string")
    return df, Model.of(df, id="visit", timestamp="at", full_text=("place", "shift"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, *columns):
    """The scans of a plan that read all of the columns."""
    return [line for line in plan_of(df).splitlines() if "FileScan" in line and all(c in line.split("ReadSchema")[-1] for c in columns)]


def ids(df):
    return sorted(r.visit for r in df.collect())


def test_store(spark, visits, tmp_path):
    """Tables outlive the catalog, and say what there is of them."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    assert store.names() == []
    store.create("logs_v", df.where("visit < 400"), model)
    assert store.append("logs_v", df.where("visit >= 400"), model, "rest") and not store.append("logs_v", df, model, "rest")
    store.create("logs_x", df.limit(0), model)
    assert store.catalog().read("logs_x").count() == 0
    store.drop("logs_x")
    with pytest.raises(ValueError):
        store.create("logs_v", df, model)
    again = Store(spark, str(tmp_path))
    assert again.names() == ["logs_v"] and again.exists("logs_v") and not again.exists("logs_x")
    found = again.catalog()
    assert set(found.model("logs_v").fields) == set(df.columns) and ids(found.read("logs_v")) == list(range(600))
    assert sorted(fulltext.postings_of(found.stored["logs_v", "lists"]).collect()) == sorted(fulltext.build_postings(df, model).collect())
    assert sorted(found.rollup("logs_v").collect()) == sorted(histograms.build_rollup(df, model.timestamp).collect())
    with pytest.raises(ValueError):  # a column of another type
        again.append("logs_v", df.withColumn("kind", F.lit(1)), model)
    wide = df.limit(1).withColumn("visit", F.lit(7000).cast("long")).withColumn("guard", F.lit("g"))
    again.append("logs_v", wide, model)
    assert [r.guard for r in again.catalog().read("logs_v").where("visit = 7000 or visit = 3").orderBy("visit").collect()] == [None, "g"]


@pytest.mark.parametrize("bounds", [{"gte": "2024-05-02T00:00:00", "lt": "2024-05-03T00:00:00"}, {"gt": "2024-05-01T23:59:59.999999", "lte": "2024-05-02T23:59:59"}, {"lte": 1714608000000, "format": "epoch_millis"}, {"lt": 1714608000000000000}, {"gte": 1714694400000000001}])
def test_days_are_pruned(spark, visits, tmp_path, bounds):
    """A range of times reads its days alone, in any place of a query, and selects what it did."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df, model)
    plain = Catalog()
    plain.add("logs_v", df, model)
    clause = {"range": {"at": bounds}}
    for query in (clause, {"bool": {"must_not": clause}}, {"bool": {"should": [clause, {"match_phrase": {"kind": "in"}}]}}):
        rows, _ = Engine(store.catalog()).plan("logs_v").rows(query)
        assert ids(rows) == ids(Engine(plain).plan("logs_v").rows(query)[0])
        if query is clause:
            (scan,) = scans(rows, "kind")
            assert f"PartitionFilters: [isnotnull({DAY}" in scan
            days = {r._day for r in rows.select(DAY).distinct().collect()}
            assert days <= {datetime.date(2024, 5, d) for d in (1, 2, 3)} and len(days) < 3


def test_a_point_in_time_is_of_one_day(spark, visits, tmp_path):
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df, model)
    at = START + datetime.timedelta(seconds=280 * 40)
    rows, _ = Engine(store.catalog()).plan("logs_v").rows({"match_phrase": {"at": at.isoformat()}})
    assert rows.count() == 2 and DAY in scans(rows, "kind")[0].split("PartitionFilters: ")[1].split("DataFilters")[0].split("PushedFilters")[0]


def test_tables_with_and_without_days_together(spark, visits, tmp_path):
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df.where("visit < 300"), model)
    catalog = store.catalog()
    catalog.add("logs_v_raw", df.where("visit >= 300"), model)
    query = {"range": {"at": {"gte": "2024-05-02T00:00:00"}}}
    assert ids(Engine(catalog).plan("logs_v").rows(query)[0]) == ids(df.where("at >= timestamp_ntz'2024-05-02 00:00:00'"))
    text = {"bool": {"must": [query, {"query_string": {"query": 'place:"gate lane_3" or shift:day'}}]}}
    whole = Catalog()
    whole.add("logs_v", df, model)
    assert ids(Engine(catalog).plan("logs_v").rows(text)[0]) == ids(Engine(whole).plan("logs_v").rows(text)[0])


@pytest.mark.parametrize("table", ["rows", "rollup", "index_lists", "commit"])
def test_an_append_that_fails_is_repeated(spark, visits, tmp_path, monkeypatch, table):
    """Wherever a batch fails, none of it is seen, and its second try leaves each table right."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df.where("visit < 200"), model)
    put, add, failed = Batches._put, Commits.add, []

    def breaks(self, name, batch, *part):
        if name == table and not failed:
            failed.append(put(self, name, batch, part[0].limit(5), *part[1:]))
            raise OSError("gone")
        put(self, name, batch, *part)

    def lost(self, name, content):
        if table == "commit" and name == "two" and not failed:
            failed.append(1)
            raise OSError("gone")
        return add(self, name, content)

    monkeypatch.setattr(Batches, "_put", breaks)
    monkeypatch.setattr(Commits, "add", lost)

    def state():
        c = store.catalog()
        return tuple(sorted(map(tuple, d.collect())) for d in (c.read("logs_v").select("visit"), c.rollup("logs_v"), fulltext.postings_of(c.stored["logs_v", "lists"])))

    before = state()
    with pytest.raises(OSError):
        store.append("logs_v", df.where("visit >= 200"), model, "two")
    assert state() == before
    assert store.append("logs_v", df.where("visit >= 200"), model, "two") and not store.append("logs_v", df.where("visit >= 200"), model, "two")
    rows, rollup, postings = state()
    assert rows == [(i,) for i in range(600)] and sum(n for *_, n in rollup) == 600
    assert postings == sorted(map(tuple, fulltext.build_postings(df, model).collect()))


def test_readers_go_on_beside_compaction(spark, visits, tmp_path):
    """What was planned before tables are merged reads as before, until the old files are cleared away."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df.where("visit < 100"), model)
    for k in range(1, 4):
        store.append("logs_v", df.where(f"visit >= {100 * k} and visit < {100 * k + 100}"), model, f"b{k}")
    before = store.catalog()
    planned = [before.read("logs_v").select("visit"), before.rollup("logs_v"), Engine(before).plan("logs_v").rows({"query_string": {"query": "place:lane_3"}})[0].select("visit")]
    assert store.compact("logs_v") and not store.compact("logs_v")
    store.append("logs_v", df.where("visit >= 400"), model, "b4")
    counts = [d.count() for d in planned]
    assert counts[0] == 400 and planned[1].agg(F.sum("count")).first()[0] == 400
    assert not store.append("logs_v", df, model, "b2")  # still known, though merged
    after = store.catalog()
    assert ids(after.read("logs_v")) == list(range(600)) and after.rollup("logs_v").agg(F.sum("count")).first()[0] == 600
    assert sorted(fulltext.postings_of(after.stored["logs_v", "lists"]).collect()) == sorted(fulltext.build_postings(df, model).collect())
    assert store.clear("logs_v") == [] and store.clear("logs_v", older_than=0) == ["b1", "b2", "b3", "first"]
    assert ids(store.catalog().read("logs_v")) == list(range(600)) and store.compact("logs_v") and ids(store.catalog().read("logs_v")) == list(range(600))


def test_of_two_merges_one_counts(spark, visits, tmp_path, monkeypatch):
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df.where("visit < 300"), model)
    store.append("logs_v", df.where("visit >= 300"), model)
    put, other = Batches._put, []

    def slow(self, *args):
        put(self, *args)
        if not other:  # another merge begins and ends meanwhile
            other.append(None)
            other.append(Store(spark, str(tmp_path)).compact("logs_v"))

    monkeypatch.setattr(Batches, "_put", slow)
    assert not store.compact("logs_v") and other == [None, True]
    assert ids(store.catalog().read("logs_v")) == list(range(600)) and len(store.batches("logs_v").live()) == 1


def test_text_clauses_share_a_scan_and_a_join(spark, visits, tmp_path):
    """However many texts a query has, the index is read once and joined once, by days and words' hashes."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df, model)
    plain = Catalog()
    plain.add("logs_v", df, model)
    line = 'gate or place:"gate lane_3" and not shift:"day shift" xor place:(lane_1 or lane_2)'
    for query in ({"query_string": {"query": line}}, {"query_string": {"query": "day"}}):
        rows, _ = Engine(store.catalog()).plan("logs_v").rows(query)
        assert len(scans(rows, "word_hash")) == 1 and plan_of(rows).split("== Initial")[0].count("Join") == 1
        assert ids(rows) == ids(Engine(plain).plan("logs_v").rows(query)[0]) != []
    body = {"bool": {"must": [{"query_string": {"query": 'place:"gate lane_3"'}}, {"range": {"at": {"lt": "2024-05-02T09:00:00"}}}]}}
    rows, _ = Engine(store.catalog()).plan("logs_v").rows(body)
    (scan,) = scans(rows, "word_hash")
    assert "LeftSemi" in plan_of(rows) and "In(word_hash" in scan and "PartitionFilters: [isnotnull(day" in scan
    assert ids(rows) == ids(df.where("at < timestamp_ntz'2024-05-02 09:00:00' and place rlike 'lane_3'"))


def test_words_are_sought_within_spans(spark, visits):
    """Lists and rows give the same times, whatever span lists are cut into."""
    df, model = visits
    texts = [fulltext.Text.of(model.fields["place"], "lane_3 gate"), fulltext.Text.of(model.fields["shift"], "night"), fulltext.Text.of(model.fields["place"], "nowhere")]
    lists = fulltext.build_lists(fulltext.build_postings(df, model))
    again = lists.unionByName(lists.limit(50))  # as two batches of a time may leave it
    want = sorted(map(tuple, fulltext.matching([fulltext.Rows(df, model)], texts, "abc").collect()))
    assert want and sorted(map(tuple, fulltext.matching([fulltext.Lists(again)], texts, "abc").collect())) == want
    assert {r[3] for r in want} == {False} and sorted(map(tuple, fulltext.merge_lists(again).select(*lists.columns).collect())) == sorted(map(tuple, lists.collect()))
    low, high = (int((START + datetime.timedelta(hours=h)).replace(tzinfo=datetime.timezone.utc).timestamp()) * 10**9 for h in (2, 9))
    for index in (fulltext.Rows(df, model), fulltext.Lists(lists)):
        assert sorted(map(tuple, fulltext.matching([index], texts, "abc", low, high).collect())) == [t for t in want if low <= t[0] <= high]


def test_searches_read_the_named_columns(spark, visits, tmp_path):
    df, model = visits
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    times = fulltext.matching([fulltext.Rows(read, model)], [fulltext.Text.of(model.fields["shift"], "day shift")], ["a"])
    assert times.count() > 0 and plan_of(times).split("== Initial")[0].count("FileScan") == 1 and "place" not in plan_of(times)


def test_look_ups_skip_row_groups(spark, tmp_path):
    """An id that minima and maxima do not rule out is found by Bloom filters, in fewer rows read."""
    df = spark.range(0, 40_000, 1, 1).select(F.xxhash64("id").alias("id"), F.col("id").alias("n"))
    small = {"parquet.block.size": "40000", "parquet.page.size": "4000", "parquet.enable.dictionary": "false", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}
    df.write.options(**looked_up_by("id", **small)).parquet(str(tmp_path / "bloom"))
    df.write.options(**small).parquet(str(tmp_path / "plain"))
    wanted = df.where("n = 31234").first().id

    def rows_read(name):
        found = spark.read.parquet(str(tmp_path / name)).where(F.col("id") == wanted)
        execution = found._jdf.queryExecution()
        assert [r.n for r in found.collect()] == [31234]
        rows = execution.executedPlan().executeCollect()  # so that its scan has counted
        assert len(rows) == 1
        stack = [execution.executedPlan()]
        while stack:
            node = stack.pop()
            if "Scan" in node.nodeName():
                return node.metrics().apply("numOutputRows").value()
            stack += [node.children().apply(i) for i in range(node.children().size())]

    assert rows_read("bloom") * 3 < rows_read("plain")


def test_pages_come_from_the_newest_rows(spark, visits, tmp_path, monkeypatch):
    """The stored rollup bounds what a page reads, wider where few rows match, and the page is the same."""
    df, model = visits
    store = Store(spark, str(tmp_path))
    store.create("logs_v", df, model)
    plain = Catalog()
    plain.add("logs_v", df, model)
    engine, since = Engine(store.catalog()), []
    hits = Engine.hits
    monkeypatch.setattr(Engine, "hits", lambda self, i, b, s=None: since.append(s) or hits(self, i, b, s))
    newest = [{"at": {"order": "desc"}}]
    for body, tries in (({"size": 5}, 1), ({"size": 5, "query": {"range": {"at": {"lt": "2024-05-02T00:00:00"}}}}, 1), ({"size": 7, "query": {"terms": {"visit": list(range(0, 600, 20))}}}, 2),
                        ({"size": 9, "query": {"match_phrase": {"kind": "none"}}}, 3), ({"size": 700}, 1)):
        body = {**body, "sort": newest}
        since.clear()
        page = engine.page("logs_v", body)
        assert [r.visit for r in page] == [r.visit for r in hits(Engine(plain), "logs_v", body).collect()] and len(since) == tries, body
        assert (since[-1] is None) == (len(page) < body["size"])
    body = {"size": 5, "sort": [{"at": {"order": "asc"}}]}
    assert [r.visit for r in engine.page("logs_v", body)] == [r.visit for r in hits(Engine(plain), "logs_v", body).collect()]


def test_streams(spark, visits, tmp_path):
    """A stream's tables are those of all rows at once; a batch that comes again is left alone; merging changes no rows."""
    df, model = visits
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ingest.ingest(stream, model, out, str(tmp_path / "checkpoint")).awaitTermination()
    names = Batches(spark, out).live()
    assert len(names) == 4 and len({n.rsplit("-", 1)[0] for n in names}) == 1
    same = lambda t, want: sorted(map(tuple, ingest.read(spark, out, t).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    wanted = {"rows": df.withColumn("day", F.to_date("at")), "rollup": histograms.build_rollup(df, model.timestamp), "postings": fulltext.build_postings(df, model)}
    assert all(same(t, want) for t, want in wanted.items())
    planned = ingest.read(spark, out, "rows")
    assert ingest.compact(spark, out, model) and not ingest.compact(spark, out, model)
    assert all(same(t, want) for t, want in wanted.items()) and planned.count() == 600
    stream_id = names[0].rsplit("-", 1)[0]
    assert not ingest.write_batch(df, 2, model, out, stream=f"{stream_id}-") and ingest.read(spark, out, "rows").count() == 600
    assert ingest.write_batch(df.limit(10), 2, model, out) and ingest.read(spark, out, "rows").count() == 610


def document(kind):
    """A document that has every field of its type."""
    doc = {}
    for path, column in FIELDS[kind].items():
        value = 3 if column in settings_.NUMBERS else True if column in settings_.TRUTHS else ["a", "b"] if column in settings_.LISTS else f"{column} of it"
        at, (*above, last) = doc, path.split(".")
        for part in above:
            at = at.setdefault(part, {})
        at[last] = value
    return doc


def test_settings_of_all_types(spark, tmp_path):
    store = Settings(spark, str(tmp_path))
    for kind in FIELDS:
        store.put(kind, f"of {kind}", {**document(kind), "no such field": 1})
    docs = store.mget([f"of {k}" for k in reversed(FIELDS)] + ["none"])["docs"]
    assert [(d["_type"], d["_source"]) for d in docs] == [(k, document(k)) for k in reversed(FIELDS)]
    with pytest.raises(ValueError):
        store.put("nope", "x", {})


def test_settings_change(spark, tmp_path):
    store = Settings(spark, str(tmp_path))
    assert store.read().count() == 0
    first = store.put("config", "c", {"buildNum": 1, "defaultIndex": "a"}, now_ns=50)
    second = store.put("config", "c", {"doc": {"defaultIndex": "b"}}, now_ns=20)  # a clock that is behind
    assert (first["_version"], second["_version"]) == (1, 2) and store.mget(["c"])["docs"][0]["_source"] == {"defaultIndex": "b"}
    store.put("url", None, {"url": "/u", "accessCount": "4"})
    store.delete_by_query({"query": {"match_phrase": {"type": "config"}}})
    assert [r.type for r in store.read().collect()] == ["url"] and store.log(2).count() == 3
    with pytest.raises(ValueError):
        store.delete_by_query({})


def test_the_log_of_settings_is_bounded(spark, tmp_path):
    store = Settings(spark, str(tmp_path), every=4)
    for k in range(13):
        store.put("url", f"u{k % 3}", {"url": f"/{k}"})
        folders, _ = store._kept(max(store.versions()))
        assert len(folders) <= 5
    assert {r["_id"]: r.url for r in store.read().collect()} == {"u0": "/12", "u1": "/10", "u2": "/11"}
    assert len(store.versions()) <= 10 and store.log().count() < 13


def test_two_writers_of_settings(spark, tmp_path):
    """Changes that are made at once are all kept, and one document's last one is current."""
    stores = [Settings(spark, str(tmp_path), every=5) for _ in range(2)]
    stores[0].put("url", "both", {"url": "/"})

    def write(k):
        for n in range(4):
            stores[k].put("url", f"own {k} {n}", {"url": f"/{k}/{n}"})
            stores[k].put("url", "both", {"url": f"/{k}/{n}"})

    threads = [threading.Thread(target=write, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = {r["_id"]: r.url for r in stores[0].read().collect()}
    assert set(rows) == {"both", *(f"own {k} {n}" for k in range(2) for n in range(4))} and rows["both"] in ("/0/3", "/1/3")
    assert stores[0].read().count() == len(rows)


@pytest.mark.parametrize("compact", [False, True])
def test_occurrences_of_rows_that_share_a_time(spark, visits, tmp_path, compact):
    """A word is told once for each row that holds it, within a batch and beyond it, merged or not."""
    df, model = visits
    df = df.unionByName(df.where("visit < 50")).unionByName(df.where("visit < 20").withColumn("shift", F.lit(None).cast("string")))
    for k in range(2):
        ingest.write_batch(df.where(f"visit % 3 <> {k}"), k, model, str(tmp_path))
    if compact:
        assert ingest.compact(spark, str(tmp_path), model)
    twice = df.where("visit % 3 <> 0").unionByName(df.where("visit % 3 <> 1"))
    ts = nanoseconds(model.timestamp).alias("ts")
    want = [twice.select(ts, F.lit(c).alias("column"), F.explode(tokens(F.col(c))).alias("word")) for c in ("place", "shift")]
    found = ingest.read(spark, str(tmp_path), "occurrences").select("ts", "column", "word")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want[0].unionByName(want[1]).collect()))


def test_words_are_not_shuffled_into_lists(spark, visits):
    """Only the rows move, by time; what they are split into stays there."""
    df, model = visits
    plan = plan_of(fulltext.lists_of_rows(df, model))
    assert plan.count("Exchange") == 1 and "rangepartitioning(span" in plan
