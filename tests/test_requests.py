"""Requests against a plain evaluator: clauses and search lines are drawn at random, the rows that they select compared."""

import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from logloom.functions.text import STOP_WORDS, UNITS, field_name, interval_ns, token_list, tokens
from logloom.model import Model
from logloom.plans.querystring import QuerySyntaxError, parts
from logloom.plans.request import Plan, Request, only_conjunct, time_range_only

LOANS = "loan long, lent timestamp_ntz, reader int, fee double, branch string, lost boolean, topics array<string>, remark string, title string"
COLUMNS = [c.split()[0] for c in LOANS.split(", ")]
REMARKS = ["torn cover, water stain", "TORN page 12", "stain on cover", "waters high", "no remark", "", None, "pencil_marks on page 7", "eco src"]
TITLES = ["The Water Margin", "Cover Her Face", "Marks of Identity", "page by page", None]


def loans():
    rnd = random.Random(17)
    rows = []
    for i in range(90):
        at = datetime(2021, 3, 1 + i // 30, rnd.randrange(24), rnd.choice([0, 30]), 0, rnd.choice([0, 1, 500]))
        rows.append((i, at, rnd.choice([None, 4, 7, 11, 40]), rnd.choice([None, 0.0, 1.5, 2.0, 12.25]), rnd.choice([None, "north", "North-2", "no_th", "50%", "a\\b", "it's"]),
                     rnd.choice([None, True, False]), rnd.choice([None, [], ["law"], ["law", "art"], ["art", None]]), rnd.choice(REMARKS), rnd.choice(TITLES)))
    return [dict(zip(COLUMNS, r)) for r in rows]


ROWS = loans()


@pytest.fixture(scope="module")
def library(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in ROWS], LOANS)
    return df, Model.of(df, id="loan", timestamp="lent", full_text=("remark", "title"))


def plain_words(text):
    return {w for w in re.split("[^a-z0-9_]+", (text or "").lower()) if w not in STOP_WORDS}


def held_together(column, text):
    """Loans whose own text has all words as parts, at a time whose loans together have them as words."""
    wanted = plain_words(text)
    at = {}
    for r in ROWS:
        at.setdefault(r["lent"], set()).update(plain_words(r[column]))
    return {r["loan"] for r in ROWS if wanted and wanted <= at[r["lent"]] and all(w in (r[column] or "").lower() for w in wanted)}


def picked(test):
    return {r["loan"] for r in ROWS if test(r) is True}


ALL = {r["loan"] for r in ROWS}


def draw_plain(rnd):
    """A clause without others in it, and what it selects (None: it adds no condition)."""
    kind = rnd.randrange(9)
    if kind == 0:
        value = rnd.choice([4, "7", 11.0, "eleven", 2.5])
        number = float(value) if re.fullmatch(r"[0-9.]+", str(value)) else None
        return {"match_phrase": {rnd.choice(["reader", "@reader", "reader.keyword"]): rnd.choice([value, {"query": value}])}}, picked(lambda r: r["reader"] is not None and r["reader"] == number)
    if kind == 1:
        low, high = sorted(rnd.sample([0, 1, 1.5, 2, 13], 2))
        return {"range": {"fee": {"gt": low, "lte": high}}}, picked(lambda r: r["fee"] is not None and low < r["fee"] <= high)
    if kind == 2:
        field = rnd.choice(["reader", "branch", "lost", "topics"])
        return {"exists": {"field": field}}, picked(lambda r: r[field] is not None)
    if kind == 3:
        values = rnd.sample(["north", "50%", "a\\b", "it's", "nowhere"], rnd.randrange(4))
        return {"terms": {"branch.keyword": values}}, picked(lambda r: r["branch"] in values)
    if kind == 4:
        topic = rnd.choice(["law", "art", "sea"])
        return {rnd.choice(["match_phrase", "term"]): {"topics": topic}}, picked(lambda r: r["topics"] is not None and topic in r["topics"])
    if kind == 5:
        day = rnd.randint(1, 3)
        bound = int(datetime(2021, 3, day, 12, tzinfo=timezone.utc).timestamp() * 1000)
        clause, stop = rnd.choice([({"gte": f"2021-03-0{day}T12:00:00"}, None), ({"gte": bound, "lt": bound + 36 * 10**5 * 9, "format": "epoch_millis"}, bound + 36 * 10**5 * 9), ({"gte": bound * 10**6}, None)])
        ms = lambda r: r["lent"].replace(tzinfo=timezone.utc).timestamp() * 1000
        return {"range": {"lent": clause}}, picked(lambda r: ms(r) >= bound and (stop is None or ms(r) < stop))
    if kind == 6:
        truth = rnd.choice([True, "false", 1])
        return {"term": {"lost": truth}}, picked(lambda r: r["lost"] is (truth in (True, 1)))
    if kind == 7:
        return rnd.choice([{"match_all": {}}, {"match_phrase": {"colour": "red"}}, {"regexp": {"branch": "n.*"}}, {"range": {"topics": {"gt": 1}}}]), None
    text, found = draw_line(rnd, 2)
    return {"query_string": {"query": text, "analyze_wildcard": True}}, found


def draw_clause(rnd, depth):
    if depth == 0 or rnd.random() < 0.4:
        return draw_plain(rnd)
    spec, some = {}, {}
    for part in ("must", "must_not", "filter", "should"):
        if drawn := [draw_clause(rnd, depth - 1) for _ in range(rnd.choice([0, 0, 1, 2]))]:
            bodies = [b for b, _ in drawn]
            spec[part] = bodies[0] if len(bodies) == 1 and rnd.random() < 0.5 else bodies
            some[part] = [s for _, s in drawn if s is not None]
    narrow = [*some.get("must", []), *some.get("filter", []), *[ALL - s for s in some.get("must_not", [])]]
    wide = set().union(*some["should"]) if some.get("should") else None
    return {"bool": spec}, set.intersection(*narrow) if narrow else wide


def draw_term(rnd):
    kind = rnd.randrange(6)
    if kind == 0:
        n = rnd.choice([4, 7, 40])
        return f"reader:{n}", picked(lambda r: r["reader"] == n)
    if kind == 1:
        part = rnd.choice(["orth", "no_", "0%", "'s", "\\b"])
        return f"branch:{part}", picked(lambda r: part in (r["branch"] or ""))
    if kind == 2:
        pattern, regex = rnd.choice([("n?_th", "n._th"), ("no*2", "no.*2|No.*2"), ("o_t", "o_t")])
        if pattern == "no*2":
            regex = "no.*2"
        return f"branch:{pattern}", picked(lambda r: re.search(regex, r["branch"] or "") is not None)
    if kind == 3:
        words = rnd.choice(["torn cover", "Water", "stain cover torn", "eco"])
        return f'remark:"{words}"', held_together("remark", words)
    if kind == 4:
        one, two = rnd.sample(["page", "marks", "cover", "water"], 2)
        return f"title:({one} or {two})", held_together("title", one) | held_together("title", two)
    part = rnd.choice(["rt", "lse", "tr"])
    return f"lost:{part}", picked(lambda r: r["lost"] is not None and part in str(r["lost"]).lower())


def draw_line(rnd, depth):
    """A search line with its own choice of parentheses, and what it selects: not before and before xor before or."""
    if depth == 0 or rnd.random() < 0.3:
        return draw_term(rnd)

    def level(names, inner):
        text, found = inner()
        while rnd.random() < 0.35:
            name = rnd.choice(names)
            more, other = inner()
            text = f"{text} {name} {more}"
            found = {"or": found | other, "xor": found ^ other, "and": found & other, "": found & other}[name.lower()]
        return text, found

    def atom():
        text, found = draw_term(rnd) if rnd.random() < 0.7 else (lambda t, s: (f"({t})", s))(*draw_line(rnd, depth - 1))
        return (f"not {text}", ALL - found) if rnd.random() < 0.25 else (text, found)

    return level(["or", "OR"], lambda: level(["xor", "XOR"], lambda: level(["and", "AND", ""], atom)))


@pytest.mark.parametrize("seed", range(6))
def test_drawn_requests(library, seed):
    df, model = library
    rnd = random.Random(seed)
    for _ in range(8):
        body, found = draw_clause(rnd, 3)
        rows, _ = Plan(df, model).rows(body)
        assert {r.loan for r in rows.select("loan").collect()} == (ALL if found is None else found), body


def test_several_requests_share_a_scan(library):
    df, model = library
    rnd = random.Random(99)
    drawn = [(draw_clause(rnd, 2), draw_clause(rnd, 2)) for _ in range(6)]
    whole = lambda s: ALL if s is None else s
    plan = Plan(df, model)
    counts = {r.asked: (r.doc_count, r.f0) for r in plan.counted([(q, None, {"f": f}) for (q, _), (f, _) in drawn]).collect()}
    assert counts == {k: (len(whole(s)), len(whole(s) & whole(t))) for k, ((_, s), (_, t)) in enumerate(drawn) if whole(s)}


def test_a_line_without_a_field_asks_every_text_column(library):
    df, model = library
    for words in ("cover", "water stain", '"page by"', "src"):
        rows, _ = Plan(df, model).rows({"query_string": {"query": words}})
        assert {r.loan for r in rows.collect()} == held_together("remark", words) | held_together("title", words)


def test_a_line_of_an_unknown_field_is_left_out(library):
    df, model = library
    plan = Plan(df, model)
    rows, _ = plan.rows({"query_string": {"query": "colour:red and reader:4"}})
    assert rows.count() == len(ROWS) and plan.warnings


@pytest.mark.parametrize("line", ["reader:", "fee:1 or", "reader:(4 or 7", "lost:true)", 'branch:"north', ": reader:4", "and reader:4"])
def test_lines_that_do_not_parse(library, line):
    df, model = library
    with pytest.raises(QuerySyntaxError):
        Plan(df, model).rows({"query_string": {"query": line}})


def test_parts_of_a_line():
    for pieces in (["fee", ":", "(", "1", "or", '"2 or 3"', ")", "lost", ":", "true"], ["a-b", ":", '"x:(y)"']):
        assert parts(" ".join(pieces)) == pieces == parts("".join(p if p in ":()" else f" {p} " for p in pieces))
    assert parts("two plain words") == ["two plain words"] and parts('"12:30 (noon)"') == ['"12:30 (noon)"'] and parts("") == []


def test_tokens_on_the_driver_and_in_columns(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("aB9_ .-/\tÉ\n") for _ in range(rnd.randrange(30))) for _ in range(80)] + REMARKS
    got = [r.w for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(tokens(F.col("t")).alias("w")).collect()]
    assert [set(w) for w in got] == [plain_words(t) for t in texts] and [token_list(t or "") for t in texts] == got
    assert all(len(w) == len(set(w)) for w in got)


def test_intervals():
    for unit, ns in UNITS.items():
        assert [interval_ns(f"{n}{unit}") for n in (1, 12, 900)] == [ns, 12 * ns, 900 * ns]
    for bad in ("5", "m", "0h", "05m", "2.5s", "1 d", "-3s", "1M", "quarter", "", None, 60):
        with pytest.raises(ValueError):
            interval_ns(bad)


def test_names_of_fields():
    assert {field_name(n) for n in ("lent", "@lent", "lent.keyword", "@lent.keyword")} == {"lent"}
    assert field_name("@@x.keyword.keyword") == "@x.keyword"  # one of each is taken off


def test_bodies(library):
    model = library[1]
    body = {"size": 20, "sort": ["branch", {"@fee": {"order": "desc"}}, {"colour": {}}, {"lent.keyword": "DESC"}], "docvalue_fields": ["@lent", {"field": "fee"}], "aggs": {"x": {"avg": {}}}}
    asked = Request.of(body, model)
    assert (asked.size, asked.sort, asked.docvalue_fields) == (20, [("branch", False), ("fee", True), ("lent", True)], ["lent", "fee"])
    assert len(asked.warnings) == 2 and Request.of({}, model).query is None
    assert [Request.of({"size": n}, model).size for n in (-1, True, "7", None, 3)] == [0, 0, 0, 0, 3]
    assert [Request.of({"index": i}).index for i in ("logs_a", ["logs_b", "logs_c"], [])] == ["logs_a", "logs_b", None]
    filters = {"filters": {"filters": {"f": {"match_all": {}}}}}
    for bad in ({**filters, "aggs": {"in": filters}}, {"date_histogram": {"field": "lent", "interval": "1h"}, "aggs": {"in": {"max": {}}}}, {"date_histogram": {"field": "lent", "interval": "1M"}}):
        with pytest.raises(ValueError):
            Request.of({"aggs": {"x": bad}}, model)
    with pytest.raises(ValueError):
        Request.of([], model)


def test_queries_that_are_a_time_range(library):
    model = library[1]
    lent = lambda **b: {"range": {"lent": b}}
    both = {"bool": {"filter": lent(gt=2, lt=9), "must": [{"match_all": {}}]}}
    assert [time_range_only(q, model) for q in (None, {"match_all": {}}, {"bool": {}}, both, lent(gte=2, lte=9))] == [(None, None)] * 3 + [(3, 9), (2, 10)]
    others = [{"range": {"fee": {"gt": 1}}}, {"bool": {"should": [lent(gt=2)]}}, {"bool": {"must": [lent(gt=2), lent(lt=9)]}}, {"exists": {"field": "lent"}}]
    assert [time_range_only(q, model) for q in others] == [None] * 4


def test_texts_that_are_conjuncts():
    one, two = {"query_string": {"query": "title:water"}}, {"exists": {"field": "fee"}}
    assert all(map(only_conjunct, (one, {"bool": {"must": one, "filter": [two]}}, {"bool": {"filter": {"bool": {"must": [one]}}, "should": two}})))
    assert not any(map(only_conjunct, ({"bool": {"should": one}}, {"bool": {"must": two, "must_not": one}}, {"query_string": {"query": "not title:water"}}, {"query_string": {"query": "water"}})))
