"""Personal data by patterns and a skip-chain conditional random field.

Four patterns give the base spans. Other places that could be personal data are candidates: number groups,
addresses written to escape patterns, and long keys. With the base spans they are the nodes of a random
field over each document. Neighbouring nodes are joined. Nodes that repeat the same digits, address or key,
and nodes that begin alike or share a domain, are each joined with a node that stands for their group, so
that all of a group, however distant, share potentials, with as many edges as nodes. Base spans are
observed. Loopy belief propagation gives each candidate a distribution over the kinds and "none"; sure ones
are added.

Node weights are a softmax regression on signs of form and context, edge potentials logarithms of how often
label pairs occur. A place whose digits fail the card's check can't be a card. Both are learned from counts over all documents, under labels that the patterns alone don't give:
base spans teach once as they stand and once in each form that people use to hide or shorten them (the
field never sees a pattern's own check), and a key is a secret where the words before it say so. All other
candidates teach "none", among them those that really are personal data; the field is right as long as
these are fewer than what the hidden forms teach.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
BASE, SECRET, NONE = 4, 4, len(KINDS)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)
NUMBER = re.compile(r"(?<![\w.+-])[+(]{0,2}[0-9](?:[ ().\[\]-]{0,3}[0-9]){6,}(?!\w)")
DOTTED = re.compile(r"(?<![\w.])[0-9]{1,3}(?: ?[\[(]?\.[\])]? ?[0-9]{1,3}){3}(?![\w.])")
MARK = re.compile(r"@|[\[(]at[\])]", re.I)
HIDDEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,63})+", re.I)
KEY = re.compile(r"(?<![\w+/=.@-])(?=[^\s\"']{0,64}[0-9])(?=[^\s\"']{0,64}[A-Za-z])[A-Za-z0-9_+/=-]{20,}(?![\w@.])")
# Words that announce a kind.
CUES = {
    "email": frozenset("email e-mail mail mailto contact write correo courriel".split()),
    "ip": frozenset("ip address host server ping addr client".split()),
    "card": frozenset("card credit visa mastercard amex payment debit karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell telefon teléfono téléphone".split()),
    "secret": frozenset("token key secret password passwd apikey api_key access_key credential bearer auth".split()),
}
SIGNS = 24
NEIGHBOUR, REPEAT, ALIKE = range(3)
NO_CARD = -2


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = DOMAIN.match(text, at + 1) if at > start else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four patterns' matches that hold, sorted."""
    if not ANY.search(text):
        return []
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Other places worth a node, clear of base spans: groups of seven digits or more, dotted groups, keys, and
    address-like tokens."""
    if not ANY.search(text):
        return []
    found = [m.span() for kind in (NUMBER, DOTTED, KEY) for m in kind.finditer(text)]
    for m in MARK.finditer(text):
        start, end = m.span()
        while start > 0 and m.start() - start < 64 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and end - m.end() < 255 and not text[end].isspace():
            end += 1
        while end > m.end() and not text[end - 1].isalnum():
            end -= 1
        if start < m.start() and end > m.end():
            found.append((start, end))
        elif m[0] != "@" and (h := HIDDEN.search(text, max(0, m.start() - 65), min(len(text), m.end() + 255))) and h.start() < m.start() < h.end():
            found.append(h.span())
    out, taken, i = [], 0, 0
    ends = 0
    for start, end in sorted(set(found), key=lambda x: (x[0], -x[1])):
        while i < len(base) and base[i][0] < end:
            ends = max(ends, base[i][2])
            i += 1
        if start >= taken and start >= ends:
            out.append((start, end))
            taken = end
    return out


def signs(form: str, before: str) -> int:
    """A node's features, as bits: its form and the words before it, not what the patterns check."""
    digits = sum(c in "0123456789" for c in form)
    words = {w.strip(".,:;()[]\"'=#") for w in before.lower().split()[-3:]}
    parts = re.split(r" ?[\[(]?\.[\])]? ?", form)
    at = before.rstrip(" \"'")
    bits = [
        True, "@" in form, bool(MARK.search(form)) and "@" not in form, digits == 0, 1 <= digits <= 9, 10 <= digits <= 13, 14 <= digits <= 19, digits > 19,
        form[:1] == "+", "(" in form, len(parts) == 4 and all(x.isdigit() and len(x) < 4 for x in parts), " " in form, "-" in form, "." in form, form.isdigit(),
        *(bool(words & CUES[k]) for k in KINDS), bool(re.search(r"[^\W\d_]", form)), bool(KEY.fullmatch(form)), bool(re.fullmatch("[0-9A-Fa-f]+", form)), at[-1:] in ("=", ":"),
    ]
    return sum(1 << i for i, b in enumerate(bits) if b)


def hidden_forms(form: str, kind: int) -> list[str]:
    """How else a base span of the kind is written: addresses with words for signs, phones without the country,
    dotted groups with room or brackets. Cards have no other form but their digits."""
    if kind == 0:
        name, _, domain = form.rpartition("@")
        return [f"{name}[at]{domain}", f"{name} (at) {domain.replace('.', ' (dot) ')}"]
    if kind == 1:
        return [form.replace(".", " . "), form.replace(".", "[.]")]
    if kind == 3:
        short = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", form)
        return [short, re.sub(r"[^0-9]+", "-", short).strip("-"), re.sub(r"[^0-9]", "", short)]
    return []


def never_card(form: str) -> bool:
    """Whether a place can't be a card's number, as its check says."""
    digits = "".join(c for c in form if c in "0123456789")
    return not 14 <= len(digits) <= 19 or not luhn(digits)


@dataclass
class Graph:
    """Nodes and edges of one document. The last nodes stand for groups of others."""

    nodes: list[tuple[int, int, int, int]]  # start, end, features, base kind or -1 (NO_CARD: any but a card); of a group -1, -1, 0, -1
    edges: list[tuple[int, int, int]]  # node, neighbour or group, type


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    places = sorted([(s, e, k) for s, k, e in base] + [(s, e, -1) for s, e in candidates(text, base)])
    nodes = [(s, e, signs(text[s:e], text[max(0, s - 40) : s]), NO_CARD if k < 0 and never_card(text[s:e]) else k) for s, e, k in places]
    edges = [(i, i - 1, NEIGHBOUR) for i in range(1, len(nodes))]
    same: dict[str, list[int]] = {}
    for i, (s, e, _, _) in enumerate(nodes):
        form = re.sub(r" ?[\[(](at|dot)[\])] ?", lambda m: "@" if m[1] == "at" else ".", text[s:e].lower())
        same.setdefault(form if re.search("[@a-z]", form) else "".join(c for c in form if c in "0123456789")[-10:], []).append(i)
    alike: dict[str, list[int]] = {}
    for form, some in same.items():
        first = some[0]
        if len(some) > 1:
            first = len(nodes)
            edges += [(i, first, REPEAT) for i in some]
            nodes.append((-1, -1, 0, -1))
        alike.setdefault(form.rpartition("@")[2] if "@" in form else form[:6], []).append(first)
    for some in alike.values():  # each form takes part once, so that few loops arise
        if len(some) > 1:
            edges += [(i, len(nodes), ALIKE) for i in some]
            nodes.append((-1, -1, 0, -1))
    return Graph(nodes, edges)


def taught(g: Graph) -> list[int]:
    """The labels that nodes teach: base kinds, keys that are announced as secrets, what repeats one of these,
    else none; a group's is the most frequent kind of its nodes, if any has one."""
    secret = 1 << 15 + SECRET | 1 << 21
    of = [k if k >= 0 else SECRET if bits & secret == secret else NONE for _, _, bits, k in g.nodes]
    kinds: dict[int, list[int]] = {}
    for i, hub, kind in g.edges:  # of a node before its group
        if kind != NEIGHBOUR:
            some = kinds.setdefault(hub, [])
            some += [of[i]] if of[i] != NONE else []
            of[hub] = max(sorted(set(some)), key=some.count) if some else NONE
    for i, hub, kind in g.edges:
        if kind == REPEAT and of[i] == NONE:
            of[i] = of[hub]
    return of


@dataclass
class Field:
    """node: signs x labels weights; edge: type x label x label potentials."""

    node: np.ndarray
    edge: np.ndarray

    def label(self, graphs: list[Graph], rounds: int = 10, damping: float = 0.3) -> list[np.ndarray]:
        """Label distributions of all nodes, by sum-product message passing on all graphs at once."""
        sizes = [len(g.nodes) for g in graphs]
        first = np.cumsum([0, *sizes])
        if not first[-1]:
            return [np.zeros((0, NONE + 1))] * len(graphs)
        bits = np.array([n[2] for g in graphs for n in g.nodes], np.int64)
        known = np.array([n[3] for g in graphs for n in g.nodes], np.int64)
        potential = (bits[:, None] >> np.arange(SIGNS) & 1) @ self.node
        potential[known == NO_CARD, KINDS.index("card")] = -50.0
        potential[known >= 0] = -50.0
        potential[known >= 0, known[known >= 0]] = 0.0
        edges = np.array([(a + f, b + f, t) for g, f in zip(graphs, first) for a, b, t in g.edges], np.int64).reshape(-1, 3)
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([self.edge[edges[:, 2]], self.edge[edges[:, 2]].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(source), NONE + 1))
        belief = potential.copy()
        for _ in range(rounds if len(edges) else 0):
            part = (belief[source] - sent[back])[:, :, None] + pair
            top = part.max(axis=1)
            new = top + np.log(np.exp(part - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            sent = damping * sent + (1 - damping) * new
            belief = potential.copy()
            np.add.at(belief, target, sent)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return [p[a:b] for a, b in zip(first, first[1:])]


def _counts(docs: DataFrame) -> DataFrame:
    """what, a, b, n: nodes by features and label (what -1), edges by type and labels, over all documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int, int], int] = {}
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                if not ANY.search(text):
                    continue
                g = graph(text, base_spans(text))
                of = taught(g)
                keys = [(-1, bits, y) for (s, _, bits, _), y in zip(g.nodes, of) if s >= 0] + [(t, of[i], of[j]) for i, j, t in g.edges]
                for s, e, _, k in g.nodes:
                    keys += [(-1, signs(x, text[max(0, s - 40) : s]), k) for x in hidden_forms(text[s:e], k)]
                for key in keys:
                    counts[key] = counts.get(key, 0) + 1
        if counts:
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(list(counts.values()), pa.int64())], ["what", "a", "b", "n"])

    schema = "what long, a long, b long, n long"
    return docs.select(F.col("text").cast("string")).mapInArrow(each, schema).groupBy("what", "a", "b").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, steps: int = 400, ridge: float = 1e-3, most: float = 3.0) -> Field:
    """Learns from all documents, as `taught` and `hidden_forms` label them. What reaches the driver are counts by feature bits and by label pairs."""
    rows = _counts(docs).toPandas()
    nodes = rows[rows.what == -1]
    x = (nodes.a.to_numpy(np.int64)[:, None] >> np.arange(SIGNS) & 1).astype(float)
    y = np.eye(NONE + 1)[nodes.b.to_numpy(np.int64)]
    n = nodes.n.to_numpy(float)
    weights = np.zeros((SIGNS, NONE + 1))
    weights[0, NONE] = 1.0
    scale = np.full_like(weights, 1e-6)
    for _ in range(steps if len(nodes) else 0):
        z = x @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ ((y - p) * n[:, None]) / n.sum() - ridge * weights
        scale += slope**2
        weights += 0.5 * slope / np.sqrt(scale)
    edge = np.zeros((3, NONE + 1, NONE + 1))
    for t in range(3):
        c = np.full((NONE + 1, NONE + 1), 0.5) + (2 * np.eye(NONE + 1) if t != NEIGHBOUR else 0)  # groups agree until more is known
        for r in rows[rows.what == t].itertuples():
            c[r.a, r.b] += r.n / 2
            c[r.b, r.a] += r.n / 2
        r = c.sum(axis=1)
        # of neighbours, how much likelier a pair is than its labels apart; of a group, which has no signs of its own and
        # is known by its members alone, how far its label and a member's are of one kind, however frequent the kind is
        edge[t] = np.clip(0.5 * np.log(c * c.sum() / np.outer(r, r)) if t == NEIGHBOUR else np.log(c / np.sqrt(np.outer(r, r))), -most, most)
    return Field(weights, edge)


def find(docs: DataFrame, field: Field, sure: float = 0.8) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end, base, p): one row per row of docs.

    Places are code points, the end exclusive. Null and empty texts have none. A candidate whose most
    likely kind has a probability of `sure` is added to the base spans, which always stay. Repeated rows
    and null ids are kept; other columns are not read.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("p", pa.float64())]))

    def spans(texts: list[str]) -> list[list[dict]]:
        graphs = [graph(t, base_spans(t)) for t in texts]
        out = []
        for g, p in zip(graphs, field.label(graphs)):
            found = []
            for (start, end, _, base), q in zip(g.nodes, p):
                best = base if base >= 0 else int(q[:NONE].argmax())
                if start >= 0 and (base >= 0 or q[best] >= sure):
                    found.append((start, best, {"kind": KINDS[best], "start": start, "end": end, "base": base >= 0, "p": float(q[best])}))
            out.append([x[2] for x in sorted(found, key=lambda x: x[:2])])
        return out

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans([t.as_py() or "" for t in part.column(1)]), kind)], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, p: double>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, a hash of them, all spans as kind:start:end, and how many those are."""
    listed = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("spans", lambda x: x.base)
    of = lambda kind: F.size(F.filter(base, lambda x: x.kind == kind)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in KINDS[:BASE]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
