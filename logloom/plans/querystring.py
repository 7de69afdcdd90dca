"""The search line: field:value terms with and, or, xor, not and parentheses, or free text.

Terms become SQL conditions and everything else stays as it is, so that Spark parses the line: which words
belong together, what is missing, and the order of binding. Spark has no xor, so each operator also closes
and opens the parentheses that keep or, xor and and apart: `a or b xor c` is `((((a))) or (((b)) <> ((c))))`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import field_name
from ..model import NUMERIC
from ..operators import predicates as P

PIECE = re.compile(r'\s+|([():])|((?:"[^"]*"|[^\s():"])+)')
OPEN, CLOSE = "((((", "))))"  # one more than operators close, so that `not` holds for all of a group
BETWEEN = {"or": "))) or (((", "xor": ")) <> ((", "and": ") and ("}


class QuerySyntaxError(ValueError):
    pass


class UnknownField(LookupError):
    pass


def parts(text: str) -> list[str]:
    """Words, quoted texts and the signs ( ) : of a line; a line without ':' is one part."""
    if ":" not in re.sub(r'"[^"]*"', "", text):
        return [text.strip()] if text.strip() else []
    out, at = [], 0
    while at < len(text):
        m = PIECE.match(text, at)
        if not m:
            raise QuerySyntaxError(f"unclosed quote at {at}: {text}")
        out += [m[1] or m[2]] if m[1] or m[2] else []
        at = m.end()
    return out


class Line:
    """One line's condition; `search` gives the SQL of a text on an indexed field."""

    def __init__(self, text: str, model, search, wildcard: bool = False):
        self.model, self.search, self.wildcard = model, search, wildcard
        self.parts = parts(text)

    def column(self) -> Column | None:
        if not self.parts or self.parts == ["*"]:
            return None
        return F.expr(self.everywhere(self.parts[0]) if len(self.parts) == 1 else self.sql())

    def everywhere(self, text: str) -> str:
        return "(" + (" or ".join(self.search(f, text.strip('"')) for f in self.model.full_text) or "false") + ")"

    def sql(self) -> str:
        """Terms beside one another are joined by and; a group after a field's colon is of that field."""
        out, fields, todo, beside = [OPEN], [None], self.parts[::-1], False
        while todo:
            here = todo.pop()
            word, field = here.lower(), fields[-1]
            if word in BETWEEN:
                out.append(BETWEEN[word])
                beside = False
                continue
            if here == ")":
                if len(fields) == 1:
                    raise QuerySyntaxError("a parenthesis is closed that is not open")
                fields.pop()
                out.append(CLOSE)
                beside = True
                continue
            if beside:
                out.append(BETWEEN["and"])
            beside = word != "not" and here != "("
            if todo[-1:] == [":"] and here not in ("(", ":"):
                todo.pop()
                field = self.model.fields.get(field_name(here))
                if field is None:
                    raise UnknownField(here)
                here = todo.pop() if todo else ")"
                word = ""
                if here in (")", ":"):
                    raise QuerySyntaxError(f"{field.name} has no value")
                beside = here != "("
            if here == "(":
                fields.append(field)
                out.append(OPEN)
            elif word == "not":
                out.append("not")
            elif here == ":":
                raise QuerySyntaxError("a colon without a field")
            else:
                out.append(self.value(field, here) if field is not None else self.everywhere(here))
        if len(fields) > 1:
            raise QuerySyntaxError("a closing parenthesis is missing")
        return " ".join([*out, CLOSE])

    def value(self, f, text: str) -> str:
        """Two-valued, as `not` needs it."""
        quoted = text[:1] == '"'
        text = text.strip('"')
        if f.full_text:
            return self.search(f, text)
        name = f"cast({P.quoted_name(f)} as string)"
        if isinstance(f.type, NUMERIC):
            try:
                float(text)
                return P.match_sql(f, text)
            except ValueError:
                pass
        if self.wildcard and not quoted and re.search(r"[*?]", text):
            return f"coalesce({name} like {P.literal(P.like_pattern(text))}, false)"
        return f"coalesce(contains({name}, {P.literal(text)}), false)"
