"""Words of log texts, field names and intervals."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that the index leaves out. They are compared after lower-casing.
STOP_WORDS = ("", " ", "data", "php", "src", "logs", "pmx", "Eco", "eco", "vendor")
# Nanoseconds of an interval's unit.
UNITS = {"ms": 10**6, "s": 10**9, "m": 60 * 10**9, "h": 3600 * 10**9, "d": 86400 * 10**9, "w": 7 * 86400 * 10**9}
INTERVAL = re.compile(r"([1-9][0-9]*)(ms|s|m|h|d|w)")


def tokens(text: Column) -> Column:
    """Distinct lower-case words (ASCII letters, digits, _) of a text, in order, without stop words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+")
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*STOP_WORDS)))


def token_list(text: str) -> list[str]:
    """The same for a search text on the driver."""
    words = re.split(r"\W+", text.lower(), flags=re.ASCII)
    return list(dict.fromkeys(w for w in words if w not in STOP_WORDS))


def field_name(name: str) -> str:
    """A request's field name as the tables have it: without its first '.keyword' and its first '@'."""
    return name.replace(".keyword", "", 1).replace("@", "", 1)


def interval_ns(text: str) -> int:
    """Nanoseconds of '30s', '5m', '1h', '1d', '1w' or '500ms'."""
    m = INTERVAL.fullmatch(text) if isinstance(text, str) else None
    if not m:
        raise ValueError(f"not an interval: {text!r}")
    return int(m[1]) * UNITS[m[2]]
