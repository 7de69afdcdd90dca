"""Filter clauses as Columns. A clause that can't apply gives None, which adds no condition."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import EPOCH, Field, in_time



def true(c: Column) -> Column:
    """Two-valued: unknown counts as false."""
    return F.coalesce(c, F.lit(False))


def all_of(clauses: Iterable[Column | None]) -> Column | None:
    some = [c for c in clauses if c is not None]
    return reduce(and_, some) if some else None


def any_of(clauses: Iterable[Column | None]) -> Column | None:
    some = [c for c in clauses if c is not None]
    return reduce(or_, some) if some else None


def none_of(clauses: Iterable[Column | None]) -> Column | None:
    return all_of(~true(c) for c in clauses if c is not None)


def boolean(must: list, must_not: list, filter: list, should: list, minimum_should_match: int = 0) -> Column | None:
    """must, must_not and filter together; should counts only without them, unless a minimum is asked for."""
    narrow = all_of([all_of(must), none_of(must_not), all_of(filter)])
    some = [c for c in should if c is not None]
    if some and minimum_should_match > 1:
        wide = reduce(lambda a, b: a + b, [true(c).cast("int") for c in some]) >= minimum_should_match
    else:
        wide = any_of(some)
    return wide if narrow is None else all_of([narrow, wide]) if minimum_should_match else narrow


def match(f: Field, value: object) -> Column:
    """Equal to the value; of an array column, holding it. A value that the type can't have never matches."""
    try:
        if f.timestamp:
            at = point_ns(value, None)
            return in_time(f, ">=", at) & in_time(f, "<=", at)
        literal = F.lit(f.value(value))
    except (ValueError, TypeError, OverflowError):
        return F.lit(False)
    if isinstance(f.type, T.ArrayType):
        return F.array_contains(F.col(f.name), literal.cast(f.base))
    return F.col(f.name) == literal


def terms(f: Field, values: object) -> Column:
    """Equal to one of the values."""
    values = values if isinstance(values, list) else [values]
    if f.timestamp or isinstance(f.type, T.ArrayType):
        return any_of(match(f, v) for v in values) if values else F.lit(False)
    good = []
    for v in values:
        try:
            good.append(f.value(v))
        except (ValueError, TypeError, OverflowError):
            continue
    return F.col(f.name).isin(good) if good else F.lit(False)


def exists(f: Field) -> Column:
    return F.col(f.name).isNotNull()


def point_ns(value: object, format: str | None) -> int:
    """A bound of a timestamp in nanoseconds: milliseconds if the format says so, an ISO text, or nanoseconds."""
    if isinstance(value, str) and not value.lstrip("+-").isdigit():
        at = datetime.fromisoformat(value.replace("Z", "+00:00"))
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        return (at - EPOCH) // timedelta(microseconds=1) * 1000
    return int(value) * (10**6 if format == "epoch_millis" else 1)


def between(f: Field, gt: object = None, gte: object = None, lt: object = None, lte: object = None, format: str | None = None) -> Column | None:
    """Within the bounds that are given. Arrays have no order: no condition."""
    if isinstance(f.type, T.ArrayType):
        return None
    clauses = []
    for value, sign, compare in ((gt, ">", Column.__gt__), (gte, ">=", Column.__ge__), (lt, "<", Column.__lt__), (lte, "<=", Column.__le__)):
        if value is None:
            continue
        if f.timestamp:
            clauses.append(in_time(f, sign, point_ns(value, format)))
        else:
            literal = F.lit(float(value)) if isinstance(f.base, (T.FloatType, T.DoubleType, T.DecimalType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and float(str(value)) != int(float(str(value))) else F.lit(f.value(value))
            clauses.append(compare(F.col(f.name), literal))
    return all_of(clauses)


def like_pattern(pattern: str) -> str:
    """For like: * is any text, ? any character, all else itself, anywhere in the value."""
    safe = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return "%" + safe.replace("*", "%").replace("?", "_") + "%"


def literal(text: str) -> str:
    """A text as SQL has it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_name(f: Field) -> str:
    return "`" + f.name.replace("`", "``") + "`"


def match_sql(f: Field, value: str) -> str:
    """`match` on a number as a condition in SQL, two-valued."""
    try:
        number = point_ns(value, None) if f.timestamp else f.value(value)
    except (ValueError, TypeError, OverflowError):
        return "false"
    return f"coalesce({quoted_name(f)} = cast('{number}' as {f.base.simpleString()}), false)"
