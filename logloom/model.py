"""Models: what the columns of a log table mean."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column of stored tables that has the UTC day of the timestamp; files lie in folders by it.
DAY = "_day"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DAY_NS = 86_400 * 10**9
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Field:
    """A column: its type and its roles."""

    name: str
    type: T.DataType
    id: bool = False
    timestamp: bool = False
    full_text: bool = False
    by_day: bool = False  # the table has the timestamp's day in DAY

    @property
    def base(self) -> T.DataType:
        return self.type.elementType if isinstance(self.type, T.ArrayType) else self.type

    @property
    def caps(self) -> str:
        """The type's name in field capabilities."""
        if self.timestamp or isinstance(self.base, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "date"
        if isinstance(self.base, T.StringType):
            return "text"
        if isinstance(self.base, T.BooleanType):
            return "boolean"
        if isinstance(self.base, (T.FloatType, T.DoubleType)):
            return "float"
        if isinstance(self.base, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return "long"
        return "keyword"

    def value(self, literal: object) -> object:
        """A literal as this column's base type has it; ValueError if it can't be."""
        base = self.base
        if isinstance(base, T.StringType):
            return literal if isinstance(literal, str) else str(literal).lower() if isinstance(literal, bool) else str(literal)
        if isinstance(base, T.BooleanType):
            if isinstance(literal, bool) or str(literal).lower() in ("true", "false", "0", "1"):
                return str(literal).lower() in ("true", "1")
            raise ValueError(f"not a truth value: {literal!r}")
        if isinstance(base, NUMERIC):
            number = float(str(literal))
            if isinstance(base, (T.FloatType, T.DoubleType, T.DecimalType)):
                return number
            whole = int(literal) if isinstance(literal, int) or str(literal).lstrip("+-").isdigit() else number
            if whole != int(whole):
                raise ValueError(f"not a whole number: {literal!r}")
            return int(whole)
        if isinstance(base, T.DateType):
            return literal if isinstance(literal, date) else date.fromisoformat(str(literal)[:10])
        if isinstance(base, (T.TimestampType, T.TimestampNTZType)):
            return datetime.fromisoformat(str(literal).replace("Z", "+00:00"))
        raise ValueError(f"no literal for {base}")


@dataclass(frozen=True)
class Model:
    """The fields of a table by name."""

    fields: dict[str, Field] = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame, id: str | None = None, timestamp: str | None = None, full_text: tuple[str, ...] = ()) -> Model:
        """From a DataFrame's schema and the names of the columns with a role."""
        roles = {"id": (id,), "timestamp": (timestamp,), "full_text": full_text}
        if missing := [c for cs in roles.values() for c in cs if c and c not in df.columns]:
            raise ValueError(f"no such columns: {missing}")
        fields = {f.name: Field(f.name, f.dataType, **{r: f.name in cs for r, cs in roles.items()}, by_day=f.name == timestamp and DAY in df.columns) for f in df.schema.fields}
        fields.pop(DAY, None)  # not a field that requests can name
        return cls(fields)

    @property
    def id(self) -> Field | None:
        return next((f for f in self.fields.values() if f.id), None)

    @property
    def timestamp(self) -> Field | None:
        return next((f for f in self.fields.values() if f.timestamp), None)

    @property
    def full_text(self) -> list[Field]:
        return [f for f in self.fields.values() if f.full_text]


def nanoseconds(f: Field) -> Column:
    """A timestamp field as nanoseconds since 1970; a number is taken as such, other types as UTC."""
    if isinstance(f.type, NUMERIC):
        return F.col(f.name).cast("long")
    if isinstance(f.type, T.TimestampType):
        return F.unix_micros(F.col(f.name)) * 1000
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(`{f.name}` as timestamp_ntz))") * 1000


def day_of(ns: Column) -> Column:
    """The day, in UTC, of nanoseconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.call_function("div", ns - F.pmod(ns, F.lit(DAY_NS)), F.lit(DAY_NS)).cast("int"))


def day_at(ns: int) -> date:
    return date(1970, 1, 1) + timedelta(days=ns // DAY_NS)


def in_time(f: Field, compare: str, ns: int) -> Column:
    """The timestamp compared (>, >=, <, <=) with nanoseconds, by its own type where that is exact, so that it
    reaches the files' statistics; and the same of its day, so that folders are left out."""
    op = {">": Column.__gt__, ">=": Column.__ge__, "<": Column.__lt__, "<=": Column.__le__}[compare]
    exact = isinstance(f.type, NUMERIC) or ns % 1000 == 0
    point = op(F.col(f.name), native(f, ns)) if exact else op(nanoseconds(f), F.lit(ns))
    if not f.by_day:
        return point
    day = F.lit(day_at(ns + (compare == ">") - (compare == "<")))
    return point & (F.col(DAY) >= day if compare[0] == ">" else F.col(DAY) <= day)


def native(f: Field, ns: int) -> Column:
    """A point in time as the field's own type has it, so that comparisons reach the files' statistics."""
    if isinstance(f.type, NUMERIC):
        return F.lit(ns)
    if isinstance(f.type, T.TimestampType):
        return F.timestamp_micros(F.lit(ns // 1000))
    at = (EPOCH + timedelta(microseconds=ns // 1000)).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ '{at}'")
