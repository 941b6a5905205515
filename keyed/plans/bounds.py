"""Key ranges: what a list of predicates says about the key, and how a range becomes a pushable filter.

A bound is a tuple over the first key columns; a shorter tuple is a prefix. An inclusive upper prefix takes in every
key that starts with it and an exclusive lower prefix skips all of them, so a prefix range never loses rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, localcontext
from functools import cmp_to_key
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLIPPED = {"=": "=", "<=>": "<=>", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
OPERATORS = set(FLIPPED) | {"startswith"}
_LAST_CODE_POINT = 0x10FFFF


@dataclass(frozen=True)
class KeyRange:
    """``()`` as a bound means unbounded."""

    lo: tuple = ()
    hi: tuple = ()
    lo_incl: bool = False
    hi_incl: bool = False

    def __str__(self) -> str:
        left, right = ("[" if self.lo and self.lo_incl else "("), ("]" if self.hi and self.hi_incl else ")")
        return f"{left}{_tuple_text(self.lo, '-Inf')} - {_tuple_text(self.hi, '+Inf')}{right}"


def _tuple_text(values: tuple, unbounded: str) -> str:
    if not values:
        return unbounded
    return str(values[0]) if len(values) == 1 else "(" + ",".join(str(v) for v in values) + ")"


def compare(x: Any, y: Any) -> int:
    """The order of two values of one type as Spark has it: null lowest, NaN equal to itself and greater than any other."""
    if x is None or y is None:
        return (x is not None) - (y is not None)
    if x != x or y != y:
        return (x != x) - (y != y)
    return (x > y) - (x < y)


value_key = cmp_to_key(compare)


def _cut_order(a: tuple[tuple, int], b: tuple[tuple, int]) -> int:
    """Order positions between keys: (values, -1) lies before every key starting with values, (values, 1) after."""
    for x, y in zip(a[0], b[0]):
        if order := compare(x, y):
            return order
    if len(a[0]) == len(b[0]):
        return (a[1] > b[1]) - (a[1] < b[1])
    return a[1] if len(a[0]) < len(b[0]) else -b[1]


cut_key = cmp_to_key(_cut_order)


def lower_cut(r: KeyRange) -> tuple[tuple, int]:
    return r.lo, (-1 if r.lo_incl or not r.lo else 1)


def upper_cut(r: KeyRange) -> tuple[tuple, int]:
    return r.hi, (1 if r.hi_incl or not r.hi else -1)


def is_empty(r: KeyRange) -> bool:
    return _cut_order(lower_cut(r), upper_cut(r)) >= 0


def next_prefix(text: str) -> str | None:
    """Smallest text above every text that starts with ``text``; None when there is none."""
    for i in range(len(text) - 1, -1, -1):
        code = ord(text[i])
        if code < _LAST_CODE_POINT:
            following = 0xE000 if code == 0xD7FF else code + 1
            return text[:i] + chr(following)
    return None


def normalise(where: Sequence[tuple], columns: Sequence[str]) -> list[tuple[str, str, Any]]:
    """(column, operator, value) triples; a literal on the left is flipped to the right."""
    out = []
    for left, op, right in where:
        if op not in OPERATORS:
            raise ValueError(f"unknown operator {op!r}")
        if left in columns:
            out.append((left, op, right))
        elif right in columns and op in FLIPPED:
            out.append((right, FLIPPED[op], left))
        else:
            raise ValueError(f"no column of the table in {(left, op, right)!r}")
    return out


def key_range(keys: Sequence[str], where: Sequence[tuple[str, str, Any]]) -> KeyRange | None:
    """Leading equalities plus one range on the next key; None when no key can match."""
    prefix: tuple = ()
    for key in keys:
        mine = [(op, v) for c, op, v in where if c == key]
        if any(v is None for _, v in mine):
            return None
        equal = [v for op, v in mine if op in ("=", "<=>")]
        if equal:
            if any(compare(v, equal[0]) for v in equal):
                return None
            prefix += (equal[0],)
            continue
        lows = [(v, op == ">=") for op, v in mine if op in (">", ">=")]
        highs = [(v, op == "<=") for op, v in mine if op in ("<", "<=")]
        for op, v in mine:
            if op == "startswith":
                lows.append((v, True))
                if next_prefix(v) is not None:
                    highs.append((next_prefix(v), False))
        lo = max(lows, key=lambda b: (value_key(b[0]), not b[1]), default=None)
        hi = min(highs, key=lambda b: (value_key(b[0]), b[1]), default=None)
        found = KeyRange(
            prefix + ((lo[0],) if lo else ()),
            prefix + ((hi[0],) if hi else ()),
            lo[1] if lo else bool(prefix),
            hi[1] if hi else bool(prefix),
        )
        return None if is_empty(found) else found
    return KeyRange(prefix, prefix, True, True) if prefix else KeyRange()


def instant_text(moment: dt.datetime) -> str:
    """A timestamp as Spark hands it to Python (in the zone of this process) as text with a zone."""
    return moment.astimezone(dt.timezone.utc).isoformat()


def fit(value: Any, dtype: T.DataType) -> Any:
    """A value as one of the column's type; one that the type cannot hold exactly is an error (``fold`` takes those)."""
    if value is None:
        return None
    if isinstance(dtype, T.DateType):
        return dt.date.fromisoformat(value) if isinstance(value, str) else value
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        moment = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
        if not moment.tzinfo:
            return moment
        # columns without a zone hold UTC; instants are compared as Python hands them over, in the zone of this process
        zone = dt.timezone.utc if isinstance(dtype, T.TimestampNTZType) else None
        return moment.astimezone(zone).replace(tzinfo=None)
    if isinstance(dtype, T.DayTimeIntervalType):
        return dt.timedelta(microseconds=value) if isinstance(value, int) else value
    if isinstance(dtype, T.DecimalType):
        exact = Decimal(str(value))
        with localcontext(prec=100):
            if exact != round(exact, dtype.scale):
                raise TypeError(f"{value!r} is not a {dtype.simpleString()}")
        return exact
    if isinstance(dtype, T.IntegralType):
        if isinstance(value, (str, bytes)) or value != int(value):
            raise TypeError(f"{value!r} is not a {dtype.simpleString()}")
        return int(value)
    if isinstance(dtype, T.StringType) and not isinstance(value, str):
        raise TypeError(f"{value!r} is not a {dtype.simpleString()}")
    return value


#: What a comparison is where the literal lies outside the type: false or true of every value that is not null.
NEVER, ALWAYS = "never", "always"


def fold(op: str, value: Any, dtype: T.DataType) -> tuple[str, Any]:
    """A comparison as one whose literal is of the column's type.

    A literal between two values of a type becomes the nearest one on the right side, one beyond the type makes the
    comparison ``NEVER`` or ``ALWAYS``. So no literal is rounded and none makes the query fail.
    """
    if value is None or op == "startswith":
        return op, fit(value, dtype)
    if isinstance(dtype, T.DateType) and isinstance(value, dt.datetime):
        value, whole = value.date(), value.time() == dt.time()
        return (op, value) if whole else _between(op, value, value + dt.timedelta(days=1))
    if not isinstance(dtype, (T.IntegralType, T.DecimalType)) or isinstance(value, (str, bytes)):
        return op, fit(value, dtype)
    if value != value or value in (float("inf"), float("-inf")):
        return _beyond(op, value != value or value > 0)
    if isinstance(dtype, T.DecimalType):
        scale, digits = dtype.scale, dtype.precision
        least, most = Decimal(1 - 10**digits).scaleb(-scale), Decimal(10**digits - 1).scaleb(-scale)
    else:
        scale, bits = 0, _BITS[type(dtype)]
        least, most = Decimal(-(1 << bits - 1)), Decimal((1 << bits - 1) - 1)
    with localcontext(prec=400):
        exact = Decimal(value) if isinstance(value, (int, Decimal)) else Decimal(str(value))
        if not least <= exact <= most:
            return _beyond(op, exact > 0)
        step = Decimal(1).scaleb(-scale)
        below = exact.quantize(step, ROUND_FLOOR)
        above = exact.quantize(step, ROUND_CEILING)
    if isinstance(dtype, T.IntegralType):
        below, above = int(below), int(above)
    return (op, below) if below == above else _between(op, below, above)


def _between(op: str, below: Any, above: Any) -> tuple[str, Any]:
    if op in ("=", "<=>"):
        return NEVER, None
    return ("<=", below) if op in ("<", "<=") else (">=", above)


def _beyond(op: str, above: bool) -> tuple[str, Any]:
    return (ALWAYS if op in (("<", "<=") if above else (">", ">=")) else NEVER), None


_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def literal(value: Any, dtype: T.DataType) -> Column:
    """A value as a literal of the column's type, free of any time zone; an integer beyond the type keeps a wider one."""
    if value is not None and isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    if isinstance(value, int) and (bits := _BITS.get(type(dtype))) and not -(1 << bits - 1) <= value < 1 << bits - 1:
        return F.lit(str(value)).cast(T.DecimalType(38, 0))
    return F.lit(value).cast(dtype)


def _tuple_compare(keys: Sequence[str], types: Sequence[T.DataType], values: tuple, op: str, incl: bool) -> Column:
    """OR of ANDs, which the Parquet reader takes as a pushed filter (a comparison of structs is not pushed)."""
    out = None
    for i in range(len(values)):
        term = F.lit(True)
        for j in range(i):
            equal = F.col(keys[j]) == literal(values[j], types[j])
            term = equal if j == 0 else term & equal
        last = i == len(values) - 1
        col, lit = F.col(keys[i]), literal(values[i], types[i])
        step = {(">", True): col >= lit, (">", False): col > lit, ("<", True): col <= lit, ("<", False): col < lit}[
            (op, last and incl)
        ]
        term = step if i == 0 else term & step
        out = term if out is None else out | term
    return out


def range_condition(keys: Sequence[str], types: Sequence[T.DataType], r: KeyRange) -> Column | None:
    """Filter for a range; an unbounded side adds no predicate, so null keys are not lost to it."""
    shared = 0
    while shared < min(len(r.lo), len(r.hi)) and r.lo[shared] == r.hi[shared]:
        shared += 1
    parts = [F.col(k) == literal(v, t) for k, t, v in zip(keys, types, r.lo[:shared])]
    rest, rest_types = list(keys)[shared:], list(types)[shared:]
    if len(r.lo) > shared:
        parts.append(_tuple_compare(rest, rest_types, r.lo[shared:], ">", r.lo_incl))
    if len(r.hi) > shared:
        parts.append(_tuple_compare(rest, rest_types, r.hi[shared:], "<", r.hi_incl))
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out


def predicate(column: Column, dtype: T.DataType, op: str, value: Any) -> Column:
    """One triple as a Column; null where the column is null, but for ``<=>``."""
    if op == "startswith":
        return column.startswith(value)
    if op == NEVER:
        return column.isNull() & F.lit(None).cast("boolean")
    if op == ALWAYS:
        return column.isNotNull() | F.lit(None).cast("boolean")
    lit = literal(value, dtype)
    if op == "<=>":
        return column.isNull() if value is None else column.eqNullSafe(lit)
    return {"=": column == lit, "<": column < lit, "<=": column <= lit, ">": column > lit, ">=": column >= lit}[op]
