"""Filter conditions as Columns. Each returns a condition, or None where its parameter isn't set."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = datetime | date | str


def all_of(*conditions: Column | None) -> Column:
    """AND of those that are set; true where none is."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def any_of(*conditions: Column | None) -> Column:
    """OR of those that are set; false where none is."""
    return reduce(or_, [c for c in conditions if c is not None], F.lit(False))


def optional_equal(column: str, value) -> Column | None:
    return None if value is None else F.col(column) == F.lit(value)


def one_of(column: str, values: Sequence | None) -> Column | None:
    return None if not values else F.col(column).isin(*values)


def overlaps(column: str, values: Sequence[str] | None) -> Column | None:
    """Arrays that share a member; nulls in either count as no match."""
    return None if not values else F.coalesce(F.arrays_overlap(F.col(column), F.array(*map(F.lit, values))), F.lit(False))


def contains(column: str, value: str | None) -> Column | None:
    return None if value is None else F.coalesce(F.array_contains(F.col(column), value), F.lit(False))


def moment(value: Moment) -> Column:
    return F.lit(value).cast("timestamp")


def between(column: str, start: Moment | None, end: Moment | None) -> Column | None:
    """Both ends inclusive; an end that isn't set is open."""
    return None if start is None and end is None else all_of(None if start is None else F.col(column) >= moment(start), None if end is None else F.col(column) <= moment(end))


def within_days(column: str, days: int | None, as_of: Moment) -> Column | None:
    return None if days is None else F.col(column) >= moment(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def day_window(column: str, days: int, as_of: Moment) -> Column:
    """From midnight `days` before as_of's day to the end of that day, half open."""
    day = F.to_date(moment(as_of))
    return (F.col(column) >= F.date_sub(day, days).cast("timestamp")) & (F.col(column) < F.date_add(day, 1).cast("timestamp"))


def length_between(start: str, end: str, least: float | None, most: float | None) -> Column | None:
    span = F.col(end) - F.col(start)
    return None if least is None and most is None else all_of(None if least is None else span >= least, None if most is None else span <= most)


def must_contain(column: str, words: Sequence[str] | None) -> Column | None:
    """All words, case-insensitively; % and _ in a word are wildcards."""
    return None if not words else all_of(*[F.col(column).ilike(f"%{w}%") for w in words])


def must_contain_any(column: str, words: Sequence[str] | None) -> Column | None:
    return None if not words else any_of(*[F.col(column).ilike(f"%{w}%") for w in words])


def text_conditions(time_column: str, text_column: str, days: int | None, as_of: Moment, every: Sequence[str] | None, some: Sequence[str] | None) -> Column:
    """The dynamic part of a search's WHERE clause."""
    return all_of(within_days(time_column, days, as_of), must_contain(text_column, every), must_contain_any(text_column, some))


def json_number(column: str, path: str) -> Column:
    """A scalar of a JSON text as a double, null where it is missing or no number."""
    return F.get_json_object(F.col(column), path).try_cast("double")


def json_equals(column: str, key: str, value: str) -> Column:
    return F.coalesce(F.get_json_object(F.col(column), f"$.{key}") == value, F.lit(False))


def json_has_key(column: str, key: str) -> Column:
    """The key is there, with null as its value too."""
    return F.coalesce(F.array_contains(F.json_object_keys(F.col(column)), key), F.lit(False))


def json_array_matches(column: str, array: str, member: str, pattern: str) -> Column:
    """Some object of a JSON array has a member that matches, regardless of case."""
    held = F.from_json(F.col(column), f"{array} array<struct<{member}:string>>")
    return F.coalesce(F.exists(held[array], lambda x: F.coalesce(x[member].rlike("(?i)" + pattern), F.lit(False))), F.lit(False))


def distinct_from(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


def equals_ignoring_case(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def access_allowed(requested: Column, allowed: Column) -> Column:
    """Every requested project is allowed; an empty allow-list allows all."""
    return (F.size(allowed) == 0) | (F.size(F.array_except(requested, allowed)) == 0)
