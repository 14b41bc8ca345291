"""Column expressions that turn raw text columns into typed, repaired ones.

All of them are built-in expressions: they stay inside whole-stage code generation and keep
projections collapsible. Casts never raise; a value that does not parse becomes NULL and is
left to the row rules (`operators.quality`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_present(df: DataFrame, variants: list[str], type_name: str = "string") -> Column:
    """First non-NULL value among those `variants` that exist in `df`.

    Sources name the same attribute differently, and a batch may lack some of the names
    altogether; absent names are skipped and a typed NULL is returned if none is there.
    """
    known = {column.lower() for column in df.columns}
    present = [F.col(f"`{name}`") for name in variants if name.lower() in known]
    if not present:
        return F.lit(None).cast(type_name)
    return F.coalesce(*present)


def column_or_null(df: DataFrame, name: str, type_name: str = "string") -> Column:
    """The column if the batch has it, else a typed NULL."""
    return first_present(df, [name], type_name)


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Replace the listed codes; every other value, NULL included, stays as it is."""
    table = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(table[value], value)


def classify(value: Column, mapping: dict[str, str], default: str) -> Column:
    """Look a code up; unknown codes and NULL give `default`."""
    table = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(table[value], F.lit(default))


def prefer_if_in(candidate: Column, allowed: list[str], otherwise: Column) -> Column:
    """Take `candidate` when its value belongs to the vocabulary, else `otherwise`.

    Repairs two columns that some sources deliver swapped, judging by content and not by
    source name.
    """
    return F.when(candidate.isin(allowed), candidate).otherwise(otherwise)


def null_if_in(value: Column, sentinels: list[str]) -> Column:
    """Placeholder texts become NULL."""
    return F.when(~value.isin(sentinels), value)


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_double(value: Column) -> Column:
    return value.try_cast("double")


def as_timestamp(value: Column, pattern: str) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern))


def as_date(value: Column, pattern: str) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern)).cast("date")


def leading_number(value: Column, pattern: str) -> Column:
    """Number in front of a unit suffix (`23.4 kmpl`); NULL when there is none."""
    return as_double(F.regexp_extract(value, pattern, 1))


def matches(value: Column, pattern: str) -> Column:
    """Whether the text matches; NULL counts as a mismatch, so the result is never NULL."""
    return F.coalesce(value.rlike(pattern), F.lit(False))


def null_safe_sum(*values: Column) -> Column:
    """Row-wise sum in which a missing amount counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])


def all_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in columns])


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])
