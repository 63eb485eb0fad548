"""Scalar and nested column expressions. Untrusted input goes through the ``try_`` family,
because ANSI mode would fail the whole job on one bad row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c.cast("string"), F.lit(""))


def last_segment(uri: Column) -> Column:
    """Last path segment of a URI, ignoring trailing slashes; NULL when there is none."""
    return blank_to_null(F.substring_index(F.rtrim(uri.cast("string"), F.lit("/")), "/", -1))


def query_parameter(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Literal map lookup. Meant for tables of a few entries; join a dimension table beyond that."""
    if not table:
        return F.lit(None).cast("string")
    pairs = F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))
    return F.element_at(pairs, key)


def first_of(array: Column) -> Column:
    """First element, NULL for an empty or NULL array."""
    return F.get(array, F.lit(0))


def field_exists(schema: StructType, path: str) -> bool:
    """Whether the dotted ``path`` leads to a field, looking through structs only."""
    head, _, rest = path.partition(".")
    if not isinstance(schema, StructType) or head not in schema.names:
        return False
    return not rest or field_exists(schema[head].dataType, rest)


def safe_col(df: DataFrame, path: str, default=None, dtype: str | DataType = "string") -> Column:
    """The column at ``path``, or a typed default literal when the frame has no such field."""
    return F.col(path) if field_exists(df.schema, path) else F.lit(default).cast(dtype)


def column_or(df: DataFrame, name: str, default: str) -> Column:
    """A label column: the named column with blanks defaulted, or the default throughout."""
    return label(F.col(name), default) if name in df.columns else F.lit(default)


def label(c: Column, default: str) -> Column:
    """NULL and ``''`` become ``default``."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def answer_to(questions: Column, word: str) -> Column:
    """Answer of the first question whose text contains ``word``, whatever its case."""
    asked = F.filter(questions, lambda q: F.contains(F.lower(q["question"]), F.lit(word.lower())))
    return first_of(asked)["answer"]


def instant(text: Column) -> Column:
    """ISO-8601 text to a timestamp, NULL if it is not one."""
    return F.try_to_timestamp(text)


def calendar_date(ts: Column) -> Column:
    return F.to_date(ts)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def week_start(ts: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", ts))


def plain_date(text: Column) -> Column:
    """``year-month-day`` text (leading zeros optional) to a date, NULL for anything else."""
    return F.try_to_date(text, "yyyy-M-d")


def cents(amount: Column) -> Column:
    return F.round(amount, 2)


def money(amount: Column) -> Column:
    """Exact money. NaN and out-of-range amounts become NULL."""
    return amount.try_cast(MONEY)


def amount_usd(total: Column) -> Column:
    return cents(total).cast("double")


def cost_per(total: Column, count: Column) -> Column:
    """``total / count`` in cents, NULL when nothing was counted."""
    return amount_usd(F.try_divide(total, count))


def mean_count(total: Column, count: Column) -> Column:
    """Average of counts at two decimals, ties to even."""
    return F.bround(F.try_divide(total.cast("double"), count), 2)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed at this point and once.

    Catalyst otherwise copies the expressions behind a column into each filter and projection
    that uses it, which for a parsed document means parsing it again each time. A generator is
    a step it does not merge across.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def titled(df: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in titles.items() if k in df.columns})


def titled_value(c: Column, titles: Mapping[str, str]) -> Column:
    """Presentation label of a code; codes without one stay as they are."""
    return F.coalesce(lookup(c, titles), c)


def json_starts_with(text: Column, first: str) -> Column:
    """Whether the first character of a JSON text after its white space is ``first``."""
    return F.ltrim(text, F.lit(" \t\r\n")).startswith(first)
