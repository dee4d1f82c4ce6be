"""Column expressions for cleaning, typing and deriving. All of them compile to
JVM expressions; none needs a Python worker."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 4)
MONEY_SUM = T.DecimalType(38, 2)


# -- text --------------------------------------------------------------------

def clean_tax_id(c: Column) -> Column:
    """Digits only, 14 of them, zero-padded on the left. Stays text."""
    return F.lpad(F.regexp_replace(c, r"\D", ""), 14, "0")


def tax_id_digits(c: Column) -> Column:
    """How many digits the source really had; 0 or more than 14 is suspect."""
    return F.length(F.regexp_replace(c, r"\D", ""))


def clean_name(c: Column) -> Column:
    return F.regexp_replace(F.initcap(c), " {2,}", " ")


def clean_zip(c: Column) -> Column:
    return F.lpad(c, 5, "0")


def contains_term(cols: Iterable[Column], term: Column | str) -> Column:
    """Any column contains the term, ignoring case; % and _ are plain text."""
    needle = F.lower(F.lit(term) if isinstance(term, str) else term)
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.contains(F.lower(c), needle), F.lit(False))
    return hit


# -- dates -------------------------------------------------------------------

def parse_date_iso(c: Column) -> Column:
    return F.try_to_date(c)


def parse_date_multi(c: Column, formats: Sequence[str] = ("dd/MM/yyyy",)) -> Column:
    """ISO first, then each pattern in turn; NULL if none fits."""
    return F.coalesce(F.try_to_date(c), *[F.try_to_date(c, f) for f in formats])


def parse_ts_lenient(c: Column) -> Column:
    return F.try_to_timestamp(c)


def day(value: Column | str) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def months_span(later: Column, earlier: Column) -> Column:
    """Fractional months between two dates, never less than one."""
    return F.greatest(F.lit(1.0), F.months_between(later, earlier))


def in_band(date: Column, start: Column, days: int, bounded_below: bool) -> Column:
    """Before start + days; with a lower bound only from start on."""
    inside = date < F.date_add(start, days)
    return inside & (date >= start) if bounded_below else inside


# -- numbers -----------------------------------------------------------------

def money(c: Column) -> Column:
    return c.cast(MONEY)


def rate(c: Column) -> Column:
    return c.cast(RATE)


def whole(c: Column) -> Column:
    return c.try_cast("int")


def lenient(c: Column, data_type: T.DataType | str) -> Column:
    return c.try_cast(data_type)


def total(c: Column) -> Column:
    """Sum of money in the one result type all money results have."""
    return F.sum(c).cast(MONEY_SUM)


EXACT = T.DecimalType(28, 2)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double; NULL for a zero denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def money_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Ratio of money or counts, divided and rounded as decimals so that halves
    round up, then a double; NULL for a zero denominator."""
    bottom = denominator.cast(EXACT)
    exact = numerator.cast(EXACT) / F.when(bottom != 0, bottom)
    return F.round(exact, places).cast("double")


def pct_ratio(numerator: Column, denominator: Column, places: int = 1) -> Column:
    return money_ratio(100 * numerator.cast(EXACT), denominator, places)


# -- flags and labels ----------------------------------------------------------

def flag_from_code(c: Column, code: str) -> Column:
    return c == code


def banded(rules: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """The label of the first rule that holds."""
    first, *rest = rules
    out = F.when(first[0], first[1])
    for condition, label in rest:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def chosen(c: Column, values: Sequence[object] | None) -> Column:
    """Multi-choice filter; nothing chosen keeps everything."""
    return c.isin(*values) if values else F.lit(True)


def one_hot(c: Column, levels: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per known level; an unknown level is all zeros."""
    return [F.when(c == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in levels]


def fail_if(condition: Column, message: Column | str, passed: Column | str = "ok") -> Column:
    """Raises when the condition holds, from inside a query."""
    text = F.lit(message) if isinstance(message, str) else message
    good = F.lit(passed) if isinstance(passed, str) else passed
    return F.when(condition, F.raise_error(text).cast("string")).otherwise(good)


def stamped(df: DataFrame, source: DataFrame) -> DataFrame:
    """Processing time and how many rows the source held. The count is a
    subquery over the source, answered from file footers for a stored table."""
    return df.withColumns({
        "processed_at": F.current_timestamp(),
        "source_rows": source.agg(F.count(F.lit(1))).scalar(),
    })
