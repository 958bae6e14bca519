"""Column expressions that pin down the null, rounding and division rules of the marts.

Every helper returns a ``Column`` built from Spark built-ins, so it stays inside
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchlens.fixed_values import (CURRENCY_PREFIX, DAY_FIRST_DATE_PATTERN, DECIMAL_SEPARATOR,
                                     NAME_ELLIPSIS, NAME_MAX_CHARS, THOUSANDS_SEPARATOR)

MONEY = "decimal(18,2)"
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_cancelled(c="canceled") -> Column:
    """Keep rows whose flag is false *or null* (only an explicit true cancels)."""
    return ~col_(c).eqNullSafe(F.lit(True))


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Grouping drops rows whose grouping key is null (pandas ``groupby`` semantics)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def sum_or_zero(c, zero_type: str | None = None) -> Column:
    """Sum where an empty or all-null input is 0, not null."""
    zero = F.lit(0) if zero_type is None else F.lit(0).cast(zero_type)
    return F.coalesce(F.sum(col_(c)), zero)


def round_half_even(c, digits: int = 0) -> Column:
    """Half-to-even rounding on DOUBLE, done as scale - rint - unscale.

    ``rint`` is IEEE round-half-even; scaling first reproduces numpy's
    ``round(x, 2)`` exactly (``bround`` on doubles differs on some ties).
    """
    x = col_(c).cast("double")
    if digits == 0:
        return F.rint(x)
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def safe_ratio(num, den) -> Column:
    """Division that yields null instead of an error / infinity when ``den`` is 0."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def growth_pct(cur, prev) -> Column:
    """(cur - prev) / prev * 100, null when prev is 0."""
    return safe_ratio(col_(cur) - col_(prev), prev) * F.lit(100.0)


def to_double(c) -> Column:
    return col_(c).cast("double")


def day_of(c) -> Column:
    """Calendar day of a (zone-less) timestamp."""
    return F.to_date(col_(c))


def month_of(c) -> Column:
    """Month bucket as ``yyyy-MM`` text."""
    return F.date_format(col_(c), "yyyy-MM")


def previous_calendar_month(as_of) -> Column:
    """First of the month minus one day, as ``yyyy-MM``."""
    return F.date_format(F.date_sub(F.trunc(col_(as_of), "MM"), 1), "yyyy-MM")


def shifted_month(as_of, days: int) -> Column:
    """``as_of`` moved by whole days, formatted as month (the +-30-day month of bookings).

    This is deliberately not calendar arithmetic: on the 31st the month 30 days back
    is the current month, and on 31 January +30 days skips February.
    """
    return F.date_format(F.date_add(col_(as_of), days), "yyyy-MM")


def truncate_name(c, n: int = NAME_MAX_CHARS) -> Column:
    """Names longer than ``n`` characters become their first ``n`` characters + '...'."""
    c = col_(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(NAME_ELLIPSIS))).otherwise(c)


def title_case(c) -> Column:
    """Upper-case the first letter after any non-letter, lower-case the rest.

    ``initcap`` only starts words after spaces; this splits the text into runs of
    letters and runs of non-letters and capitalises every run.
    """
    runs = F.regexp_extract_all(F.lower(col_(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    caps = F.transform(runs, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30)))
    return F.when(col_(c).isNull(), F.lit(None)).otherwise(F.array_join(caps, ""))


def number(c) -> Column:
    """Text -> double, null unless the whole text is a number. Spark's own cast also takes
    Java's type suffixes ('12d', '12f'), which are not numbers in the landed text."""
    c = col_(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def parse_currency(c) -> Column:
    """'AR$ 1.234,50' -> 1234.5; unparsable text -> 0.0; null -> null."""
    c = col_(c)
    cleaned = F.trim(F.replace(F.replace(F.replace(c, F.lit(CURRENCY_PREFIX), F.lit("")),
                                         F.lit(THOUSANDS_SEPARATOR), F.lit("")),
                               F.lit(DECIMAL_SEPARATOR), F.lit(".")))
    return F.when(c.isNull(), F.lit(None).cast("double")) \
        .otherwise(F.coalesce(number(cleaned), F.lit(0.0)))


def parse_day_first_date(c) -> Column:
    """Day-first date text (``3/1/2025``, ``03/01/2025``, or a space-padded day
    ``' 3/1/2025'``) -> date; anything else (two-digit years, other separators, impossible
    dates, trailing blanks) -> null."""
    unpadded = F.regexp_replace(col_(c), r"^ ([1-9]/)", "$1")
    return F.try_to_date(unpadded, DAY_FIRST_DATE_PATTERN)


def iso_date_text(c) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def coerce_int(c) -> Column:
    """Text -> int: numeric text is truncated (7.9 -> 7), anything else -> 0."""
    return F.coalesce(number(c).try_cast("int"), F.lit(0))


def numeric_id(c) -> Column:
    """Id text -> bigint: integer text exactly, other numeric text truncated
    ('12.5' -> 12, '1e3' -> 1000), anything else null."""
    return F.coalesce(col_(c).try_cast("bigint"), number(c).try_cast("bigint"))


def strip_zone(c) -> Column:
    """ISO timestamp text with an offset -> zone-less timestamp keeping the wall clock."""
    no_zone = F.regexp_replace(col_(c), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return no_zone.try_cast("timestamp_ntz")


def stay_seconds(created, closed) -> Column:
    """Seconds between two ISO timestamp texts as instants (their offsets may differ);
    null if either is missing or unparsable."""
    a, b = (F.try_to_timestamp(col_(c)) for c in (created, closed))
    return F.timestamp_diff("SECOND", a, b)
