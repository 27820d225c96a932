"""Cleaning rules for raw text columns, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators, which Java leaves out of \s.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_NOT_PLAIN = r"[^ -~]"
MAX_DOUBLE = 1.7976931348623157e308

# Tried in order; the first that parses wins. Brackets are alternatives: compact
# and slashed days, and ISO years, months, days and times; then slashed and dashed
# days with a time or two-digit years, days with month names, and twelve-hour
# times. Days with a numbered month are month first, and day first only where the
# month would be impossible.
DATE_PATTERNS: tuple[str, ...] = (
    "[yyyyMMdd][M/d/yyyy][yyyy/M/d][yyyy[-M[-d[['T'][ ]H:m[:s][.SSSSSSSSS]]]]]",
    "[M/d/yyyy H:m[:s]][M/d/yy[ H:m[:s]]][M-d-yyyy[ H:m[:s]]][yyyy-M-d h:m[:s] a]",
    "[MMM d, yyyy][d MMM yyyy]",
    "[MMMM d, yyyy][d MMMM yyyy]",
    "[d/M/yyyy[ H:m[:s]]][d-M-yyyy[ H:m[:s]]][d/M/yy]",
)

# A time zone after a time does not move the day that is written.
_ZONE = r"(:[0-9.]+)\s*(Z|UTC|[+-]\d{2}:?\d{2})$"

# The plain form of a day: a cast reads it like the first pattern does, several times as fast.
_ISO_DAY = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"

TRUE_WORDS = ("true", "1", "yes", "t")
DEFAULT_COUNTRY = "GLOBAL"


def clean_text(col: Column) -> Column:
    """Collapse white space, trim; text that ends up empty is null."""
    # Printable ASCII without spaces to collapse or trim stays as it is: told several times as fast.
    odd = col.rlike(_NOT_PLAIN) | col.contains("  ") | col.startswith(" ") | col.endswith(" ")
    text = F.when(odd, F.trim(F.regexp_replace(col, _SPACES, " "))).otherwise(col)
    return F.nullif(text, F.lit(""))


def to_number(col: Column) -> Column:
    """Text as double, null where it is no number."""
    # A cast would also read type suffixes, as in '1d', and hex numbers, as in '0x1p0': cells with
    # the letters of both are none. No number has a p without an x.
    lettered = reduce(lambda a, b: a | b, [col.contains(letter) for letter in "dDfFxX"])
    return F.when(~lettered, col.try_cast("double"))


def in_range(
    number: Column, lo: float | None = None, hi: float | None = None, default: float | None = None
) -> Column:
    """Finite number within [lo, hi]; anything else becomes ``default``."""
    low = -MAX_DOUBLE if lo is None else float(lo)
    high = MAX_DOUBLE if hi is None else float(hi)
    fallback = F.lit(None if default is None else float(default)).cast("double")
    return F.when(number.between(low, high), number).otherwise(fallback)


def clean_numeric(
    col: Column, lo: float | None = None, hi: float | None = None, default: float | None = None
) -> Column:
    """Text as number within [lo, hi]; anything else becomes ``default``."""
    return in_range(to_number(col), lo, hi, default)


def clean_boolean(col: Column) -> Column:
    """True for the known true words in any case, without trimming."""
    return F.coalesce(F.lower(col).isin(*TRUE_WORDS), F.lit(False))


def clean_date(col: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Date from the first pattern that fits, else null."""
    plain = F.trim(col)
    text = F.nullif(F.regexp_replace(plain, _ZONE, "$1"), F.lit(""))
    iso = [F.when(plain.rlike(_ISO_DAY), plain.try_cast("date"))] if patterns is DATE_PATTERNS else []
    return F.coalesce(*iso, *[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])


def split_artists(col: Column) -> Column:
    """Comma list as an array of clean names, empty parts dropped, order and repeats kept."""
    names = F.filter(F.transform(F.split(col, ","), clean_text), lambda name: name.isNotNull())
    return F.coalesce(names, F.array().cast("array<string>"))


def clean_country(col: Column) -> Column:
    """Country code, with the default member for a missing one."""
    return F.coalesce(clean_text(col), F.lit(DEFAULT_COUNTRY))


def clean_mode(col: Column) -> Column:
    """Musical mode as 0 or 1; a missing one is 1."""
    return mode_of(to_number(col))


def mode_of(number: Column) -> Column:
    """Musical mode of a parsed number."""
    return F.when(in_range(number, default=1) >= 0.5, 1).otherwise(0)
