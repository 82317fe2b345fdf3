"""Column expressions. Everything here is a built-in Spark function; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space characters that a trim removes on both ends.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003"
    "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The label of a blank dimension and the null marker inside surrogate keys.
UNKNOWN = "Unknown"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(trim_ws(c) == "", F.lit(True))


def clean_dim(c: Column | str) -> Column:
    """Trimmed dimension value; blank or missing becomes ``Unknown``."""
    return F.when(is_blank(c), UNKNOWN).otherwise(trim_ws(c))


def len0(c: Column | str) -> Column:
    """Array length with null counted as empty."""
    return F.coalesce(F.array_size(_col(c)), F.lit(0))


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double, null when ``b`` is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def pct(a: Column, b: Column, digits: int) -> Column:
    """Rounded percentage of two numbers, null when ``b`` is zero."""
    return F.round(F.lit(100.0) * a / F.nullif(b.cast("double"), F.lit(0.0)), digits)


def growth_pct(now: Column, before: Column, digits: int = 1) -> Column:
    """Change in percent against a previous count; null unless that count is positive."""
    return F.when(before > 0, F.round(F.lit(100.0) * (now - before) / before, digits))


def decade(year: Column | str) -> Column:
    return (F.floor(_col(year) / 10) * 10).cast("int")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def surrogate_key(*cols: str) -> Column:
    """MD5 over the columns joined with ``-``, nulls replaced by a marker."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def full_name(first: Column, middle: Column, last: Column) -> Column:
    """Name parts joined by single blanks. A missing middle name leaves two blanks inside."""
    empty = F.lit("")
    return trim_ws(
        F.concat(
            F.coalesce(first, empty), F.lit(" "),
            F.coalesce(middle, empty), F.lit(" "),
            F.coalesce(last, empty),
        )
    )


def label(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """First matching rule wins; a null condition does not match."""
    out = F.lit(default).cast("string")
    for condition, text in reversed(rules):
        out = F.when(condition, F.lit(text)).otherwise(out)
    return out


def coerce_long(text: Column) -> Column:
    """Integer-valued text to bigint; anything else to null. A fraction counts however small it is.

    Plain digits are told by one look; only other spellings are trimmed and taken apart.
    """
    value = trim_ws(text)
    whole = F.regexp_extract(value, r"^([+-]?\d+)(?:\.0*)?$", 1)
    scaled = value.try_cast("double")  # with an exponent
    exact = (scaled == F.floor(scaled)) & (F.abs(scaled) < 2**53)
    plain = text.rlike(r"^[+-]?\d+\z")
    return F.when(plain, text.try_cast("bigint")).when(whole != "", whole.try_cast("bigint")).when(
        value.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)[eE][+-]?\d+$") & exact, scaled.try_cast("bigint")
    )


def not_integer(text: Column) -> Column:
    """True for a present value that is not an integer."""
    return text.isNotNull() & coerce_long(text).isNull()


def parse_day(text: Column) -> Column:
    """Date from the first ten characters, null when they are no date."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-M-d")


def number_text(c: Column | str, digits: int = 0) -> Column:
    """Display text with thousands separators, ``N/A`` for null; no digits means truncation."""
    value = _col(c)
    if digits == 0:
        value = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value))
    return F.coalesce(F.format_number(value, digits), F.lit("N/A"))


def percent_text(c: Column | str, digits: int = 1) -> Column:
    """Display text with a percent sign, ``N/A`` for null."""
    value = F.format_string(f"%.{digits}f%%", _col(c).cast("double"))
    return F.when(_col(c).isNull(), F.lit("N/A")).otherwise(value)


def n_rows() -> Column:
    return F.count(F.lit(1))
