"""Column expressions shared by all queries. All built-in, JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrosense.schemas import DATE_TEXT_FORMAT, DAY_FORMAT, HOUR_FORMAT, SEPARATOR, TIME_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


ON_ERROR = ("quarantine", "fail")


def _fail_on_null(parsed: Column, text: Column, what: str) -> Column:
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"not {what}: "), text))).otherwise(parsed)


def to_number(c, on_error: str = "quarantine") -> Column:
    """Text -> double. ``quarantine``: text that is not a number becomes null (rejected per
    query); ``fail``: the query stops with an error naming the text."""
    text = _col(c)
    parsed = text.try_cast("double")
    return _fail_on_null(parsed, text, "a number") if on_error == "fail" else parsed


def reading_time(text, on_error: str = "quarantine") -> Column:
    """Parse a reading's time text; null (or an error with ``fail``) when it does not match."""
    t = _col(text)
    parsed = F.try_to_timestamp(t, F.lit(TIME_FORMAT))
    return _fail_on_null(parsed, t, "a reading time") if on_error == "fail" else parsed


def day_key(text) -> Column:
    """Day key: the first ten characters of the time text (``yyyy-MM-dd``)."""
    return F.substring(_col(text), 1, 10)


def valid_day(text) -> Column:
    """The day key if it is a date, else null; the rest of the text does not matter."""
    day = day_key(text)
    return F.when(F.try_to_timestamp(day, F.lit(DAY_FORMAT)).isNotNull(), day)


def valid_hour(text) -> Column:
    """The hour key if it is a date and an hour, else null."""
    hour = hour_key(text)
    return F.when(hour_start(hour).isNotNull(), hour)


def hour_key(text) -> Column:
    """Hour key: the time text without its last six characters (``yyyy-MM-dd HH``)."""
    t = _col(text)
    return F.left(t, F.length(t) - 6)


def hour_text(ts) -> Column:
    """Hour key rendered from a timestamp (streaming windows)."""
    return F.date_format(_col(ts), HOUR_FORMAT)


def hour_start(hour) -> Column:
    """Parse an hour key back to the instant it starts, in the session zone."""
    return F.try_to_timestamp(_col(hour), F.lit(HOUR_FORMAT))


def date_text(ts) -> Column:
    """``java.util.Date#toString`` layout, e.g. ``Thu Jan 02 03:00:00 UTC 2020``."""
    return F.date_format(_col(ts), DATE_TEXT_FORMAT)


def interval_text(start, hours: int) -> Column:
    """``<start> -> <start + hours>`` in ``Date#toString`` layout."""
    s = _col(start)
    end = s + F.make_dt_interval(F.lit(0), F.lit(hours))
    return F.concat(date_text(s), F.lit(" -> "), date_text(end))


def _num(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def _not_nan(c: Column) -> Column:
    return ~F.isnan(c)


def java_gt(a, b) -> Column:
    """``a > b`` with Java double semantics: false when either side is NaN.

    Spark orders NaN above every number, so a bare ``>`` would alert on NaN.
    """
    a = _col(a)
    cond = (a > _num(b)) & _not_nan(a)
    return cond & _not_nan(b) if isinstance(b, Column) else cond


def java_lt(a, b) -> Column:
    """``a < b`` with Java double semantics: false when either side is NaN."""
    a = _col(a)
    cond = (a < _num(b)) & _not_nan(a)
    return cond & _not_nan(b) if isinstance(b, Column) else cond


def round_half_up(c, digits: int | None) -> Column:
    """Round half-up on the decimal value (``1.005 -> 1.01``); ``None`` leaves it as is."""
    c = _col(c)
    return c if digits is None else F.round(c, digits)


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 (Java would give +-Infinity or NaN)."""
    return F.try_divide(_col(num), _col(den))


# A field is quoted when it begins with a quote; a quote inside it is doubled. The patterns
# see the line behind one more separator, so that every field has one before it.
QUOTED_FIELD = r'"[^"]*+(?:""[^"]*+)*+"(?=;|\z)'


def has_quoted_field(line) -> Column:
    """Whether any field begins with a quote (a quote further inside is an ordinary character)."""
    return F.concat(F.lit(SEPARATOR), _col(line)).contains(SEPARATOR + '"')


def _without_quoted(line) -> Column:
    return F.regexp_replace(F.concat(F.lit(SEPARATOR), _col(line)), SEPARATOR + QUOTED_FIELD, SEPARATOR)


def bad_quote(line) -> Column:
    """Whether a field begins with a quote that does not close it."""
    return has_quoted_field(line) & _without_quoted(line).contains(SEPARATOR + '"')


def line_fields(line) -> Column:
    """All fields of a line as an array; null for a null line or one with a bad quote."""
    v = _col(line)
    quoted = F.regexp_extract_all(F.concat(F.lit(SEPARATOR), v),
                                  F.lit(f"{SEPARATOR}({QUOTED_FIELD}|[^{SEPARATOR}]*+)"), F.lit(1))
    unquoted = F.transform(quoted, lambda x: F.when(
        x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(x))
    return (F.when(~has_quoted_field(v), F.split(v, SEPARATOR, -1))
            .when(~bad_quote(v), unquoted))


def field_count(line) -> Column:
    """Number of fields of a line, ignoring separators inside quoted fields; 0 for null."""
    v = _col(line)
    return F.coalesce(F.when(has_quoted_field(v), F.size(F.split(_without_quoted(v), SEPARATOR, -1)) - 1)
                      .otherwise(F.size(F.split(v, SEPARATOR, -1))), F.lit(0))
