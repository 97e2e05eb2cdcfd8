"""Dates and times that arrive as text in several layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, WORD, _col, falsy_to_null, whole_number

# English month names, by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_N = r"\p{Nd}"
_CLOCK = rf"{SPACE}*({_N}{{1,2}}):({_N}{{2}}):({_N}{{2}})(?:{SPACE}*([AP]M))?"
_DAY_FIRST = rf"(?U)({_N}{{1,2}}) ({WORD}{{3,}}) ({_N}{{4}}),{_CLOCK}"
# a word is taken from its start, where a search finds it first anyway: else a long one costs its length squared
_MONTH_FIRST = rf"(?U)(?<!{WORD})({WORD}{{3,}}) ({_N}{{1,2}}), ({_N}{{4}}),{_CLOCK}"


def hour_of_day(hour: Column, half) -> Column:
    """An hour of a twelve-hour clock on the 24-hour one; as it is where there is no AM or PM."""
    half = _col(half)
    return F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "PM", 12).otherwise(0))


def locale_stamp(cell) -> Column:
    """ISO text of the first day-first stamp in a cell, else of the first month-first one; null for a month that is not English.

    Digits of any script count; those of the year stay as they are written."""
    cell = _col(cell)

    def parsed(pattern: str, day: int, month: int) -> Column:
        def part(i):
            return F.regexp_extract(cell, pattern, i)

        name = F.lower(F.substr(part(month), F.lit(1), F.lit(3)))
        number = F.array_position(F.array(*map(F.lit, MONTHS)), name)

        def two(c):
            return F.lpad(c.cast("string"), 2, "0")

        date = F.concat_ws("-", part(3), two(number), two(whole_number(part(day))))
        time = F.concat_ws(":", two(hour_of_day(whole_number(part(4)), part(7))), two(whole_number(part(5))), two(whole_number(part(6))))
        return F.when(number > 0, F.concat(date, F.lit("T"), time))

    return F.when(cell.rlike(_DAY_FIRST), parsed(_DAY_FIRST, 1, 2)).when(cell.rlike(_MONTH_FIRST), parsed(_MONTH_FIRST, 2, 1))


_HOUR, _SIXTY, _PART = r"(?:[01]\d|2[0-3])", r"[0-5]\d", r"(?:[.,]\d+)?"
_TIME = rf"{_HOUR}(?:(?::{_SIXTY}(?::{_SIXTY}{_PART})?)|(?:{_SIXTY}(?:{_SIXTY}{_PART})?))?"
_ZONE = rf"(?:Z|[+-]{_HOUR}(?::?{_SIXTY}(?::?{_SIXTY}{_PART})?)?)?"
_ISO = rf"(?s)\A(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})(?:.{_TIME}{_ZONE})?\z"


def iso_day(c) -> Column:
    """The date as recorded in an ISO text (offsets do not move it); null for what is no valid date and time."""
    c = _col(c)
    day = F.regexp_extract(c, _ISO, 1)  # empty where nothing fits, and that is no date
    dashed = F.when(F.length(day) == 8, F.concat_ws("-", F.substr(day, F.lit(1), F.lit(4)), F.substr(day, F.lit(5), F.lit(2)), F.substr(day, F.lit(7), F.lit(2)))).otherwise(day)
    return dashed.try_cast("date")


def from_epoch_1601(us) -> Column:
    """Microseconds since 1601 as UTC text; null where null."""
    return _utc_text(_whole_seconds(us) - 11_644_473_600)


def from_epoch_1970(us) -> Column:
    return _utc_text(_whole_seconds(us))


def _whole_seconds(us) -> Column:
    """Whole seconds of microseconds, in whole numbers: since 1601 they are beyond what a double holds."""
    us, million = _col(us), F.lit(1_000_000).cast("long")
    return F.call_function("div", us - F.pmod(us, million), million)


def _utc_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


def visited_at(c) -> Column:
    """A browser's time, null where it was never visited (empty, or the year 1601)."""
    c = falsy_to_null(c)
    return F.when(~c.startswith("1601"), c)


def days_between(first, last) -> Column:
    return F.coalesce(F.datediff(_col(last), _col(first)), F.lit(0)).cast("long")
