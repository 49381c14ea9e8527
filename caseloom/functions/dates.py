"""Date and timestamp expressions. Timestamps stay without zone, so results do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date format codes of the strftime family and their Spark pattern letters.
FORMAT_CODES = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%y": "yy",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "DDD",
    "%p": "a",
    "%I": "hh",
}

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spark_pattern(fmt: str) -> str:
    """Spark datetime pattern for a format written with % codes; other letters are quoted."""
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%":
            code = fmt[i : i + 2]
            if code not in FORMAT_CODES:
                raise ValueError(f"unsupported format code {code!r}")
            out.append(FORMAT_CODES[code])
            i += 2
        else:
            out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i])
            i += 1
    return "".join(out)


def round_day(c: Column | str) -> Column:
    """Start of the day (truncation, not rounding)."""
    return F.date_trunc("day", _col(c)).cast("timestamp_ntz")


def week_start(c: Column | str) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", _col(c)).cast("timestamp_ntz")


def quarter_start(c: Column | str) -> Column:
    return F.date_trunc("quarter", _col(c)).cast("timestamp_ntz")


def previous_week_monday(as_of: Column | str) -> Column:
    """Monday of the ISO week before the one that contains ``as_of``."""
    return week_start(as_of) - F.expr("interval 7 days")


def parse_timestamp(c: Column | str, fmt: str) -> Column:
    """Text to timestamp with a % format; unparsable text is null."""
    return F.try_to_timestamp(_col(c), F.lit(spark_pattern(fmt))).cast("timestamp_ntz")


def parse_month_first(c: Column | str) -> Column:
    """``7/1/2020`` style dates, one or two digits for month and day."""
    return F.try_to_timestamp(_col(c), F.lit("M/d/yyyy")).cast("timestamp_ntz")


def epoch_millis_to_timestamp(c: Column | str) -> Column:
    seconds = (_col(c).cast("decimal(20,3)") / 1000).cast("decimal(20,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(_col(c))


def iso_year(c: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(c))


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def add_days(c: Column | str, days: int) -> Column:
    return _col(c) + F.make_dt_interval(F.lit(days))


def format_timestamp(c: Column | str, fmt: str) -> Column:
    return F.date_format(_col(c), spark_pattern(fmt))


def first_sunday(c: Column | str) -> Column:
    """First Sunday on or after the date."""
    day = _col(c).cast("date")
    return F.date_add(day, (F.lit(8) - F.dayofweek(day)) % 7).cast("timestamp_ntz")
