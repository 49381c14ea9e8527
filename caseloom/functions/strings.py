"""String, JSON and number-format expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_replace(c: Column | str, old: str, new: str) -> Column:
    return F.replace(_col(c), F.lit(old), F.lit(new))


def parse_number(c: Column | str, thousands: str = ",", kind: str = "int") -> Column:
    """Number held as text with thousand separators; text that is no number becomes null."""
    return F.trim(literal_replace(c, thousands, "")).try_cast(kind)


def occurrences(c: Column | str, literal: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    text = _col(c)
    removed = F.length(literal_replace(text, literal, ""))
    return ((F.length(text) - removed) / len(literal)).cast("bigint")


def slug(*parts: Column | str) -> Column:
    """Parts joined with ``_``, spaces turned into ``_``."""
    return literal_replace(F.concat_ws("_", *[_col(p).cast("string") for p in parts]), " ", "_")


def extract_field(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null when nothing matches."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def repair_encoding(c: Column | str) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; anything that is not such text stays as it is."""
    text = _col(c)
    redone = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(text.rlike(r"^[\x00-\xFF]*$"), F.coalesce(redone, text)).otherwise(text)


def plain_decimal(c: Column | str) -> Column:
    """Number as text in positional notation with the shortest digits (``23.0``, ``10000000.0``), whatever its magnitude."""
    text = _col(c).cast("string")
    # Every name stands for a column bound once by a lambda: spelt out, the expression would be evaluated many times over.
    parts = r"^(-?)(\d+)(?:\.(\d+))?(?:E([-+]?\d+))?$"

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def split(number: Column) -> Column:
        whole, after = F.regexp_extract(number, parts, 2), F.rtrim(F.regexp_extract(number, parts, 3), F.lit("0"))
        point = F.length(whole) + F.coalesce(F.regexp_extract(number, parts, 4).try_cast("int"), F.lit(0))
        return F.struct(F.regexp_extract(number, parts, 1).alias("sign"), F.concat(whole, after).alias("digits"), point.alias("point"))

    def fill(p: Column) -> Column:
        filled = F.concat(F.repeat(F.lit("0"), F.greatest(1 - p["point"], F.lit(0))), p["digits"])
        return F.struct(p["sign"].alias("sign"), F.rpad(filled, F.greatest(F.length(filled), p["point"]), "0").alias("filled"), F.greatest(p["point"], F.lit(1)).alias("at"))

    def put(p: Column) -> Column:
        left, right = F.ltrim(F.substr(p["filled"], F.lit(1), p["at"]), F.lit("0")), F.substr(p["filled"], p["at"] + 1, F.length(p["filled"]))
        return F.concat(p["sign"], F.when(left == "", "0").otherwise(left), F.lit("."), F.when(right == "", "0").otherwise(right))

    def plain(number: Column) -> Column:
        moved = bound(split(number), lambda p: bound(fill(p), put))
        # Most numbers are written this way already.
        return F.when(number.rlike(r"^-?(?:0|[1-9]\d*)\.(?:0|\d*[1-9])$"), number).when(number.rlike(parts), moved).otherwise(number)

    return bound(text, plain)


def decimal_comma(c: Column | str) -> Column:
    return F.translate(plain_decimal(c), ".", ",")


def to_json_record(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def safe_identifier(c: Column | str) -> Column:
    """Parentheses dropped, every other run of non-alphanumerics turned into one ``_`` (the pattern is a fixed value)."""
    return F.regexp_replace(F.translate(_col(c), "()", ""), "[^0-9a-zA-Z]+", "_")
