"""Typed values from vendor text. Rejects are null, with a separate reject expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    CAP_BANDS,
    COMPACT_DATE_PATTERN,
    LAST_CAP_BAND,
    LISTED_CODE_PATTERN,
    MILLISECOND_THRESHOLD,
    PROJECT_TIME_ZONE,
)

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def finite(value: Column) -> Column:
    """Doubles with NaN and infinities as null: they mean a missing value."""
    value = value.cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def number(text: Column) -> Column:
    """A finite double from plain decimal text, else null. Booleans and NaN do not pass."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER), finite(trimmed.try_cast("double")))


def number_rejected(text: Column) -> Column:
    """Text that is there but is not a finite number."""
    return ~blank(text) & number(text).isNull()


def serving_number(text: Column) -> Column:
    """Number for display: anything that is not a finite number is null, never zero."""
    return number(text.cast("string"))


def _calendar_date(compact: Column) -> Column:
    return F.when(
        compact.rlike(COMPACT_DATE_PATTERN), F.try_to_date(compact, "yyyyMMdd")
    )


def compact_date(text: Column) -> Column:
    """``YYYYMMDD`` as a date; an impossible calendar date is null."""
    return _calendar_date(F.trim(text.cast("string")))


def loose_date(text: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD``."""
    return _calendar_date(F.regexp_replace(F.trim(text.cast("string")), "-", ""))


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def epoch_instant(number: Column) -> Column:
    """Instant from epoch seconds, or milliseconds where the number is too large for seconds."""
    value = number.cast("double")
    seconds = F.when(value > F.lit(float(MILLISECOND_THRESHOLD)), value / F.lit(1000.0)).otherwise(value)
    return F.timestamp_micros(F.round(seconds * F.lit(1_000_000.0)).cast("long"))


def variant_instant(value: Column, zone: str = PROJECT_TIME_ZONE) -> Column:
    """Instant of a JSON value: a number is an epoch, text is read by :func:`instant`."""
    shape = F.schema_of_variant(value)
    number = shape.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(number, epoch_instant(F.try_variant_get(value, "$", "double"))).otherwise(
        instant(F.when(shape == "STRING", F.try_variant_get(value, "$", "string")), zone)
    )


def instant(text: Column, zone: str = PROJECT_TIME_ZONE) -> Column:
    """Instant from ISO text with or without offset; digits alone are no instant.

    Text without an offset is local time in ``zone``.
    """
    trimmed = F.trim(text.cast("string"))
    iso = trimmed.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?$")
    zoned = trimmed.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & trimmed.contains(":")
    # Naive text is local time in ``zone`` whatever the session zone is.
    naive = F.convert_timezone(F.lit(zone), F.current_timezone(), trimmed.try_cast("timestamp_ntz")).cast("timestamp")
    return F.when(
        iso, F.when(zoned, trimmed.try_cast("timestamp")).otherwise(naive)
    )


def zone_text(moment: Column, zone: str = PROJECT_TIME_ZONE) -> Column:
    """ISO text of an instant at a fixed +08:00 offset, as ids are built on it."""
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), moment.cast("timestamp_ntz"))
    fraction = F.date_format(local, "SSSSSS")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+08:00"),
    )


def membership_list(items: Column) -> Column:
    """Trim, drop blanks, drop repeats, keep the first-seen order."""
    return F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != ""))


def membership_text(text: Column, separator: str = ";") -> Column:
    return membership_list(F.split(text, F.lit(f"\\Q{separator}\\E")))


def fund_type(memberships: Column, required: str) -> Column:
    """The required type when any membership mentions it, else null."""
    return F.when(F.exists(memberships, lambda m: F.upper(m).contains(required.upper())), F.lit(required))


def exchange_suffix(code: Column) -> Column:
    return F.substring_index(code, ".", -1)


def code_base(code: Column) -> Column:
    return F.substring_index(code, ".", 1)


def listed_code(code: Column) -> Column:
    """Upper-case code; six bare digits get ``.SH`` when they start with 6 or 5, else ``.SZ``."""
    upper = F.upper(F.trim(F.coalesce(code.cast("string"), F.lit(""))))
    return F.when(
        upper.rlike(r"^\d{6}$"),
        F.concat(upper, F.when(upper.rlike("^[65]"), F.lit(".SH")).otherwise(F.lit(".SZ"))),
    ).otherwise(upper)


def is_listed_code(code: Column, pattern: str = LISTED_CODE_PATTERN) -> Column:
    return F.coalesce(code.rlike(pattern), F.lit(False))


def currency(value: Column) -> Column:
    """Two decimals, halves up, as amounts of money are shown."""
    return F.round(value, 2)


def cap_band(market_cap: Column) -> Column:
    cap = F.coalesce(market_cap, F.lit(0.0))
    band = F.lit(LAST_CAP_BAND)
    for name, floor in reversed(CAP_BANDS):
        band = F.when(cap >= floor, F.lit(name)).otherwise(band)
    return band


def version_key(version: Column) -> Column:
    """A text whose byte order is the order of versions: numeric parts rank above text parts.

    Parts are compared one by one; a version that another one continues ranks below it. A number is written as
    its number of digits and its digits, so numbers of any length compare by value, and every part ends
    in a byte below all others.
    """
    parts = F.split(F.lower(F.coalesce(version, F.lit(""))), "[._+-]")

    def encoded(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=[0-9])", "")
        number = F.concat(F.lit("1"), F.lpad(F.length(digits).cast("string"), 9, "0"), digits)
        return F.when(part.rlike("^[0-9]+$"), number).otherwise(F.concat(F.lit("0"), part))

    return F.array_join(F.transform(parts, lambda p: F.concat(encoded(p), F.lit("\u0000"))), "")
