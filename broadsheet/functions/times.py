"""UTC time helpers. ``as_of`` is always a parameter, never the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: str | datetime | Column) -> Column:
    """An ``as_of`` given as text, datetime or column, as TIMESTAMP_NTZ."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if isinstance(as_of, (datetime, date)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of.isoformat()
    return F.lit(as_of).cast("timestamp_ntz")


def days_before(as_of: str | datetime | Column, days: int) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since the epoch of a UTC TIMESTAMP_NTZ."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


# Zone names a mail-style date may carry, with their offsets.
ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
    "CET": "+0100", "CEST": "+0200", "EET": "+0200", "EEST": "+0300", "WET": "+0000", "WEST": "+0100",
    "BST": "+0100", "MSK": "+0300", "JST": "+0900", "KST": "+0900", "AEST": "+1000", "AEDT": "+1100",
}


def _to_utc(ts: Column) -> Column:
    """Session-zone TIMESTAMP to a TIMESTAMP_NTZ that reads as UTC."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def from_epoch(seconds: Column) -> Column:
    """UTC TIMESTAMP_NTZ of an epoch second count."""
    return _to_utc(F.timestamp_seconds(seconds))


def parse_feed_date(text: Column) -> Column:
    """A feed date (mail style or ISO 8601) in UTC at second precision, else null.

    A date without a zone counts as UTC, a year of two digits as one of this century.
    """
    # A mail-style date may end in a comment, as in "+0000 (UTC)".
    text = F.btrim(F.regexp_replace(text, r"\s*\([^()]*\)\s*$", ""))
    body = F.regexp_replace(text, r"^[A-Za-z]{2,9},?\s+", "")
    zone = F.upper(F.regexp_extract(body, r"([A-Za-z]{1,4})$", 1))
    names = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    offset = F.try_element_at(names, zone)
    mail = F.when(
        offset.isNotNull(), F.concat(F.regexp_replace(body, r"\s*[A-Za-z]{1,4}$", ""), F.lit(" "), offset)
    ).otherwise(body)
    mail = F.regexp_replace(mail, r"^(\d{1,2}\s+[A-Za-z]{3})\s+(\d\d)\s", "$1 20$2 ")
    parsed_mail = _to_utc(F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm[:ss] xx")))
    zoned = text.rlike(r"\d[T ]\d\d:\d\d.*(?:[Zz]|[+-]\d\d:?\d\d)$")
    iso = F.when(zoned, _to_utc(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))
    is_iso = text.rlike(r"^\d{4}-\d")
    return F.date_trunc("second", F.when(is_iso, iso).otherwise(parsed_mail)).cast("timestamp_ntz")
