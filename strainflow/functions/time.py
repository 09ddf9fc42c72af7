"""Dates and times of day on columns. A time of day is its seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strainflow.functions.text import BLANKS


def tried_date(x: Column) -> Column:
    """Year-first or day-first text, or days since 1970, as a date; null for other text. A format is
    tried on texts that have its separator, since each failed try costs a row its exceptions."""
    text = F.nullif(F.trim(x.cast("string")), F.lit(""))
    days = F.when(text.rlike("^-?[0-9]{1,6}$"), F.date_add(F.lit("1970-01-01").cast("date"), text.try_cast("int")))
    return F.coalesce(F.when(text.contains("-"), F.try_to_date(text, "yyyy-MM-dd")), F.when(text.contains("/"), F.try_to_date(text, "dd/MM/yyyy")), days)


def date(x: Column) -> Column:
    """tried_date(); other text raises when it is used."""
    text, found = F.nullif(F.trim(x.cast("string")), F.lit("")), tried_date(x)
    return F.when(found.isNull() & text.isNotNull(), F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")).otherwise(found)


def seconds(x: Column) -> Column:
    """H:MM or H:MM:SS as seconds of the day. One pattern; the parts of what fits it are cut at the colons."""
    text = F.btrim(x, F.lit(BLANKS))
    hour, last = F.substring_index(text, ":", 1), F.substring_index(text, ":", -1)
    minute = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    second = F.when(F.length(text) > F.length(hour) + 3, last.try_cast("int")).otherwise(0)
    return F.when(text.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), hour.try_cast("int") * 3600 + minute.try_cast("int") * 60 + second)


def sort_key(x: Column) -> Column:
    """Times in mixed forms as text that sorts: the first H:MM or H:MM:SS in x as HH:MM:SS, else x itself
    in its place among texts. Tokens that are no time of day, such as 25:00, stay as they are."""
    plain = F.nullif(F.regexp_replace(x.cast("string"), r"^\s+|\s+$", ""), F.lit(""))
    plain = F.when(~plain.isin("NA", "N/A"), plain)
    found = F.regexp_extract(plain, r"([0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)", 1)
    token = F.when(found != "", found).otherwise(plain)
    part = lambda k: F.regexp_extract(token, r"^([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?$", k)
    hour, minute, second = (F.nullif(part(k), F.lit("")).try_cast("int") for k in (1, 2, 3))
    second = F.coalesce(second, F.lit(0))
    good = (hour < 24) & (minute < 60) & (second < 62)
    return F.when(good, F.format_string("%02d:%02d:%02d", hour, minute, second)).otherwise(token)


def clock_status(day: Column, second: Column, zone: str = "Europe/Paris") -> Column:
    """missing_date_or_time, invalid_time_of_day, nonexistent_local_time, ambiguous_local_time or
    valid: what a wall clock in the zone says of that moment."""
    local = F.to_utc_timestamp(F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400 + second), zone)
    back = F.unix_timestamp(F.from_utc_timestamp(local, zone)) - F.unix_date(day).cast("bigint") * 86400
    shown = lambda hours: F.unix_timestamp(F.from_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(local) + hours * 3600), zone)) - F.unix_date(day).cast("bigint") * 86400
    return (
        F.when(day.isNull() | second.isNull(), "missing_date_or_time")
        .when((second < 0) | (second >= 86400), "invalid_time_of_day")
        .when(back != second, "nonexistent_local_time")
        .when((shown(1) == second) | (shown(-1) == second), "ambiguous_local_time")
        .otherwise("valid")
    )


def nights(entry: Column, exit_: Column) -> Column:
    """Midnights between two times: the difference of their dates."""
    return F.datediff(F.to_date(exit_), F.to_date(entry))
