"""Feed and record dates as column expressions, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.text import collapse_spaces

# Month names and zone names of mail-style dates.
_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
_ZONES = {
    "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "Z": "+00:00", "AST": "-04:00", "ADT": "-03:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00",
    "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_MONTH = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in _MONTHS) + ")"
# Groups: day and month in either order, year, hour, minute, second, zone. Anything else matches the
# last alternative, which leaves all groups empty.
_MAIL = (
    r"(?is)^(?:[^ ]*,|mon|tue|wed|thu|fri|sat|sun)? ?"
    rf"(?:(\d{{1,2}}),?[ -]{_MONTH}|{_MONTH},?[ -](\d{{1,2}}),?),?[ -](\d{{4}}|\d{{2}}),? "
    r"(\d{1,2})[:.](\d{1,2})(?:[:.](\d{1,2}))?,?(?: ?([a-z]+|[+-]\d{4}))?(?: .*)?$"
    r"|^.*$"
)
_MARK = "\x01"
_MAIL_PARTS = _MARK.join(["$1$4", "$2$3", "$5", "$6", "$7", "$8", "$9"])

_ZONE = r"(?:Z|[+-]\d{2}:?\d{2}(?::\d{2})?)"
_ISO = rf"(?s)^(\d{{4}}-\d{{2}}-\d{{2}})(?:[T ](\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d{{1,9}})?)?)({_ZONE})?)?$|^.*$"


def _look_up(names: dict[str, str], name: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for item in names.items() for x in item]), name)


def iso_date(value: Column) -> Column:
    """An ISO date or time; no zone means UTC; null when it is not one."""
    text = F.regexp_replace(F.translate(value, ",", "."), r"^(\d{4})(\d{2})(\d{2})(?=T|$)", "$1-$2-$3")
    text = F.regexp_replace(text, rf"([T ]\d{{2}})(?={_ZONE}?$)", "$1:00")
    text = F.regexp_replace(text, rf"T(\d{{2}})(\d{{2}})(?={_ZONE}?$)", "T$1:$2")
    text = F.regexp_replace(text, rf"([T ]\d{{2}}:\d{{2}})(?={_ZONE}?$)", "$1:00")
    text = F.regexp_replace(text, rf"T(\d{{2}})(\d{{2}})(\d{{2}})(?=(?:\.\d+)?{_ZONE}?$)", "T$1:$2:$3")
    return F.regexp_replace(text, _ISO, "$1 $2$3").try_cast("timestamp")


def with_feed_date(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Add the date of a feed item: mail style such as ``Wed, 01 May 2024 10:00:00 +0200``, else ISO,
    else null. Built in steps, so that the text is matched once per row."""
    parts = F.col("_parts")
    year, zone = parts[2], parts[6]
    century = F.when(F.length(year) == 4, "").when(year > "68", "19").otherwise("20")
    month = _look_up({m[:3]: f"{i:02d}" for i, m in enumerate(_MONTHS, 1)}, F.lower(F.left(parts[1], F.lit(3))))
    numeric = F.concat(F.left(zone, F.lit(3)), F.lit(":"), F.right(zone, F.lit(2)))
    offset = F.when(zone.rlike("^[+-]"), numeric).otherwise(F.coalesce(_look_up(_ZONES, F.upper(zone)), F.lit("+00:00")))
    second = F.when(parts[5] == "", "0").otherwise(parts[5])
    day = F.concat(century, year, F.lit("-"), month, F.lit("-"), parts[0])
    clock = F.concat(parts[3], F.lit(":"), parts[4], F.lit(":"), second)
    # Put into ISO form and cast: a failed cast of a timestamp is cheap.
    mail = F.concat(day, F.lit(" "), clock, offset).try_cast("timestamp")
    matched = F.split(F.regexp_replace(collapse_spaces(F.col(value)), _MAIL, _MAIL_PARTS), _MARK)
    return rows.withColumn("_parts", matched).withColumn(name, F.coalesce(mail, iso_date(F.col(value)))).drop("_parts")


def record_date(value: Column, what: str) -> Column:
    """The date of a stored record: empty gives null, anything unreadable stops the job."""
    complaint = F.raise_error(F.concat(F.lit(f"unreadable {what}: "), value)).cast("timestamp")
    return F.coalesce(iso_date(value), F.when(F.coalesce(value, F.lit("")) != "", complaint))


def iso_text(moment: Column) -> Column:
    """A time as ISO text with the UTC offset, microseconds only when there are any."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(moment, "SSSSSS")
    fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(whole, fraction, F.lit("+00:00"))


def day_end(day: Column) -> Column:
    """Last microsecond of a date in UTC: the reference time of that date's digest."""
    return F.timestamp_micros(F.unix_micros(F.date_add(day, 1).cast("timestamp")) - 1)


def minus_days(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def local_day(moment: Column, zone: str = "Asia/Shanghai") -> Column:
    """The digest date that a moment falls on in the newsroom's zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))
