"""Calendar helpers.

Convention: inside the library every instant is a *UTC wall-clock*
``TIMESTAMP_NTZ``.  ``utc_wall`` normalises any input column to it:

* ``TIMESTAMP_NTZ``  already UTC wall clock (the parquet test tables),
* ``TIMESTAMP``      an instant; converted from the session zone,
* ``STRING``         lenient parse (FN1): bad text becomes NULL,
* ``DATE``           midnight UTC.

Local calendars never depend on ``spark.sql.session.timeZone``.  Per-row
conversions use ``from_utc_timestamp`` with a literal zone (the zone rules are
resolved once per task; ``convert_timezone`` re-parses the zone id for every
row and costs several times a parquet scan).  Moving between a wall clock and
an instant is a plain cast when the session zone is UTC — Spark pins the zone
into the plan when the DataFrame is built — and exact microsecond arithmetic
otherwise.  All bounds are constant expressions, so Catalyst folds them to
literals and parquet receives them as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference's calendar semantics.
DEFAULT_TZ = "Asia/Seoul"
EPOCH = _dt.date(1970, 1, 1)          # where a pandas fillna(0) puts a missing period (T2)
MEMBER_WINDOW_HOUR = 10               # member windows open at 10:00 local (FLT6)
WINDOW_DAYS = 7

# Written forms of a time (FN1).  Fixed values: English month and weekday names, and the first and
# last instant that a 64-bit count of nanoseconds holds; text outside them is no time.
_EARLIEST, _LATEST = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"
_ZONE = r"Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?|[A-Za-z][A-Za-z0-9_+-]*/[A-Za-z0-9_+/-]+"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
# ISO text that Spark's own cast reads: without and with a zone.
_ISO = rf"^\d{{4}}(?:-\d{{1,2}}(?:-\d{{1,2}}(?:[T ]{_CLOCK})?)?)?$"
_ISO_ZONED = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[T ]\d{{1,2}}:\d{{2}}:\d{{2}}(?:\.\d{{1,9}})?\s*(?:{_ZONE})$"
_ISO_SLASHED = rf"^\d{{4}}([/.])\d{{1,2}}\1\d{{1,2}}(?:[T ]{_CLOCK})?$"
_MONTH = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
          r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?")
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_HOURS = r"(\d{1,2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?\s*(?:([ap])\.?m\.?)?"
# Every other written form as one alternative; the groups of each are (year, month, day) in the order of _GROUPS.
_FORMS = (
    r"(\d{4})([-/. ])(\d{1,2})\2(\d{1,2})",                                # 2024/3/10
    r"(\d{4})(\d{2})(\d{2})",                                              # 20240310
    r"(\d{1,2})([-/.])(\d{1,2})\9(\d{4})",                                 # 03/10/2024, month first if it can be
    rf"{_DAY}[-/., ]*(?:of\s+)?{_MONTH}[-/., ]*(\d{{4}})",                 # 10 March 2024
    rf"{_MONTH}[-/. ]*{_DAY}[-/., ]+(\d{{4}})",                            # March 10, 2024
    rf"(\d{{4}})[-/. ]{_MONTH}[-/. ]{_DAY}",                               # 2024-Mar-10
    rf"{_MONTH}[-/., ]*(\d{{4}})",                                         # March 2024: its first day
)
_GROUPS = {"year": (1, 5, 11, 14, 17, 18, 22), "month": (3, 6), "day": (4, 7), "first": (8,), "second": (10,),
           "named": (13, 15, 19, 21), "named_day": (12, 16, 20)}
_SEPARATED = r"(?:T|\s*,\s*|\s+)(?:at\s+)?"
_WRITTEN = (rf"(?i)^{_WEEKDAY}(?:{'|'.join(_FORMS)})"
            rf"(?:(?:{_SEPARATED}|(?<=\d{{8}})){_HOURS}\s*({_ZONE})?)?$")
_CLOCK_GROUPS = {"hour": 23, "minute": 24, "second_": 25, "fraction": 26, "half": 27, "zone": 28}
# "Sun Mar 10 10:00:00 2024": the year after the time; rewritten with it before.
_YEAR_LAST = rf"(?i)^{_WEEKDAY}({_MONTH})\s+(\d{{1,2}})\s+({_CLOCK})\s+(\d{{4}})$"


_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu"}


def _session_is_utc() -> bool:
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def _epoch_wall() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_to_instant(utc_wall_col: Column) -> Column:
    """UTC wall clock (NTZ) -> the instant (TIMESTAMP) it denotes."""
    if _session_is_utc():
        return utc_wall_col.cast("timestamp")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_wall(), utc_wall_col))


def instant_to_wall(instant: Column) -> Column:
    """An instant (TIMESTAMP) -> its UTC wall clock (NTZ)."""
    if _session_is_utc():
        return instant.cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_wall())


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _as_iso(text: Column) -> Column:
    """Text in one of the written forms as ISO text, else NULL: one match gives all its parts."""
    mark = "\x01"
    slots = [("year", _GROUPS["year"]), ("month", _GROUPS["month"]), ("day", _GROUPS["day"]), ("first", _GROUPS["first"]),
             ("second", _GROUPS["second"]), ("named", _GROUPS["named"]), ("named_day", _GROUPS["named_day"])]
    slots += [(name, (group,)) for name, group in _CLOCK_GROUPS.items()]
    at = {name: i + 1 for i, (name, _) in enumerate(slots)}
    # one form takes part in a match, so the groups of the others are empty
    parts = "".join(mark + "".join(f"${g}" for g in groups) for _, groups in slots)
    dated = F.regexp_replace(text, _YEAR_LAST, "$1 $3 $5 $4")

    def build(p: Column) -> Column:
        get = lambda name: F.get(p, F.lit(at[name]))
        given = lambda name: get(name) != ""
        month_first = get("first").try_cast("int") <= 12
        month = (F.when(given("month"), get("month")).when(given("first"), F.when(month_first, get("first")).otherwise(get("second")))
                 .otherwise(F.floor((F.position(F.lower(F.substring(get("named"), 1, 3)), F.lit(_MONTHS)) + 2) / 3).cast("string")))
        day = (F.when(given("day"), get("day")).when(given("first"), F.when(month_first, get("second")).otherwise(get("first")))
               .when(given("named_day"), get("named_day")).otherwise("1"))
        hour = get("hour").try_cast("int")
        half = F.when((hour >= 1) & (hour <= 12), hour % 12 + F.when(F.lower(get("half")) == "p", 12).otherwise(0))
        clock = F.concat(F.when(given("half"), half).otherwise(hour).cast("string"), F.lit(":"),
                         F.when(given("minute"), get("minute")).otherwise("00"), F.lit(":"),
                         F.when(given("second_"), get("second_")).otherwise("00"),
                         F.when(given("fraction"), F.concat(F.lit("."), get("fraction"))).otherwise(""),
                         F.when(get("zone").contains("/"), F.concat(F.lit(" "), get("zone"))).otherwise(F.upper(get("zone"))))
        date = F.concat_ws("-", get("year"), month, day)
        return F.when(F.size(p) == len(slots) + 1, F.when(given("hour"), F.concat(date, F.lit(" "), clock)).otherwise(date))

    return _let(F.split(F.regexp_replace(dated, _WRITTEN, parts), mark), build)


def lenient_timestamp(col: Column) -> Column:
    """FN1: text -> UTC wall-clock timestamp; unparsable or NULL -> NULL.

    The text's shape decides how it is read, once: ISO text by Spark's cast; other forms
    (slashes and dots, month names, month first, ``yyyyMMdd``, 12-hour clocks) are taken
    apart by one match and read as ISO text.  ``03/10/2024`` is the tenth of March, as
    ``pd.to_datetime`` reads it, ``13/01/2024`` can only be the thirteenth.  Text with a zone
    (offset or region name) is read as that instant, an unknown zone is unparsable; naive
    text is taken to be UTC.  Years have four digits: how two are read depends on the day of
    reading.  Times outside 1677 to 2262 are unparsable, as they are to pandas.
    """
    s = F.btrim(col, F.lit(" \t\r\n"))
    naive = lambda x: x.try_cast("timestamp_ntz")
    instant = lambda x: instant_to_wall(x.try_cast("timestamp"))
    written = _let(_as_iso(s), lambda x: F.when(x.rlike(_ISO_ZONED), instant(x)).otherwise(naive(x)))
    dashed = F.concat(F.translate(F.substring(s, 1, 10), "/.", "--"), F.substring(s, 11, 40))
    read = (F.when(s.rlike(_ISO), naive(s)).when(s.rlike(_ISO_ZONED), instant(s)).when(s.rlike(_ISO_SLASHED), naive(dashed))
            .otherwise(written))
    known = F.lit(_EARLIEST).cast("timestamp_ntz"), F.lit(_LATEST).cast("timestamp_ntz")
    return F.when(read.between(*known), read)


def utc_wall(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df`` as a UTC wall-clock ``TIMESTAMP_NTZ``."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.TimestampType):
        return instant_to_wall(col)
    if isinstance(dtype, T.StringType):
        return lenient_timestamp(col)
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz")
    raise TypeError(f"column {name!r} has type {dtype.simpleString()}, expected a timestamp")


def to_local(utc: Column, tz: str = DEFAULT_TZ) -> Column:
    """FN2/FN3: UTC wall clock -> local wall clock of ``tz`` (both NTZ)."""
    return instant_to_wall(F.from_utc_timestamp(wall_to_instant(utc), tz))


def local_date(utc: Column, tz: str = DEFAULT_TZ) -> Column:
    """FN8: the local calendar date of a UTC wall-clock timestamp."""
    return F.to_date(to_local(utc, tz))


def week_start(date: Column) -> Column:
    """FN4: Monday of the week containing ``date``."""
    return F.trunc(date, "week")


def month_start(date: Column) -> Column:
    """FN5/FN7: first day of the month containing ``date``."""
    return F.trunc(date, "month")


def as_date(value) -> Column:
    """A run date (``date`` or ``YYYY-MM-DD``) as a DATE literal."""
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def local_instant(as_of, days_before: int = 0, hour: int = 0, tz: str = DEFAULT_TZ) -> Column:
    """UTC wall clock of ``hour``:00 local time, ``days_before`` days before ``as_of``."""
    local = F.timestamp_add("HOUR", F.lit(hour),
                            F.date_sub(as_date(as_of), days_before).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def member_window(as_of, tz: str = DEFAULT_TZ) -> tuple[Column, Column]:
    """FLT6 bounds: [as_of − 7d 10:00, as_of 10:00) local, as UTC wall clock."""
    return (local_instant(as_of, WINDOW_DAYS, MEMBER_WINDOW_HOUR, tz),
            local_instant(as_of, 0, MEMBER_WINDOW_HOUR, tz))


def _between(ts: Column, start: Column, end: Column) -> Column:
    # ``ts IS NOT NULL AND ..`` is never NULL (FALSE AND NULL = FALSE) and, unlike a
    # coalesce wrapper, every conjunct reaches the parquet reader as a pushed filter.
    return ts.isNotNull() & (ts >= start) & (ts < end)


def in_member_window(df: DataFrame, name: str, as_of, tz: str = DEFAULT_TZ) -> Column:
    """FLT6 predicate on column ``name``; NULL timestamps are outside (False)."""
    start, end = member_window(as_of, tz)
    return _between(utc_wall(df, name), start, end)


def in_date_window(df: DataFrame, name: str, as_of, tz: str = DEFAULT_TZ) -> Column:
    """FLT5 predicate: local date of ``name`` in [as_of − 7d, as_of).

    Evaluated as the instant range [local midnight of as_of − 7d, local
    midnight of as_of), which is the same set and can be pushed to the scan.
    """
    return _between(utc_wall(df, name), local_instant(as_of, WINDOW_DAYS, 0, tz),
                    local_instant(as_of, 0, 0, tz))


def truncate_now(now) -> Column:
    """FN11: the job's ``now`` (UTC wall clock) truncated to the second."""
    if isinstance(now, Column):
        ts = now
    else:
        ts = F.lit(str(now)).cast("timestamp_ntz")
    return F.date_trunc("SECOND", ts).cast("timestamp_ntz")


def as_text(col: Column, dtype: T.DataType, tz: str | None = None) -> Column:
    """FN9: a date or time as text; NULL stays NULL.

    Dates: ``2024-01-22``.  Times: ``2024-01-22 10:00:00``, with a fraction only if there is
    one.  With ``tz`` a (UTC wall-clock) time is written as that zone's time and offset,
    ``2024-01-22 19:00:00+09:00``.
    """
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    wall = instant_to_wall(col) if isinstance(dtype, T.TimestampType) else col
    shown = to_local(wall, tz) if tz else wall
    fraction = F.when(F.date_format(shown, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(shown, "SSSSSS"))).otherwise("")
    text = F.concat(F.date_format(shown, "yyyy-MM-dd HH:mm:ss"), fraction)
    if not tz:
        return text
    minutes = F.timestamp_diff("MINUTE", wall, shown)
    offset = F.format_string("%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60)
    return F.concat(text, offset)


def dates_to_text(df: DataFrame, tz: str | None = None) -> DataFrame:
    """FN9 on every ``*_date`` column that holds dates or times; other columns are as they were."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(*[as_text(F.col(f.name), f.dataType, tz).alias(f.name)
                       if f.name.endswith("_date") and isinstance(f.dataType, temporal) else F.col(f.name) for f in df.schema.fields])
