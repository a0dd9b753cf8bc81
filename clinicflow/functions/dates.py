"""Date and time column expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicflow.functions.labels import BE_YEARS, REPORT_TZ, STORAGE_TZ, THAI_MONTHS_SHORT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_report_tz(col, tz: str = REPORT_TZ, storage_tz: str = STORAGE_TZ) -> Column:
    """X3 ``ts AT TIME ZONE tz``: stored (UTC wall clock) -> report wall clock.

    Uses ``convert_timezone`` on ``timestamp_ntz`` so the result does not
    depend on the session time zone.
    """
    return F.convert_timezone(F.lit(storage_tz), F.lit(tz), _c(col).cast("timestamp_ntz"))


# Text is cut from the text of a ``date`` / ``timestamp_ntz``, not made by ``date_format``:
# that casts a ``timestamp_ntz`` to a session-zone timestamp first, which shifts
# wall-clock times that fall in a daylight-saving gap of the session zone.


def fmt_date(col) -> Column:
    """X1 ``to_char(d, 'DD/MM/YYYY')``."""
    d = F.to_date(_c(col))
    s = d.cast("string")
    return F.concat(F.substring(s, 9, 2), F.lit("/"), F.substring(s, 6, 2), F.lit("/"), F.substring(s, 1, 4))


def fmt_time(col) -> Column:
    """X2 ``to_char(ts, 'HH24:MI')``."""
    return F.substring(_c(col).cast("timestamp_ntz").cast("string"), 12, 5)


def fmt_iso_date(col) -> Column:
    """``YYYY-MM-DD`` text of a date / wall-clock timestamp."""
    return F.to_date(_c(col)).cast("string")


def fmt_datetime(col) -> Column:
    """``YYYY-MM-DD HH:MI:SS`` text of a wall-clock timestamp."""
    return F.substring(_c(col).cast("timestamp_ntz").cast("string"), 1, 19)


def iso_instant_text(col, tz: str = REPORT_TZ, storage_tz: str = STORAGE_TZ) -> Column:
    """An instant as ISO-8601 text in zone ``tz`` with its offset,
    ``YYYY-MM-DDTHH:MI:SS+HH:MM`` (how a timestamptz prints in JSON).

    The offset is the difference between the converted wall clock and the
    stored one, so zones with daylight saving get the offset of that instant.
    """
    utc = _c(col).cast("timestamp_ntz")
    local = to_report_tz(utc, tz, storage_tz)
    off = (local - F.convert_timezone(F.lit(storage_tz), F.lit("UTC"), utc)).cast("interval minute").cast("int")
    sign = F.when(off < 0, F.lit("-")).otherwise(F.lit("+"))
    hhmm = F.format_string("%02d:%02d", F.floor(F.abs(off) / 60).cast("int"), (F.abs(off) % 60).cast("int"))
    wall = F.replace(fmt_datetime(local), F.lit(" "), F.lit("T"))
    return F.when(utc.isNotNull(), F.concat(wall, sign, hhmm))


def buddhist_date(col) -> Column:
    """Date + 543 years (29 Feb clamps to 28 Feb), as a date."""
    return F.add_months(F.to_date(_c(col)), BE_YEARS * 12)


def buddhist_date_text(col) -> Column:
    """X6 + X1: ``to_char(d + interval '543 years', 'DD/MM/YYYY')``."""
    return fmt_date(buddhist_date(col))


def date_range_text(start_col, end_col, prefix: str) -> Column:
    """``prefix || BE(start) || ' - ' || BE(end)`` (the meta ``date_range``)."""
    return F.concat(F.lit(prefix), buddhist_date_text(start_col), F.lit(" - "), buddhist_date_text(end_col))


def thai_short_date(col, pad_year: bool = True) -> Column:
    """X22 ``d MMM YY``: day, Thai month abbreviation, Buddhist year mod 100."""
    d = F.to_date(_c(col))
    months = F.array(*[F.lit(m) for m in THAI_MONTHS_SHORT])
    yy = ((F.year(d) + BE_YEARS) % 100).cast("string")
    if pad_year:
        yy = F.lpad(yy, 2, "0")
    return F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), F.element_at(months, F.month(d)), F.lit(" "), yy)


def next_day(col) -> Column:
    """+1 day with month/year carry and leap years."""
    return F.date_add(F.to_date(_c(col)), 1)


def parse_be_date(col) -> Column:
    """``DD/MM/YYYY`` with a Buddhist-era year -> date (NULL if malformed)."""
    parts = F.split(_c(col), "/")
    d = F.try_element_at(parts, F.lit(1)).try_cast("int")
    m = F.try_element_at(parts, F.lit(2)).try_cast("int")
    y = F.try_element_at(parts, F.lit(3)).try_cast("int")
    iso = F.format_string("%04d-%02d-%02d", y - BE_YEARS, m, d)
    return F.when(F.size(parts) == 3, F.try_to_date(iso, "yyyy-MM-dd"))


def iso_date_part(col) -> Column:
    """The date part of an ISO text (``s.split('T')[0]``, then ``' '``)."""
    return F.substring_index(F.substring_index(_c(col), "T", 1), " ", 1)
