"""Time-sliced reads of the source database: predicates on the raw instant column."""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from clinicflow.functions.labels import STORAGE_TZ

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


def _instant(value, tz: str) -> dt.datetime:
    """A wall clock of zone ``tz`` (text, date or datetime; an aware datetime keeps its own zone) as a UTC instant."""
    if isinstance(value, dt.datetime):
        moment = value
    elif isinstance(value, dt.date):
        moment = dt.datetime.combine(value, dt.time.min)
    else:
        moment = dt.datetime.fromisoformat(str(value))
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=ZoneInfo(tz))
    return moment.astimezone(dt.timezone.utc)


def _literal(moment: dt.datetime) -> str:
    return f"TIMESTAMP WITH TIME ZONE '{moment:%Y-%m-%d %H:%M:%S.%f}+00'"


def time_slices(column: str, start, end, slices: int, tz: str = STORAGE_TZ, closed: bool = False) -> list[str]:
    """One SQL predicate per task that together hold the rows of the range exactly once.

    ``start <= column < end`` (``<= end`` if ``closed``). The bounds are wall clocks
    of zone ``tz`` and become UTC instants here, once; the column stays bare, so
    the database can use its index and partitions. Slices are of equal length;
    there are fewer where the range has less microseconds than slices, and
    one that holds nothing where the range is empty (a reader needs one).
    """
    if not _NAME.fullmatch(column):
        raise ValueError(f"not a column name: {column!r}")
    first, last = _instant(start, tz), _instant(end, tz)
    micros = (last - first) // dt.timedelta(microseconds=1)
    if micros < 0 or (micros == 0 and not closed):
        return ["1 = 0"]
    cuts = sorted({first + dt.timedelta(microseconds=micros * i // slices) for i in range(max(1, slices))} - {last} | {first}) + [last]
    out = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        upper = "<=" if closed and i == len(cuts) - 2 else "<"
        out.append(f"{column} >= {_literal(a)} AND {column} {upper} {_literal(b)}")
    return out
