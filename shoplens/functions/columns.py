"""Scalar steps as built-in column expressions (JVM-side, inside whole-stage codegen; no UDFs).

Null in, null out: a missing phone or time gives a null field and keeps the row.  Text that is no time, date or
number gives null as well, never a failed task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value as a lambda's variable: it is made once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ts_ms: ColumnOrName = "ts") -> Column:
    """Epoch milliseconds → TIMESTAMP (for windows and watermarks)."""
    return F.timestamp_millis(_c(ts_ms))


def log_date(ts_ms: ColumnOrName = "ts") -> Column:
    """PRJ1: ``yyyy-MM-dd`` of an epoch-ms time (session zone, pinned to UTC)."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "yyyy-MM-dd")


def log_hour(ts_ms: ColumnOrName = "ts") -> Column:
    """PRJ1: two-digit hour ``HH`` of an epoch-ms time."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "HH")


def text_date(time_text: ColumnOrName = "create_time") -> Column:
    """PRJ2: date part of ``yyyy-MM-dd HH:mm:ss`` text (the part before the blank)."""
    return F.split_part(_c(time_text), F.lit(" "), F.lit(1))


def text_hour(time_text: ColumnOrName = "create_time") -> Column:
    """PRJ2: hour part of ``yyyy-MM-dd HH:mm:ss`` text (the time part up to the first colon)."""
    return F.split_part(F.split_part(_c(time_text), F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def text_to_timestamp(time_text: ColumnOrName = "create_time") -> Column:
    return F.try_to_timestamp(_c(time_text), F.lit("yyyy-MM-dd HH:mm:ss"))


# The two phone masks.
MASK_TAIL_PREFIX4 = "*******"
MASK_MIDDLE4 = "****"


def mask_prefix4(tel: ColumnOrName = "consignee_tel") -> Column:
    """PRJ3: keep the first 4 characters, then a fixed 7 stars."""
    t = _c(tel)
    return F.when(t.isNotNull(), F.concat(F.substring(t, 1, 4), F.lit(MASK_TAIL_PREFIX4)))


def mask_middle4(tel: ColumnOrName = "consignee_tel") -> Column:
    """PRJ4: first 3 characters, 4 stars, then everything after position 7."""
    t = _c(tel)
    return F.when(t.isNotNull(), F.concat(F.substring(t, 1, 3), F.lit(MASK_MIDDLE4), F.substring(t, 8, 2147483647)))


def age_years(birthday: ColumnOrName, as_of: ColumnOrName) -> Column:
    """PRJ9: whole days between birthday and ``as_of`` integer-divided by 365 (drifts from calendar age)."""
    days = F.datediff(_c(as_of), F.try_to_timestamp(_c(birthday), F.lit("yyyy-MM-dd")).cast("date"))
    return F.floor(days / F.lit(365)).cast("int")


def minute_of(ts_ms: ColumnOrName) -> Column:
    """Whole minutes since the epoch of an epoch-ms time (``ts / 1000 / 60`` in integer arithmetic)."""
    return F.floor(_c(ts_ms) / F.lit(60000)).cast("long")


def doc_id(mid: ColumnOrName, ts_ms: ColumnOrName) -> Column:
    """PRJ10: ``<mid>-<minute>`` — at most one alert document per device and minute."""
    return F.concat_ws("-", _c(mid), minute_of(ts_ms).cast("string"))


def dated_index(prefix: str, ts_ms: ColumnOrName) -> Column:
    """PRJ10: ``<prefix>-<yyyy-MM-dd>`` of the document's own time."""
    return F.concat_ws("-", F.lit(prefix), log_date(ts_ms))


def previous_day(date_text: ColumnOrName) -> Column:
    """PRJ11: the day before, as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_sub(F.to_date(_c(date_text)), 1), "yyyy-MM-dd")


def record_json(*cols: str) -> Column:
    """PRJ12: a record serialised as JSON text."""
    return F.to_json(F.struct(*cols) if cols else F.struct("*"))


def after_image_json(after: ColumnOrName = "after") -> Column:
    """PRJ7: fold a (name, value) column list into one JSON object, all values text."""
    return F.to_json(F.map_from_entries(last_entries(after)))


def last_entries(after: ColumnOrName = "after") -> Column:
    """The (name, value) list with the last entry of each name and no nameless ones.

    The list is bound to a lambda's variable, so it is made once a row even where the optimizer puts the expressions that
    build it in its place; only a list that repeats a name is searched entry by entry."""
    def last(entries: Column) -> Column:
        def is_last(entry: Column, at: Column) -> Column:
            later = F.slice(entries, at + 2, F.size(entries))
            return ~F.exists(later, lambda x: x["name"].eqNullSafe(entry["name"]))

        names = F.array_distinct(F.transform(entries, lambda x: x["name"]))
        return F.when(F.size(names) == F.size(entries), entries).otherwise(F.filter(entries, is_last))

    named = F.filter(_c(after), lambda x: x["name"].isNotNull())
    return bound(named, last)


def receive_stamp() -> Column:
    """PRJ6: receive time in epoch ms."""
    return F.unix_millis(F.current_timestamp())


def money(c: ColumnOrName) -> Column:
    """Money is summed exactly as DECIMAL(18,2) and handed out as DOUBLE."""
    return _c(c).try_cast("decimal(18,2)")
