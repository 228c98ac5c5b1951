"""Timestamp parsing and calendar generation (built-in expressions only).

All timestamps in the engine are ``TIMESTAMP_NTZ`` holding UTC wall-clock time,
so results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_DATE = dt.date(1970, 1, 1)
_DAY = 86400


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds (integral) -> TIMESTAMP_NTZ in UTC.

    NTZ plus a day-time interval is plain microsecond arithmetic, so the result
    never depends on the session time zone or its daylight-saving rules (unlike
    ``timestampadd`` on NTZ, which applies the session zone).
    """
    secs = seconds.cast("decimal(18,6)")
    return _epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def ts_to_epoch(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch seconds as BIGINT (whole seconds, zone-free)."""
    t = ts.cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit(_EPOCH_DATE)).cast("bigint")
    return days * _DAY + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


# Magnitude limits below which an integer counts as seconds / ms / us; above: ns (auto_scale=True).
_SCALE_LIMITS = [(31536000000, 10**6), (31536000000000, 10**3), (31536000000000000, 1)]
# Epoch microseconds of 0001-01-01 and 9999-12-31 23:59:59.999999.
_MICROS_MIN, _MICROS_MAX = -62135596800 * 10**6, 253402300800 * 10**6 - 1
_SECONDS_MIN, _SECONDS_MAX = _MICROS_MIN // 10**6, _MICROS_MAX // 10**6
_NUMBER = r"^[+-]?[0-9]{1,30}([.][0-9]*)?$"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row for all its uses in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scaled(n: Column) -> Column:
    """Epoch number in seconds, milli-, micro- or nanoseconds by magnitude -> microseconds (whole, as a decimal)."""
    micros = F.when(F.abs(n) < F.lit("1" + "0" * 22).cast("decimal(38,0)"), F.floor(n / 1000))
    for limit, factor in reversed(_SCALE_LIMITS):
        micros = F.when(F.abs(n) < limit, F.floor(n * factor)).otherwise(micros)
    return micros.try_cast("decimal(38,0)")


def _compact(text: Column) -> Column:
    """``yyyyMMddHHmmss`` -> timestamp (NULL if it is none)."""
    part = lambda at, n: F.substring(text, at, n)
    iso = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2))
    return F.when(F.length(text) == 14, F.when(text.rlike("^[0-9]{14}$"), iso.try_cast("timestamp_ntz")))


def _steps(auto_scale: bool) -> list[tuple[str, Callable[[dict[str, Column]], Column]]]:
    """The parse as named steps, each computed from those before it; the last is the time. ``raw`` is the text."""

    def micros(c: dict[str, Column]) -> Column:
        if auto_scale:
            number = F.coalesce(c["number"].cast("decimal(38,6)"), c["exact"])
            return _scaled(number)
        seconds = F.when(c["number"].between(_SECONDS_MIN, _SECONDS_MAX), c["number"] * 10**6)
        fraction = F.when(c["exact"].between(F.lit(_SECONDS_MIN), F.lit(f"{_SECONDS_MAX}.999999").cast("decimal(18,6)")), c["exact"])
        return F.coalesce(seconds, (fraction.cast("decimal(18,6)") * 10**6).cast("bigint"))

    def time(c: dict[str, Column]) -> Column:
        m = c["micros"]
        if auto_scale:
            m = F.when(m.between(F.lit(_MICROS_MIN), F.lit(_MICROS_MAX)), m.cast("bigint"))
        epoch = _epoch_ntz() + F.expr("INTERVAL '0.000001' SECOND") * m
        parsed = F.when(c["number"].isNotNull() | c["exact"].isNotNull(), epoch).otherwise(c["text"].try_cast("timestamp_ntz"))
        return F.coalesce(_compact(c["text"]), parsed) if auto_scale else parsed

    return [
        ("text", lambda c: F.trim(c["raw"])),
        ("number", lambda c: c["text"].try_cast("bigint")),  # the usual case: no pattern is matched
        ("exact", lambda c: F.when(c["number"].isNull(), F.when(c["text"].rlike(_NUMBER), c["text"]).try_cast("decimal(38,6)"))),
        ("micros", micros),
        ("time", time),
    ]


def parse_ts(col: Column, dtype: T.DataType | None = None, auto_scale: bool = False) -> Column:
    """``TO_TIMESTAMP`` of a string, epoch number or timestamp; never raises.

    Strings holding a number are epoch seconds (fractions kept to microseconds); with ``auto_scale`` seconds,
    milliseconds, microseconds or nanoseconds by magnitude, and 14 digits that are a valid ``yyyyMMddHHmmss`` are that.
    Other strings are ISO date/time text. Anything else, and any time outside the years 1 to 9999, is NULL.

    For a column that filters, joins or several outputs read, use ``with_parsed_ts``: the optimizer copies an expression
    into each of its uses.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp_ntz")
    text = col.try_cast("decimal(38,6)") if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.DecimalType)) else col
    steps = _steps(auto_scale)

    def run(k: int, done: dict[str, Column]) -> Column:
        name, step = steps[k]
        return step(done) if k == len(steps) - 1 else _bind(step(done), lambda v: run(k + 1, {**done, name: v}))

    return run(0, {"raw": text.cast("string")})


def parse_ts_of(df: DataFrame, name: str, auto_scale: bool = False) -> Column:
    """``parse_ts`` choosing the rule from the column's type in ``df``."""
    return parse_ts(F.col(name), df.schema[name].dataType, auto_scale)


def with_parsed_ts(df: DataFrame, name: str, auto_scale: bool = False) -> DataFrame:
    """``df`` with the text column ``name`` replaced by its time, parsed exactly once per row.

    The steps are columns of their own (the optimizer keeps a projection apart whose costly columns are used more than
    once), and the result leaves a generator (``inline`` of one struct): filters, join keys and projections above read
    the finished column, as nothing is copied through a generator. Filters on other columns are pushed through as usual.
    Columns that are no text keep their plain cast.
    """
    if not isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, parse_ts_of(df, name, auto_scale))
    done, out = {"raw": F.col(name)}, df
    *inner, (_, last) = _steps(auto_scale)
    for step, value in inner:
        out = out.withColumn(f"__{step}_{name}", value(done))
        done[step] = F.col(f"__{step}_{name}")
    others = [c for c in df.columns if c != name]
    return out.select(*others, F.inline(F.array(F.struct(last(done).alias(name))))).select(*df.columns)


def null_marker(col: Column, marker: str = "None") -> Column:
    """``NULLIF(col, marker)``: the text marker of a missing value becomes NULL."""
    return F.nullif(col, F.lit(marker))


def day_sequence(start: Column, stop: Column) -> Column:
    """Array of every date from ``start`` to ``stop`` (empty when start > stop)."""
    return F.when(
        start <= stop, F.sequence(start, stop, F.expr("INTERVAL 1 DAY"))
    ).otherwise(F.array().cast("array<date>"))


def month_sequence(start: Column, stop: Column) -> Column:
    """Array of month-start dates in [start, stop]; ``start`` rounded up to a month start."""
    first = F.when(F.trunc(start, "MM") == start, start).otherwise(F.add_months(F.trunc(start, "MM"), 1))
    last = F.trunc(stop, "MM")
    return F.when(
        first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    ).otherwise(F.array().cast("array<date>"))
