"""Time functions. Instants are TIMESTAMP_NTZ columns that hold UTC; the session zone must be UTC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# No zone is further from UTC than this.
_MAX_OFFSET = dt.timedelta(days=1)


def _known_tenant(ts: Column, company_id: Column, zones: Mapping[int, str], value: Column) -> Column:
    """``value`` where the tenant has a zone; NULL where there is no time; else an error that names the
    tenant. Without a zone there is no local time, and dropping the row would hide that."""
    message = F.concat(F.lit("no time zone for company_id "), F.coalesce(company_id.cast("string"), F.lit("NULL")))
    known = F.coalesce(company_id.isin(sorted(zones)), F.lit(False))
    return F.when(known, value).when(ts.isNotNull(), F.raise_error(message))


def to_local(ts: Column, company_id: Column, zones: Mapping[int, str]) -> Column:
    """UTC to the tenant's local time. NULL time gives NULL; a time of an unknown tenant is an error.

    The tenant list is settings, a few dozen entries in a handful of zones, so it goes into the plan
    as one constant branch per zone: no join, the expression can stand in any projection or filter,
    and each zone is looked up once, not once per row.
    """
    tenants: dict[str, list[int]] = {}
    for cid, zone in sorted(zones.items()):
        tenants.setdefault(zone, []).append(cid)
    instant, local = ts.cast("timestamp"), F.lit(None).cast("timestamp")
    for zone, ids in tenants.items():
        local = F.when(company_id.isin(ids), F.from_utc_timestamp(instant, zone)).otherwise(local)
    return _known_tenant(ts, company_id, zones, local.cast("timestamp_ntz"))


def local_date(ts: Column, company_id: Column, zones: Mapping[int, str]) -> Column:
    """The tenant's local date of a UTC instant."""
    return F.to_date(to_local(ts, company_id, zones))


def utc_year_bounds(ts: Column, year_lo: int, year_hi: int) -> Column:
    """A UTC range that holds every instant of the local years ``year_lo`` to ``year_hi``.

    The exact test is on a converted column and can't reach the scan; this one can.
    """
    lo = dt.datetime(year_lo, 1, 1) - _MAX_OFFSET
    hi = dt.datetime(year_hi + 1, 1, 1) + _MAX_OFFSET
    return (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))


def local_year_from(ts: Column, company_id: Column, zones: Mapping[int, str], year: int) -> Column:
    """Whether the tenant-local year is ``year`` or later. Only instants near the turn of the year
    have to be converted to tell."""
    turn = dt.datetime(year, 1, 1)
    surely = ts >= F.lit(turn + _MAX_OFFSET).cast("timestamp_ntz")
    maybe = ts >= F.lit(turn - _MAX_OFFSET).cast("timestamp_ntz")
    recent = surely | (maybe & (F.year(to_local(ts, company_id, zones)) >= year))
    return _known_tenant(ts, company_id, zones, recent)


def in_local_years(
    ts: Column, company_id: Column, zones: Mapping[int, str], year_lo: int, year_hi: int
) -> Column:
    """Whether the tenant-local year lies in the range: the pushable UTC range, then the exact test."""
    exact = F.year(to_local(ts, company_id, zones)).between(year_lo, year_hi)
    return utc_year_bounds(ts, year_lo, year_hi) & exact


def today_utc(as_of: dt.date | None = None) -> Column:
    """The given day, or today in UTC."""
    if as_of is not None:
        return F.lit(as_of)
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp()))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end: 10:00:59 to 10:01:00 is 1. NULL if either is."""
    # Whole minutes since a fixed minute; the difference of two such counts is the boundary count.
    epoch = F.lit(dt.datetime(1900, 1, 1)).cast("timestamp_ntz")
    return F.timestamp_diff("MINUTE", epoch, end) - F.timestamp_diff("MINUTE", epoch, start)


def parse_clock(text: Column, *, as_time: bool = False) -> Column:
    """A 12-hour clock text such as ``7:05 AM`` as ``HH:mm:ss``; text that is no clock gives NULL.

    Characters other than ASCII letters, digits and colons count as blanks, also the narrow blank
    U+202F. Blanks may stand around the clock and before AM or PM in any number.
    ``as_time`` returns TIME, which needs ``spark.sql.timeType.enabled``.
    """
    blank = "[^0-9:a-zA-Z]*"
    shape = f"^{blank}([0-9]{{1,2}}):([0-9]{{1,2}}){blank}([aApP][mM]){blank}$"
    clock = F.regexp_replace(text, shape, "$1:$2 $3")
    # Text of another shape stays as it is. Of such text the parser would take only numbers of more
    # than two digits, which the two lengths rule out without a second pattern match.
    colon = F.instr(clock, ":")
    short = (colon <= 3) & (F.length(clock) <= colon + 5)
    parsed = F.when(short, F.date_format(F.try_to_timestamp(clock, F.lit("h:m a")), "HH:mm:ss"))
    return parsed.cast("time") if as_time else parsed


def parse_ts(value: Column) -> Column:
    """Text or timestamp as a UTC instant: first the ISO form with Z, then any form Spark casts."""
    text = value.cast("string")
    iso = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X"))
    return F.coalesce(iso, text.try_cast("timestamp")).cast("timestamp_ntz")
