"""Settings of the jobs. Defaults give the published behaviour."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JoinTuning:
    """Limits that pick how a fact is joined to a lookup (see ``operators.joins``).

    broadcast_bytes: a lookup is broadcast only when Spark's own size estimate is at most this. For
        files that is their compressed size; in memory a lookup may be some ten times larger.
    buckets: key buckets counted to find hot keys, and the bound on every list made of them.
    bitmap_bytes: the size of a set of ids that is sent to every task (see ``operators.bitmaps``); 0 sends none.
    """

    broadcast_bytes: int = 8 * 1024 * 1024
    buckets: int = 8192
    bitmap_bytes: int = 32 * 1024 * 1024


@dataclass(frozen=True)
class Params:
    """Parameters shared by all jobs.

    as_of: the day that splits past from future appointments; None means today in UTC.
    year_lo, year_hi: local completion years listed by ``invoiced_items``.
    min_year: ``sales_master_tracker`` keeps jobs with an appointment in or after this local year.
    fix_last_appt: False repeats the first appointment as the last one, as the reports always did.
    exclude_status: appointment statuses left out of ``wip_appointments``; none by default.
    """

    as_of: dt.date | None = None
    year_lo: int = 2025
    year_hi: int = 2026
    min_year: int = 2025
    fix_last_appt: bool = False
    exclude_status: tuple[str, ...] = ()
    join: JoinTuning = field(default_factory=JoinTuning)
