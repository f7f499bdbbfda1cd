"""Appointments per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions import today_utc
from crewlens.operators import merge_on_key, rollup, top_n_per_group
from crewlens.params import Params
from crewlens.plans.scope import KEYS, Scope, within
from crewlens.sources import Sources

def _appointments(src: Sources, params: Params, jobs: Scope | None) -> DataFrame:
    appointments = within(src.table("appointment"), jobs)
    if params.exclude_status:
        appointments = appointments.where(~F.col("status").isin(*params.exclude_status))
    return appointments.select(*KEYS, "start")


def past_appointments(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """First, last and number of the appointments before today (UTC dates)."""
    return rollup(
        _appointments(src, params, jobs),
        KEYS,
        {
            "first_past_appointment": F.min("start"),
            "total_past_appointments": F.count(F.lit(1)),
            "last_past_appointment": F.max("start"),
        },
        where=F.to_date("start") < today_utc(params.as_of),
    )


def next_appointments(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """The next two appointments from today on. The count is taken after the cut, so it is 1 or 2."""
    future = _appointments(src, params, jobs).where(F.to_date("start") >= today_utc(params.as_of))
    top2 = top_n_per_group(future, KEYS, [("start", "asc")], 2, rank="rn")
    return rollup(
        top2,
        KEYS,
        {
            "total_future_appointments": F.count(F.lit(1)),
            "start_appointment": F.max(F.when(F.col("rn") == 1, F.col("start"))),
            "next_appointment": F.max(F.when(F.col("rn") == 2, F.col("start"))),
        },
    )


def appointment_columns() -> dict[str, Column]:
    """The columns of ``wip_appointments`` out of a row that has both halves."""
    last, zero = F.col("last_past_appointment"), F.lit(0).cast("bigint")
    past, future = F.coalesce("total_past_appointments", zero), F.coalesce("total_future_appointments", zero)
    return {
        "first_appointment": F.col("first_past_appointment"),
        "total_appointments": past + future,
        "start_appointment": F.coalesce("start_appointment", last),
        # The last past appointment comes before the only future one.
        "next_appointment": F.coalesce("next_appointment", last, "start_appointment"),
        "most_recent_appointment": last,
    }


def wip_appointments(src: Sources, params: Params = Params()) -> DataFrame:
    """Per job: first, start, next and most recent appointment and their number. An appointment
    without a start is in neither half; a NULL job gives one row per half."""
    merged = merge_on_key(past_appointments(src, params), next_appointments(src, params), KEYS)
    columns = [column.alias(name) for name, column in appointment_columns().items()]
    return merged.select("company_id", "job_id", *columns)
