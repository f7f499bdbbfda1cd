"""The job master."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import local_date, local_year_from, utrim
from crewlens.functions.columns import MONEY
from crewlens.operators import HotKeys, lookup_join
from crewlens.params import Params
from crewlens.plans.appointments import appointment_columns, next_appointments, past_appointments
from crewlens.plans.rollups import (
    installed_estimates_by_job,
    invoice_total_by_job,
    lead_ids_by_parent,
    lead_sales_by_parent,
    sold_estimates_by_job,
)
from crewlens.plans.scope import KEYS, Scope
from crewlens.plans.technicians import job_technicians
from crewlens.plans.timesheets import paid_hours_by_job
from crewlens.sources import Sources

def recent_jobs(src: Sources, params: Params = Params()) -> DataFrame:
    """Keys, repeated, of the jobs that can pass the year test: the latest of the three dates is itself an appointment,
    so one of the job's appointments starts in or after ``min_year``, or within a day before it in UTC."""
    bound = F.lit(dt.datetime(params.min_year, 1, 1) - dt.timedelta(days=1)).cast("timestamp_ntz")
    starts = src.table("appointment").where(F.col("job_id").isNotNull() & (F.col("start") >= bound))
    return starts.select(*KEYS)


def _dated_jobs(src: Sources, params: Params, recent: Scope) -> DataFrame:
    """Jobs with a first, start or next appointment in or after ``min_year``, and their appointments.

    Both halves of the appointments are joined to the jobs directly. Merging them first, as for the
    dataset of their own, would lose their partitioning and shuffle the merged rows once more.
    """
    jobs = src.table("job").select(
        "company_id",
        F.col("id").alias("job_id"),
        "job_number",
        "job_type_id",
        "business_unit_id",
        "project_id",
        "customer_id",
        "sold_by_id",
        "completed_on",
        "job_status",
    )
    # Dealt by job once: every rollup is grouped by the same keys, and meets the jobs where they are.
    halves = (
        recent.cut(jobs)
        .repartition(*KEYS)
        .join(past_appointments(src, params, recent), KEYS, "left")
        .join(next_appointments(src, params, recent), KEYS, "left")
    )
    columns = [column.alias(name) for name, column in appointment_columns().items()]
    appointments = ["first_appointment", "start_appointment", "next_appointment"]
    # A later instant is never in an earlier local year, so the latest one decides for all three.
    recent = local_year_from(F.greatest(*appointments), F.col("company_id"), src.zones, params.min_year)

    def day(column: str, name: str):
        return local_date(F.col(column), F.col("company_id"), src.zones).alias(name)

    # Local days are made here, apart from the wide last projection: much code in one projection
    # makes a method that the JVM does not compile.
    return (
        halves.select(*jobs.columns, *columns)
        .where(recent)
        .select(
            *[c for c in jobs.columns if c != "completed_on"],
            "first_appointment",
            "total_appointments",
            day("completed_on", "completion_date"),
            day("start_appointment", "scheduled_date"),
            day("first_appointment", "first_appt_date"),
            *([day("most_recent_appointment", "last_appt_date")] if params.fix_last_appt else []),
            day("next_appointment", "next_appt_start_date"),
        )
    )


def sales_master_rows(src: Sources, params: Params = Params()) -> DataFrame:
    """The rows of ``sales_master_tracker`` with ``first_appointment``, on which reports sort."""
    # The appointment test drops most jobs, so it comes first, and what belongs to other jobs is cut before it is
    # summed.
    recent = Scope(recent_jobs(src, params), params)
    master = _dated_jobs(src, params, recent)

    def text(column: str):
        # Trimmed once per lookup row, not once per job.
        return F.col(column) if column == "number" else utrim(F.col(column))

    # Lookups meet the jobs while those are narrow. Here one value may stand on a third of the jobs.
    lookups = (
        ("job_type", "job_type_id", {"name": "job_type"}),
        ("business_unit", "business_unit_id", {"name": "business_unit"}),
        ("technician_copy", "sold_by_id", {"name": "sold_by"}),
        ("project", "project_id", {"number": "project"}),
        ("customer", "customer_id", {"name": "customer_name", "type": "customer_type"}),
    )
    hot = HotKeys(master, [[key, "company_id"] for _, key, _ in lookups], params.join)
    for table, key, columns in lookups:
        lookup = src.table(table).select(
            "company_id", F.col("id").alias(key), *[text(c).alias(name) for c, name in columns.items()]
        )
        master = lookup_join(master, lookup, [key, "company_id"], tuning=params.join, hot=hot, distinct_rows=True)

    # All rollups are unique per job and grouped by the join key: no key can be hot.
    by_parent = {"parent_job_id": "job_id"}
    for per_job in (
        invoice_total_by_job(src, params, recent),
        sold_estimates_by_job(src, params, recent).drop("estimates"),
        installed_estimates_by_job(src, params, recent),
        paid_hours_by_job(src, params, recent).drop("total_minutes"),
        lead_sales_by_parent(src, params, recent).withColumnsRenamed(by_parent),
        lead_ids_by_parent(src, params, recent).withColumnsRenamed(by_parent),
        job_technicians(src, params, null_jobs=False, jobs=recent),
    ):
        master = master.join(per_job, KEYS, "left")

    def amount(column: str):
        return F.coalesce(column, F.lit(0).cast(MONEY))

    return master.select(
        "company_id",
        "job_number",
        "job_type",
        "business_unit",
        "completion_date",
        "project",
        amount("total_invoice").alias("job_subtotal"),
        "customer_id",
        "customer_name",
        F.coalesce("assigned_technicians", F.lit("")).alias("assigned_technicians"),
        "sold_by",
        "total_paid_time",
        "primary_technician",
        F.col("job_status").alias("status"),
        "scheduled_date",
        "total_appointments",
        "first_appt_date",
        F.col("last_appt_date" if params.fix_last_appt else "first_appt_date").alias("last_appt_date"),
        "next_appt_start_date",
        "customer_type",
        amount("subtotal").alias("estimate_sales_subtotal"),
        amount("estimate_items_total").alias("estimate_sales_installed"),
        F.col("total_appointments").alias("appointments_to_date"),
        amount("sub_total_lead").alias("sales_from_leads_created"),
        F.coalesce("lead_created", F.lit("")).alias("lead_created"),
        F.col("job_id").alias("invoice_number"),
        "first_appointment",
    )


def sales_master_tracker(src: Sources, params: Params = Params()) -> DataFrame:
    """One row per job with a recent appointment: what it is, who worked on it, what it sold."""
    return sales_master_rows(src, params).drop("first_appointment")
