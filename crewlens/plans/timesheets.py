"""Clock entries and paid time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import hours_from_minutes, minutes_between, to_local, typed_null
from crewlens.operators import HotKeys, lookup_join, rollup, stack
from crewlens.params import Params
from crewlens.plans.people import technicians_employees
from crewlens.plans.scope import Scope, within
from crewlens.sources import Sources

CODE, PERSON = ["timesheet_code_id", "company_id"], ["emp_id", "company_id"]
CODE_COLUMNS = ["code", "description", "applicable_employee_type", "type"]


def timestamp_base(src: Sources, params: Params = Params()) -> DataFrame:
    """Active job and non-job timesheets in tenant-local time, with the person and the code."""
    job_sheets = src.table("timesheet").where("active")
    other_sheets = src.table("non_job_timesheets").where("active")

    def local(column: str):
        return to_local(F.col(column), F.col("company_id"), src.zones)

    # Job entries have no code. Only the other half meets the code table, so that the NULL codes of
    # all job entries never gather on one join key.
    jobs = job_sheets.select(
        "company_id",
        "id",
        F.col("technician_id").alias("emp_id"),
        F.lit("Job").alias("source"),
        "job_id",
        local("created_on").alias("created_on"),
        local("dispatched_on").alias("start_ts"),
        local("arrived_on").alias("arrival_ts"),
        local("done_on").alias("end_ts"),
        typed_null("bigint").alias("timesheet_code_id"),
        "active",
        *[typed_null("string").alias(c) for c in CODE_COLUMNS],
    )
    codes = src.table("timesheet_code").select(
        "company_id", F.col("id").alias("timesheet_code_id"), *CODE_COLUMNS
    )
    others = other_sheets.select(
        "company_id",
        "id",
        F.col("employee_id").alias("emp_id"),
        F.lit("Non-Job").alias("source"),
        typed_null("bigint").alias("job_id"),
        local("created_on").alias("created_on"),
        local("started_on").alias("start_ts"),
        # The arrival of a non-job entry is its creation time.
        local("created_on").alias("arrival_ts"),
        local("ended_on").alias("end_ts"),
        "timesheet_code_id",
        "active",
    )
    others = lookup_join(
        others,
        codes,
        CODE,
        tuning=params.join,
        hot=HotKeys(other_sheets, [CODE], params.join),
        distinct_rows=True,
    )
    entries = stack(jobs, others)

    people = technicians_employees(src, params).select(
        "company_id",
        F.col("id").alias("emp_id"),
        F.col("name").alias("emp_name"),
        "emp_type",
        "business_unit_id",
    )
    person_keys = stack(
        job_sheets.select("company_id", F.col("technician_id").alias("emp_id")),
        other_sheets.select("company_id", F.col("employee_id").alias("emp_id")),
    )
    hot = HotKeys(person_keys, [PERSON], params.join)
    named = lookup_join(entries, people, PERSON, tuning=params.join, hot=hot, distinct_rows=True)
    return named.select(
        "company_id",
        "emp_name",
        "emp_type",
        "business_unit_id",
        "id",
        "emp_id",
        "source",
        "job_id",
        "created_on",
        "start_ts",
        "arrival_ts",
        "end_ts",
        "timesheet_code_id",
        "active",
        *CODE_COLUMNS,
    )


def paid_hours_by_job(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """Minutes from dispatch to done per job, and the same as hours. Inactive entries count too."""
    minutes = minutes_between(F.col("dispatched_on"), F.col("done_on"))
    sheets = within(src.table("timesheet_copy").select("job_id", "company_id", "dispatched_on", "done_on"), jobs)
    total = rollup(sheets, ["job_id", "company_id"], {"total_minutes": F.sum(minutes)})
    return total.withColumn("total_paid_time", hours_from_minutes(F.col("total_minutes")))
